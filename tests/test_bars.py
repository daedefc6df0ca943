import datetime as dt

from hypothesis import given, settings, strategies as st, HealthCheck

from barlake.operators.bars import ohlcv_bars

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = "symbol string, trade_id bigint, price double, quantity double, is_buyer_maker boolean, event_ts timestamp_ntz"


def _trades(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_edge_rows(spark):
    rows = [
        ("a", 1, None, 1.0, False, T0),                              # NULL price: not open
        ("a", 2, 10.0, 2.0, True, T0 + dt.timedelta(seconds=1)),      # seller-initiated
        ("a", 3, 12.0, 1.0, None, T0 + dt.timedelta(seconds=2)),      # NULL flag counts +
        ("a", 4, None, 1.0, False, T0 + dt.timedelta(seconds=3)),     # NULL price: not close
        ("b", 5, 5.0, 0.0, False, T0),                                # zero volume bar
    ]
    out = {r.symbol: r for r in ohlcv_bars(_trades(spark, rows), "10 seconds").collect()}
    a = out["a"]
    assert (a.open, a.close, a.high, a.low) == (10.0, 12.0, 12.0, 10.0)
    assert a.trade_count == 4 and a.volume == 5.0
    assert a.net_signed_volume == -2.0 + 1.0 + 1.0 + 1.0
    assert abs(a.vwap - (20.0 + 12.0) / 5.0) < 1e-12
    b = out["b"]
    assert b.vwap is None and b.order_flow_imbalance is None and b.volume == 0.0


def test_ties_broken_by_trade_id(spark):
    rows = [("a", 9, 1.0, 1.0, False, T0), ("a", 3, 2.0, 1.0, False, T0), ("a", 5, 3.0, 1.0, False, T0)]
    r = ohlcv_bars(_trades(spark, rows), "10 seconds").collect()[0]
    assert (r.open, r.close) == (2.0, 1.0)


def test_null_trade_id_keeps_its_price(spark):
    rows = [("a", None, 7.0, 1.0, False, T0), ("a", 4, 8.0, 1.0, False, T0 + dt.timedelta(seconds=1)),
            ("b", None, 5.0, 1.0, False, T0), ("b", None, 5.0, 1.0, False, T0 + dt.timedelta(seconds=2)),
            ("c", 1, 1.0, 1.0, False, T0), ("c", None, 2.0, 1.0, False, T0)]
    out = {r.symbol: r for r in ohlcv_bars(_trades(spark, rows), "10 seconds").collect()}
    assert (out["a"].open, out["a"].close) == (7.0, 8.0)
    assert (out["b"].open, out["b"].close) == (5.0, 5.0)
    assert (out["c"].open, out["c"].close) == (2.0, 1.0)      # no id sorts before any id of the instant
    by_struct = {r.symbol: r for r in ohlcv_bars(_trades(spark, rows), "10 seconds",
                                                 ("event_ts", "trade_id", "quantity")).collect()}
    assert {s: (r.open, r.close) for s, r in by_struct.items()} == {s: (r.open, r.close) for s, r in out.items()}


trade = st.tuples(st.sampled_from(["x", "y"]), st.floats(0.5, 1000), st.one_of(st.just(0.0), st.floats(1e-3, 50)),
                  st.booleans(), st.integers(0, 119))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trade, min_size=1, max_size=40))
def test_bar_invariants(spark, rows):
    data = [(s, i, p, q, m, T0 + dt.timedelta(seconds=sec)) for i, (s, p, q, m, sec) in enumerate(rows)]
    out = ohlcv_bars(_trades(spark, data), "30 seconds").collect()
    assert sum(r.trade_count for r in out) == len(rows)
    for r in out:
        assert r.low <= r.open <= r.high and r.low <= r.close <= r.high
        if r.volume and r.volume > 0:
            assert r.low - 1e-9 <= r.vwap <= r.high + 1e-9
            assert abs(r.order_flow_imbalance) <= 1 + 1e-12
