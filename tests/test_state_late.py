import datetime as dt

from pyspark.sql import functions as F

from barlake.operators.bars import ohlcv_bars
from barlake.operators.normalize import decode_trades, encode_trades
from barlake.plans import catalog
from barlake.sources import lake
from barlake.streaming import bars_stream, reconcile, state
from barlake.streaming import files as sfiles
from tests.conftest import SF_SMALL

WIDTH = "1 hour"


def _counts(df):
    return {(r.symbol, r.window_start): r.trade_count for r in df.select("symbol", "window_start", "trade_count").collect()}


def _run(spark, base, files=1000):
    src = decode_trades(sfiles.record_stream(spark, f"{base}/in", files))
    for q in bars_stream.start_pipeline(src, f"{base}/lake", f"{base}/chk", width=WIDTH, available_now=True,
                                        state_partitions=3):
        q.awaitTermination()


def test_closed_windows_leave_the_state_also_after_a_restart(spark, tmp_dir):
    trades = catalog.trades(spark, SF_SMALL)
    middle = trades.agg(F.expr("percentile(trade_time, 0.5)")).first()[0]
    seen = []
    for part in (F.col("trade_time") <= middle, F.col("trade_time") > middle):
        encode_trades(trades.where(part)).coalesce(1).write.mode("append").json(f"{tmp_dir}/in")
        _run(spark, tmp_dir)
        held = state.open_bars(spark, f"{tmp_dir}/chk/bars").collect()
        emitted = _counts(lake.read_partitioned(spark, f"{tmp_dir}/lake/features/bars"))
        raw = lake.read_partitioned(spark, f"{tmp_dir}/lake/raw/trades")
        cut = reconcile.closed_before(raw)
        assert held and all(r.window_end > cut for r in held)                    # closed windows are gone
        assert not {(r.symbol, r.window_start) for r in held} & set(emitted)
        assert emitted | {(r.symbol, r.window_start): r.trade_count for r in held} == _counts(ohlcv_bars(raw, WIDTH))
        seen.append({(r.symbol, r.window_start) for r in held})
    assert seen[0] <= set(emitted) and not seen[0] & seen[1]     # held over the restart, then emitted once


def test_history_of_the_state(spark, tmp_dir):
    sfiles.write_record_files(catalog.trades(spark, SF_SMALL), f"{tmp_dir}/in", 4)
    _run(spark, tmp_dir, 1)
    rows = state.state_history(spark, f"{tmp_dir}/chk/bars").orderBy("batch").collect()
    assert [r.batch for r in rows] == sorted(r.batch for r in rows) and rows[-1].batch == state.batches(
        spark, f"{tmp_dir}/chk/bars")[-1]
    last = state.open_bars(spark, f"{tmp_dir}/chk/bars").agg(F.count("*"), F.sum("trade_count")).first()
    assert (rows[-1].open_bars, rows[-1].trades_held) == tuple(last)
    assert rows[-1].open_bars < max(r.open_bars for r in rows)                 # it shrinks as windows close
    assert all(r.oldest_window_end <= r.newest_window_end for r in rows)


def _files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().collect()}


def test_late_bars_are_found_and_only_their_folders_rewritten(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [(s, i, 10.0 + i, 1.0, t0 + dt.timedelta(minutes=7 * i + k), i % 2 == 0)
            for k, s in enumerate(("aa", "005", "cc")) for i in range(40)]
    schema = "symbol string, trade_id long, price double, quantity double, event_ts timestamp, is_buyer_maker boolean"
    trades = spark.createDataFrame(data, schema)
    late = spark.createDataFrame([("aa", 900, 99.0, 2.0, t0 + dt.timedelta(minutes=65), True),     # bar without it
                                  ("dd", 901, 5.0, 1.0, t0 + dt.timedelta(minutes=3), False),      # no bar at all
                                  ("cc", 902, 1.0, 1.0, t0 + dt.timedelta(minutes=279), True)], schema)   # still open
    cut = reconcile.closed_before(trades)
    path = f"{tmp_dir}/bars"
    lake.write_bars(ohlcv_bars(trades, WIDTH).where(F.col("window_end") <= F.lit(cut)), path)
    before = _files(spark, path)
    every = trades.unionByName(late)
    found = reconcile.repair(spark, every, path, WIDTH).collect()
    h = dt.timedelta(hours=1)
    utc = lambda x: x.replace(tzinfo=None)
    first = utc(ohlcv_bars(trades, WIDTH).agg(F.min("window_start")).first()[0])
    assert {(r.symbol, r.window_start, r.emitted, r.actual) for r in found} == {
        ("aa", first + h, sum(1 for r in data if r[0] == "aa" and t0 + h <= r[4] < t0 + 2 * h), 1 + sum(
            1 for r in data if r[0] == "aa" and t0 + h <= r[4] < t0 + 2 * h)), ("dd", first, 0, 1)}
    after = _files(spark, path)
    same = {f for f in before if "symbol=005" in f or "symbol=cc" in f}
    assert same <= after and not {f for f in before if "symbol=aa" in f} & after
    want = ohlcv_bars(every, WIDTH).where(F.col("window_end") <= F.lit(cut))
    got = lake.read_partitioned(spark, path)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert reconcile.repair(spark, every, path, WIDTH).count() == 0


def test_no_trades(spark, tmp_dir):
    trades = spark.createDataFrame([], "symbol string, trade_id long, price double, quantity double, "
                                       "event_ts timestamp, is_buyer_maker boolean")
    assert reconcile.closed_before(trades) is None
    assert reconcile.late_bars(trades, ohlcv_bars(trades, WIDTH), WIDTH).count() == 0
