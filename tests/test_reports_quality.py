import pytest
from pyspark.sql import Row

from barlake.operators import quality, report
from barlake.plans import catalog
from tests.conftest import SF_SMALL

FACTS = "symbol string, last_price double, last_return double, px_vs_sma30 double, volatility_30 double, " \
        "order_flow_imbalance double, rel_volume double"


def test_empty_summary(spark):
    empty = spark.createDataFrame([], FACTS)
    r = report.market_summary(empty).first()
    assert r.assets == 0 and r.summary == report.EMPTY_SUMMARY


def test_line_template_and_nan(spark):
    facts = spark.createDataFrame([
        Row(symbol="btcusdt", last_price=1.0, last_return=0.0123, px_vs_sma30=0.01, volatility_30=0.005,
            order_flow_imbalance=0.06, rel_volume=1.0),
        Row(symbol="ethusdt", last_price=1.0, last_return=float("nan"), px_vs_sma30=None, volatility_30=None,
            order_flow_imbalance=-0.2, rel_volume=None),
    ], FACTS)
    lines = {r.symbol: r.line for r in report.symbol_descriptions(facts).collect()}
    assert lines["btcusdt"] == ("BTC: last move +1.23%, trading above its 30-bar average (bullish momentum), "
                                "elevated volatility, order flow shows net buying.")
    assert lines["ethusdt"] == ("ETH: last move +0.00%, trading below its 30-bar average (bearish momentum), "
                                "subdued volatility, order flow shows net selling.")
    s = report.market_summary(facts).first().summary
    assert s.startswith("Market read (2 assets) — tone is cautious.\n\n- BTC:")
    assert report.market_tone(facts).first().tone == "cautious"


def test_checks_pass_on_fixture_and_fail_on_bad_rows(spark):
    f = catalog.feats(spark, SF_SMALL)
    from barlake.operators import marts
    mart, snap = marts.ml_features(f), marts.symbol_snapshot_onepass(f)
    rep = quality.enforce(quality.quality_report(catalog.bars(spark, SF_SMALL), mart, snap))
    assert rep.count() == 11
    dup = snap.unionByName(snap)
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.snapshot_checks(dup))
    assert quality.nonpositive_prices(mart).count() == 0


def test_number_texts_round_the_binary_value(spark):
    """Ties go to even and decimals that are not exact round as they are stored, as printf does."""
    from pyspark.sql import functions as F

    from barlake.functions.exprs import fixed_text
    values = [0.125, 2.675, 1.005, -0.125, -2.5, 0.0, 1234567.125, -0.001, 0.375, 0.005, 0.0005, -0.005, 0.00049, 0.0051]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fixed_text("x", 2, sign=True)).collect()]
    assert got == [f"{v:+.2f}" for v in values]
    assert [r[0] for r in df.select(fixed_text("x", 3)).collect()] == [f"{v:.3f}" for v in values]
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r[0] for r in odd.select(fixed_text("x", 2, sign=True)).collect()] == [
        r[0] for r in odd.select(F.format_string("%+.2f", "x")).collect()]
