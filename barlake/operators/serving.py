"""Serving queries of the dashboard and the scoring API as DataFrames
(B15, B17, D6, F1, F4, K8, L5, L6)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import fixed_text
from barlake.operators.indicators import LOOKBACK, technical_features
from barlake.operators.marts import latest_bar
from barlake.schemas import FEATURE_COLUMNS

BAR_SERIES = ["window_start", "open", "high", "low", "close", "vwap", "volume", "volatility_30",
              "px_vs_sma30", "order_flow_imbalance", "rel_volume"]
RAW_SERIES = BAR_SERIES[:7]


def symbols(features: DataFrame) -> DataFrame:
    """Distinct symbols, sorted."""
    return features.select("symbol").distinct().orderBy("symbol")


def symbol_bars(features: DataFrame, symbol: str, limit: int = 300) -> DataFrame:
    """The last ``limit`` bars of one symbol in ascending time (F1, L6) of a
    saved table: the symbol filter is pushed to the scan and the top-k is a
    TakeOrderedAndProject, no full sort. Over staged bars use
    :func:`recent_symbol_bars`, which windows only the newest bars."""
    # the indicator series when the input has them, else the raw bar series
    cols = BAR_SERIES if all(c in features.columns for c in BAR_SERIES) else RAW_SERIES
    last = (features.where(F.col("symbol") == F.lower(F.lit(symbol)))
            .orderBy(F.col("window_start").desc()).limit(limit).select(*cols))
    return last.orderBy("window_start")


def recent_symbol_bars(stg: DataFrame, symbol: str, limit: int = 300) -> DataFrame:
    """The last ``limit`` indicator rows of one symbol computed from staged
    bars without touching older history: the cut-off time of the newest
    ``limit + LOOKBACK`` bars is found by a top-k over the symbol's
    (partition-pruned) bars, then passed as a literal so it reaches the scan
    as a pushed filter; indicators run on that slice, the first LOOKBACK rows
    serve only as look-back and are cut. One timestamp reaches the driver."""
    sym = stg.where(F.col("symbol") == F.lower(F.lit(symbol)))
    cut = (sym.select("window_start").orderBy(F.col("window_start").desc()).limit(limit + LOOKBACK)
           .agg(F.min("window_start").alias("c")).first()["c"])
    if cut is None:
        return symbol_bars(technical_features(sym), symbol, limit)
    recent = sym.where(F.col("window_start") >= F.lit(cut))
    return symbol_bars(technical_features(recent), symbol, limit)


def served_table(spark: SparkSession, *tables: str) -> DataFrame | None:
    """The first of the tables that exists (A10): the indicator table, else raw bars."""
    for name in tables:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def kpi_tiles(features: DataFrame) -> DataFrame:
    """Latest bar of every symbol as KPI texts (L5), from indicator rows."""
    last = latest_bar(features).drop("rn")
    return last.select(
        "symbol", "close", "px_vs_sma30", "volatility_30", "order_flow_imbalance",
        F.concat(F.lit("$"), F.format_number("close", 2)).alias("last_price_text"),
        F.concat(fixed_text(F.col("px_vs_sma30") * 100, 2, sign=True), F.lit("%")).alias("vs_sma30_text"),
        F.concat(fixed_text(F.col("volatility_30") * 100, 3), F.lit("%")).alias("volatility_text"),
        fixed_text("order_flow_imbalance", 2, sign=True).alias("ofi_text"),
    )


# Request defaults of the scoring interface: every feature 0.0, except
# relative volume 1.0; these three must not be negative.
REQUEST_DEFAULTS = {c: 0.0 for c in FEATURE_COLUMNS} | {"rel_volume": 1.0}
NON_NEGATIVE = ("volatility_30", "rel_volume", "trade_count")


def apply_request_defaults(requests: DataFrame) -> DataFrame:
    cols = []
    for c in FEATURE_COLUMNS:
        v = F.col(c).cast("double") if c in requests.columns else F.lit(None).cast("double")
        cols.append(F.coalesce(v, F.lit(REQUEST_DEFAULTS[c])).alias(c))
    keep = [c for c in requests.columns if c not in FEATURE_COLUMNS]
    return requests.select(*keep, *cols)


def _valid() -> F.Column:
    ok = F.lit(True)
    for c in NON_NEGATIVE:
        ok = ok & (F.col(c) >= 0)
    return ok


def validate_requests(requests: DataFrame) -> DataFrame:
    """Defaults filled, plus ``accepted`` (all constraints hold)."""
    return apply_request_defaults(requests).withColumn("accepted", _valid())


def accepted_requests(requests: DataFrame) -> DataFrame:
    return validate_requests(requests).where("accepted").drop("accepted")


def round_half_up(c, places: int) -> F.Column:
    p = float(10 ** places)
    return F.round(F.col(c) * p if isinstance(c, str) else c * p) / p


def decide(scored: DataFrame, prob_col: str = "prob_up") -> DataFrame:
    """Direction and confidence from a probability (K8): 'up' when p >= 0.5,
    confidence = 2 * |p - 0.5|; both numbers rounded to 4 places."""
    p = F.col(prob_col)
    return scored.withColumn("direction", F.when(p >= 0.5, F.lit("up")).otherwise(F.lit("down"))) \
        .withColumn("confidence", round_half_up(F.abs(p - 0.5) * 2, 4)) \
        .withColumn(prob_col, round_half_up(p, 4))
