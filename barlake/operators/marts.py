"""Marts over the indicator table: labelled ML features and the per-symbol
snapshot (B12, B13, C1, D4, E10, E11, K2)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.indicators import LOOKBACK, technical_features, with_future_close
from barlake.schemas import ML_MART_COLUMNS


def label_up(future="future_close_3", close="close"):
    return F.when(F.col(future) > F.col(close), F.lit(1)).otherwise(F.lit(0)).cast("int")


def ml_features(features: DataFrame) -> DataFrame:
    """Label = close 3 bars ahead above the current close; only rows with a
    known future and a defined volatility."""
    labelled = with_future_close(features)
    return (labelled
            .where(F.col("future_close_3").isNotNull() & F.col("volatility_30").isNotNull())
            .select(*ML_MART_COLUMNS[:-1], label_up().alias("label_up_3")))


def recent_bars(stg: DataFrame, n: int = LOOKBACK + 1) -> DataFrame:
    """The newest ``n`` bars of every symbol; each task keeps ``n`` rows per
    symbol before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy("symbol").orderBy(F.col("window_start").desc())
    return stg.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_indicators(stg: DataFrame) -> DataFrame:
    """Indicator row of the newest bar of every symbol from staged bars (E11):
    the windows run over the look-back it needs, not over the history."""
    return latest_bar(technical_features(recent_bars(stg)))


def latest_bar(features: DataFrame, n: int = 1) -> DataFrame:
    """Newest row per symbol; Catalyst adds a WindowGroupLimit below the Window,
    so each task keeps only n rows per symbol before the final rank."""
    w = Window.partitionBy("symbol").orderBy(F.col("window_start").desc())
    return (features.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n).withColumn("rn", F.col("rn").cast("bigint")))


def symbol_totals(features: DataFrame) -> DataFrame:
    return features.groupBy("symbol").agg(
        F.max("high").alias("high_window"),
        F.min("low").alias("low_window"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("bars"),
    )


def _snapshot_select(df: DataFrame) -> DataFrame:
    return df.select(
        "symbol",
        F.col("window_start").alias("as_of"),
        F.col("close").alias("last_price"),
        F.col("ret_1").alias("last_return"),
        "px_vs_sma30", "volatility_30", "order_flow_imbalance", "rel_volume",
        "high_window", "low_window", "total_volume", "bars",
    )


def symbol_snapshot(stg: DataFrame) -> DataFrame:
    """Latest indicator row per symbol joined USING(symbol) to the totals of
    its staged bars (C1)."""
    return _snapshot_select(latest_indicators(stg).drop("rn").join(symbol_totals(stg), "symbol", "inner"))


_LATEST_COLS = ["window_start", "close", "ret_1", "px_vs_sma30", "volatility_30",
                "order_flow_imbalance", "rel_volume"]


def symbol_snapshot_onepass(features: DataFrame) -> DataFrame:
    """Same result as :func:`symbol_snapshot` from a saved indicator table, in
    one aggregation and one shuffle: each latest value is a fixed-width ``max_by(col, window_start)``, so the
    plan stays a partial + final HashAggregate and no join is needed.
    window_start is unique per symbol, so max_by has no ties."""
    latest = [F.max_by(c, "window_start").alias(c) for c in _LATEST_COLS if c != "window_start"]
    agg = features.groupBy("symbol").agg(
        F.max("window_start").alias("window_start"), *latest,
        F.max("high").alias("high_window"), F.min("low").alias("low_window"),
        F.sum("volume").alias("total_volume"), F.count(F.lit(1)).alias("bars"),
    )
    return _snapshot_select(agg)


def latest_features(features_or_mart: DataFrame, symbol: str | None = None) -> DataFrame:
    """Last feature row of every symbol (or of one, input lower-cased)."""
    df = features_or_mart
    if symbol is not None:
        df = df.where(F.col("symbol") == F.lower(F.lit(symbol)))
    return latest_bar(df).drop("rn")

