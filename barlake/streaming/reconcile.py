"""Late trades: the raw lake against the bars that were emitted, and the repair of the bar lake (I4).

The bar query drops trades whose window the watermark has closed; the raw query stores them all the same. Counting the
raw lake again per window shows the bars that lack trades. Repaired bars are computed from the raw trades of their
windows only; the bar lake gets them by overwriting the symbol folders concerned, and no others."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.bars import DEFAULT_WIDTH, ohlcv_bars
from barlake.schemas import BAR_COLUMNS
from barlake.session import scratch_path
from barlake.sources import lake
from barlake.streaming.bars_stream import WATERMARK


def closed_before(trades: DataFrame, delay: str = WATERMARK) -> dt.datetime | None:
    """Windows that end at or before this time are closed: the newest event time less the delay. One value reaches the
    driver; None without a trade."""
    return trades.agg(F.expr(f"max(event_ts) - INTERVAL '{delay}'")).first()[0]


def late_bars(trades: DataFrame, bars: DataFrame, width: str = DEFAULT_WIDTH, delay: str = WATERMARK,
              before: dt.datetime | None = None) -> DataFrame:
    """(symbol, window_start, window_end, emitted, actual): closed windows whose bar holds another number of trades than
    the raw lake; a bar that was never emitted counts as 0.

    Counting needs no prices: the scan of the raw lake reads the event time and the symbol folders, and one row per
    window, symbol and task is shuffled."""
    before = before or closed_before(trades, delay)
    actual = (trades.where("event_ts IS NOT NULL").groupBy(F.window("event_ts", width).alias("w"), "symbol")
              .agg(F.count(F.lit(1)).alias("actual"))
              .select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "actual"))
    emitted = bars.select(F.col("symbol").alias("_s"), F.col("window_start").alias("_w"),
                          F.col("trade_count").alias("emitted"))
    found = actual.join(emitted, actual["symbol"].eqNullSafe(F.col("_s")) & (actual["window_start"] == F.col("_w")),
                        "left")
    emitted_or_none = F.coalesce("emitted", F.lit(0)).cast("bigint")
    return (found.where((F.col("window_end") <= F.lit(before)) & (emitted_or_none != F.col("actual")))
            .select("symbol", "window_start", "window_end", emitted_or_none.alias("emitted"), "actual"))


def repair(spark: SparkSession, trades: DataFrame, path: str, width: str = DEFAULT_WIDTH,
           delay: str = WATERMARK) -> DataFrame:
    """Brings the bar lake at ``path`` (written by :func:`barlake.sources.lake.write_bars` or ``compact``; a folder that
    a streaming sink owns keeps its own list of files and must be compacted first) up to the raw trades. Returns the
    bars that were late, as found. The new folders are written beside the lake first and swapped in by one commit, so a
    failure before it leaves the lake as it was; running it again finds nothing."""
    bars = lake.read_partitioned(spark, path)
    stage = scratch_path(spark, "repair")
    late_bars(trades, bars, width, delay).write.parquet(f"{stage}/late")
    late = spark.read.parquet(f"{stage}/late")
    if late.limit(1).count() == 0:
        return late
    keys = late.select(F.col("symbol").alias("_s"), F.col("window_start").alias("_w"))

    def of_late(df: DataFrame, start: str, how: str) -> DataFrame:
        return df.join(keys, df["symbol"].eqNullSafe(keys["_s"]) & (df[start] == keys["_w"]), how)
    windowed = trades.withColumn("_start", F.window("event_ts", width)["start"])
    mended = ohlcv_bars(of_late(windowed, "_start", "left_semi").drop("_start"), width)
    touched = keys.select("_s").distinct()
    rest = of_late(bars.join(touched, bars["symbol"].eqNullSafe(touched["_s"]), "left_semi"), "window_start", "left_anti")
    rest.select(*BAR_COLUMNS).unionByName(mended).write.parquet(f"{stage}/bars")
    lake.write_bars(spark.read.parquet(f"{stage}/bars"), path, dynamic=True)
    return late
