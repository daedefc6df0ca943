"""What a streaming query holds between batches, read from its checkpoint.

The state data source reads the state store of the bar query as a table: one row per open (window, symbol) with the
buffers of the aggregation. Nothing of the running query is touched, and any batch that the checkpoint still keeps can
be read, so the bound on the state (a bar leaves it once the watermark has passed its window) is a query like any other."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import safe_div
from barlake.schemas import BAR_COLUMNS

# Buffers of the bar aggregation in the order of its expressions. The state store names them after their functions,
# several alike, so they are told apart by place.
BUFFERS = ("open double, open_key decimal(38,0), high double, low double, close double, close_key decimal(38,0), "
           "volume double, notional double, trade_count bigint, net_signed_volume double")


def _state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    reader = spark.read.format("statestore")
    return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def open_bars(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Bars of the windows still open after the newest batch (or the given one), as they stand: the columns of a bar.
    They are provisional - later trades still change them - and none of them has been emitted."""
    fields = ", ".join(f.replace(" ", ": ", 1) for f in BUFFERS.split(", "))
    held = _state(spark, checkpoint, batch).select(
        F.col("key.window").alias("w"), F.col("key.symbol").alias("symbol"), F.col("value").cast(f"struct<{fields}>").alias("v"))
    return held.select("w", "symbol", "v.*").withColumns({
        "window_start": F.col("w.start"), "window_end": F.col("w.end"), "vwap": safe_div("notional", "volume"),
        "order_flow_imbalance": safe_div("net_signed_volume", "volume")}).select(*BAR_COLUMNS)


def batches(spark: SparkSession, checkpoint: str) -> range:
    """Batches whose state the checkpoint still keeps."""
    r = (spark.read.format("state-metadata").load(checkpoint)
         .agg(F.min("minBatchId"), F.max("maxBatchId")).first())
    return range(r[0], r[1] + 1) if r[0] is not None else range(0)


def state_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch, open_bars, trades_held, oldest_window_end, newest_window_end) per kept batch with open bars: the size of
    the state over time. One small read per batch; Spark keeps a hundred batches unless told otherwise."""
    def of(batch: int) -> DataFrame:
        return open_bars(spark, checkpoint, batch).agg(
            F.count(F.lit(1)).alias("open_bars"), F.sum("trade_count").alias("trades_held"),
            F.min("window_end").alias("oldest_window_end"), F.max("window_end").alias("newest_window_end")
        ).select(F.lit(batch).cast("bigint").alias("batch"), "*")
    return reduce(DataFrame.unionByName, map(of, batches(spark, checkpoint))).where("open_bars > 0")
