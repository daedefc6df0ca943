"""File-based stand-in for the message bus: encoded trade records written as
time-ordered JSON-lines files, replayed by a file stream (FIXTURES §2.4)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.functions.exprs import utc_wall_clock
from barlake.operators.normalize import encode_trades


def write_record_files(trades: DataFrame, path: str, files: int) -> list[str]:
    """Records ordered by trade time, range-split into ``files`` files whose
    modification times follow that order (the file source replays files by
    modification time). Returns the file paths in replay order."""
    recs = trades.select("trade_time", "trade_id", *[c for c in trades.columns
                                                   if c not in ("trade_time", "trade_id")])
    (encode_trades(recs.repartitionByRange(files, "trade_time", "trade_id")
                   .sortWithinPartitions("trade_time", "trade_id"))
     .write.mode("overwrite").json(path))
    return order_files(trades.sparkSession, path)


def order_files(spark: SparkSession, path: str, base_ms: int = 1_000_000_000_000) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(str(s.getPath().toString()) for s in fs.listStatus(hpath)
                   if s.getPath().getName().startswith("part-"))
    for i, n in enumerate(names):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(n), base_ms + i * 1000, -1)
    return names


def record_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    schema = "key STRING, value STRING"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(path))


def ntz_bars(bars: DataFrame) -> DataFrame:
    """Streamed bars with wall-clock (NTZ) window bounds, for comparison with batch."""
    return bars.withColumn("window_start", utc_wall_clock("window_start")) \
        .withColumn("window_end", utc_wall_clock("window_end"))
