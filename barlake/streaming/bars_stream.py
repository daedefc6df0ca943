"""Streaming bar job.

The bar aggregation is the batch one (:func:`barlake.operators.bars.ohlcv_bars`)
under an event-time watermark: state per (window, symbol) lives in the state
store until the watermark passes the window end, then the bar is emitted once
(append mode) and its state dropped, so state stays bounded by the watermark.
Each sink has its own checkpoint; file sink + checkpoint is exactly-once."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from barlake.functions.exprs import epoch_micros
from barlake.operators.bars import DEFAULT_WIDTH, ohlcv_bars
from barlake.operators.normalize import decode_rejects, decode_trades, normalize_rejects, normalize_trades

WATERMARK = "30 seconds"
TRIGGER = "10 seconds"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk, with
    changelog checkpointing) instead of executor heap maps - for many
    symbols x open windows. Must be set before a query's first run; an
    existing checkpoint keeps the provider it was started with. Does not
    override a provider the cluster already configured."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def watermarked(trades: DataFrame, delay: str = WATERMARK, time_col: str = "event_ts") -> DataFrame:
    """Event-time watermark; a TIMESTAMP_NTZ event time is read as UTC."""
    dtype = trades.schema[time_col].dataType
    if dtype.simpleString() == "timestamp_ntz":
        trades = trades.withColumn(time_col, F.timestamp_micros(epoch_micros(F.col(time_col), dtype)))
    return trades.withWatermark(time_col, delay)


def stream_bars(trades: DataFrame, width: str = DEFAULT_WIDTH, delay: str = WATERMARK) -> DataFrame:
    return ohlcv_bars(watermarked(trades, delay), width, ("event_ts", "trade_id"))


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or TRIGGER)


def _start(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a query with its own shuffle width. Streaming has no adaptive
    coalescing and the width of a stateful query is fixed by its checkpoint
    at the first run, so it is chosen here, not inherited by accident; the
    query copies the session conf at start, the caller's value is restored."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                       trigger: str | None = TRIGGER, available_now: bool = False,
                       state_partitions: int | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("symbol").outputMode("append"))
    if name:
        w = w.queryName(name)
    return _start(_trigger(w, trigger, available_now), df.sparkSession, state_partitions)


def start_raw_sink(trades: DataFrame, lake_root: str, checkpoint_root: str, delay: str = WATERMARK,
                   trigger: str | None = TRIGGER, available_now: bool = False) -> StreamingQuery:
    """Decoded trades, partitioned by symbol (A3)."""
    return start_parquet_sink(watermarked(trades, delay), f"{lake_root.rstrip('/')}/raw/trades",
                              f"{checkpoint_root.rstrip('/')}/raw_trades", trigger=trigger,
                              available_now=available_now)


def start_bar_sink(trades: DataFrame, lake_root: str, checkpoint_root: str, width: str = DEFAULT_WIDTH,
                   delay: str = WATERMARK, trigger: str | None = TRIGGER, available_now: bool = False,
                   state_partitions: int | None = None) -> StreamingQuery:
    """Watermarked bars, partitioned by symbol (A4)."""
    return start_parquet_sink(stream_bars(trades, width, delay), f"{lake_root.rstrip('/')}/features/bars",
                              f"{checkpoint_root.rstrip('/')}/bars", trigger=trigger, available_now=available_now,
                              state_partitions=state_partitions)


def start_pipeline(trades: DataFrame, lake_root: str, checkpoint_root: str, width: str = DEFAULT_WIDTH,
                   delay: str = WATERMARK, trigger: str | None = TRIGGER, available_now: bool = False,
                   state_partitions: int | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries over one source definition: raw trades and
    bars, each with its own checkpoint (I8)."""
    return (start_raw_sink(trades, lake_root, checkpoint_root, delay, trigger, available_now),
            start_bar_sink(trades, lake_root, checkpoint_root, width, delay, trigger, available_now,
                           state_partitions))


def start_message_pipeline(messages: DataFrame, lake_root: str, checkpoint_root: str,
                           width: str = DEFAULT_WIDTH, delay: str = WATERMARK, trigger: str | None = TRIGGER,
                           available_now: bool = False, value_col: str = "value",
                           state_partitions: int | None = None):
    """Raw exchange messages in, normalised as a column stage (no separate
    producer process): raw trades, bars and rejected messages, three queries
    with their own checkpoints."""
    lake_root, checkpoint_root = lake_root.rstrip("/"), checkpoint_root.rstrip("/")
    trades = normalize_trades(messages, value_col).withColumn("event_ts", F.timestamp_millis("trade_time"))
    raw, bars = start_pipeline(trades, lake_root, checkpoint_root, width, delay, trigger, available_now,
                               state_partitions)
    rejects = _reject_sink(normalize_rejects(messages, value_col), f"{lake_root}/rejects/messages",
                           f"{checkpoint_root}/rejects", trigger, available_now)
    return raw, bars, rejects


def _reject_sink(rejects: DataFrame, path: str, checkpoint: str, trigger: str | None,
                 available_now: bool) -> StreamingQuery:
    w = (rejects.writeStream.format("json").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, trigger, available_now).start()


def start_record_pipeline(records: DataFrame, lake_root: str, checkpoint_root: str, width: str = DEFAULT_WIDTH,
                          delay: str = WATERMARK, trigger: str | None = TRIGGER, available_now: bool = False,
                          value_col: str = "value", state_partitions: int | None = None):
    """Bus records in (:func:`barlake.sources.bus.read_records`): raw trades,
    bars, and the records that do not decode to a trade with symbol and event
    time; three queries with their own checkpoints."""
    lake_root, checkpoint_root = lake_root.rstrip("/"), checkpoint_root.rstrip("/")
    raw, bars = start_pipeline(decode_trades(records, value_col), lake_root, checkpoint_root, width, delay, trigger,
                               available_now, state_partitions)
    rejects = _reject_sink(decode_rejects(records, value_col), f"{lake_root}/rejects/records",
                           f"{checkpoint_root}/record_rejects", trigger, available_now)
    return raw, bars, rejects


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until any of the session's queries ends (I8)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def _dropped(progress) -> int:
    return sum(int(op.numRowsDroppedByWatermark or 0) for op in progress.stateOperators)


class LateRows(StreamingQueryListener):
    """Running total of numRowsDroppedByWatermark per query run, from every
    progress report (a query object itself keeps only the newest hundred).
    Counted after partial aggregation: late groups, not late rows. Add it
    with ``spark.streams.addListener`` before the queries start; reports
    arrive shortly after their batch."""

    def __init__(self):
        self.total: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.total.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        self.total[run] = self.total.get(run, 0) + _dropped(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.total.get(str(query.runId), 0)
