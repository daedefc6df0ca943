"""Message-bus (Kafka) source and sink options.

The Kafka connector jar is not part of every installation, so option
building is kept in pure functions and the decode / encode steps are the
ones of :mod:`barlake.operators.normalize`, testable on file streams."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from barlake.operators.normalize import decode_trades, encode_trades


def source_options(topic: str, servers: str | None = None, starting: str = "latest",
                   max_per_trigger: int | None = 20_000) -> dict[str, str]:
    """Reader options; ``max_per_trigger=None`` takes all new records at each trigger."""
    servers = servers or os.environ.get("BUS_BOOTSTRAP_SERVERS", "localhost:9092")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def sink_options(topic: str, servers: str | None = None) -> dict[str, str]:
    servers = servers or os.environ.get("BUS_BOOTSTRAP_SERVERS", "localhost:9092")
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": "lz4",
        "kafka.enable.idempotence": "true",
        "kafka.acks": "all",
    }


def read_records(spark: SparkSession, topic: str = "trades", **kw) -> DataFrame:
    """Streaming records of the bus as they are; feed them to
    ``bars_stream.start_record_pipeline``, which keeps undecodable ones."""
    return spark.readStream.format("kafka").options(**source_options(topic, **kw)).load()


def read_trades(spark: SparkSession, topic: str = "trades", **kw) -> DataFrame:
    """Streaming trades from the bus, decoded, with event time (no rejects)."""
    return decode_trades(read_records(spark, topic, **kw))


def write_trades(trades: DataFrame, topic: str = "trades", **kw):
    """Batch publish of normalised trades as keyed JSON (at-least-once)."""
    encode_trades(trades).write.format("kafka").options(**sink_options(topic, **kw)).save()


def publish_stream(trades: DataFrame, checkpoint: str, topic: str = "trades", **kw):
    """Continuous publish of normalised trades (e.g. the output of
    ``normalize_trades`` over a raw-message stream) as keyed JSON records.
    Spark's Kafka sink is at-least-once; the checkpoint tracks progress."""
    return (encode_trades(trades).writeStream.format("kafka").options(**sink_options(topic, **kw))
            .option("checkpointLocation", checkpoint).outputMode("append").start())
