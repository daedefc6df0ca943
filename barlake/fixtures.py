"""Adapters from the driver's test tables to the engine's inputs (FIXTURES.md §2).

Each adapter is a projection over a parquet scan, so filters and column
pruning still reach the scan."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import epoch_micros

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Ordering keys used to break ties inside a bar (open = first, close = last).
EVENTS_ORDER = ("event_ts", "trade_id")
LINEITEM_ORDER = ("event_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    """events -> canonical trades; event time stays TIMESTAMP_NTZ in batch."""
    ts_type = events.schema["ts"].dataType
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.floor(epoch_micros(F.col("ts"), ts_type) / 1000).cast("bigint").alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        F.lit(None).cast("bigint").alias("ingest_time"),
        F.col("ts").alias("event_ts"),
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> trades with a day-grain event time; keeps the tie-break columns."""
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return lineitem.select(
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("symbol"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        price.alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_linenumber") % 2 == 0).alias("is_buyer_maker"),
        F.col("l_shipdate").alias("event_ts"),
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """events -> raw exchange JSON text (FIXTURES §2.2): upper-case symbol,
    decimal strings, a non-trade type for 'error', bare payload for every
    third id, and broken text for every 101st id (reject path)."""
    ts_type = events.schema["ts"].dataType
    trade_ms = F.floor(epoch_micros(F.col("ts"), ts_type) / 1000).cast("bigint")
    payload = F.struct(
        F.when(F.col("event_type") == "error", F.lit("depthUpdate")).otherwise(F.lit("trade")).alias("e"),
        trade_ms.alias("E"),
        F.upper("event_type").alias("s"),
        F.col("event_id").alias("t"),
        F.col("value").cast("string").alias("p"),
        F.get_json_object("props", "$.k").alias("q"),
        trade_ms.alias("T"),
        (F.col("user_id") % 2 == 0).alias("m"),
    )
    stream = F.concat(F.lower("event_type"), F.lit("@trade"))
    text = F.when(F.col("event_id") % 3 == 0, F.to_json(payload)).otherwise(
        F.to_json(F.struct(stream.alias("stream"), payload.alias("data"))))
    text = F.when(F.col("event_id") % 101 == 0, F.concat(F.lit("{broken:"), text)).otherwise(text)
    return events.select(F.col("event_id").alias("msg_id"), text.alias("value"))
