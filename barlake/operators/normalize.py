"""Exchange-message normalisation and trade decoding.

Everything is a column expression over the JSON text, so the same plan
runs in batch and in Structured Streaming. Bad input does not stop the
job: it is routed to a reject DataFrame with a reason."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schemas import TRADE_SCHEMA

_REQUIRED = ["symbol", "trade_id", "price", "quantity", "trade_time", "is_buyer_maker"]
# Payload keys differ only in case (e/E, t/T); json_tuple matches keys
# exactly, where struct field resolution would be case-insensitive.
_PAYLOAD_KEYS = ["e", "s", "t", "p", "q", "T", "m"]


def parse_messages(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Message text -> one column per payload key (``_e`` ... ``_m``) plus
    ``_raw`` and ``_json`` (the text is a JSON object). Envelope unwrap: the ``data`` object when present, else the
    root object. Two json_tuple passes parse each message twice at most."""
    keep = list(keep or [])
    text = F.col(value_col).cast("string")
    env = messages.select(*keep, text.alias("_raw"), F.json_tuple(text, "data").alias("_data"))
    payload_text = F.coalesce(F.col("_data"), F.col("_raw"))
    names = [f"_{k}" if k != "T" else "_tt" for k in _PAYLOAD_KEYS]
    parsed = env.select(*keep, "_raw", F.json_tuple(payload_text, *_PAYLOAD_KEYS).alias(*names))
    # Readable text without an event type (a subscription answer, ``{}``) is no trade; only text that is not a
    # JSON object is malformed. A message with an event type has been read already.
    readable = F.col("_e").isNotNull() | F.coalesce(
        F.schema_of_variant(F.try_parse_json("_raw")).startswith("OBJECT"), F.lit(False))
    return parsed.withColumn("_json", readable)


def _canonical() -> list[Column]:
    return [
        F.lower("_s").alias("symbol"),
        F.col("_t").try_cast("bigint").alias("trade_id"),
        F.col("_p").try_cast("double").alias("price"),
        F.col("_q").try_cast("double").alias("quantity"),
        F.col("_tt").try_cast("bigint").alias("trade_time"),
        F.col("_m").try_cast("boolean").alias("is_buyer_maker"),
    ]


def _classified(messages: DataFrame, value_col: str, keep: list[str]) -> DataFrame:
    parsed = parse_messages(messages, value_col, keep)
    df = parsed.select(*keep, "_raw", "_json", "_e", *_canonical())
    missing = F.lit(False)
    for c in _REQUIRED:
        missing = missing | F.col(c).isNull()
    reason = (F.when(~F.col("_json"), F.lit("malformed"))
              .when(F.col("_e").isNull() | (F.col("_e") != "trade"), F.lit(None))
              .when(missing, F.lit("bad_field")))
    return df.withColumn("_reason", reason)


def normalize_trades(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = (),
                     with_ingest_time: bool = True) -> DataFrame:
    """Raw exchange messages -> canonical trades (only ``e == 'trade'``)."""
    df = _classified(messages, value_col, list(keep))
    out = df.where((F.col("_e") == "trade") & F.col("_reason").isNull())
    cols = list(keep) + _REQUIRED
    if with_ingest_time:
        out = out.withColumn("ingest_time", F.unix_millis(F.current_timestamp()))
        cols.append("ingest_time")
    return out.select(*cols)


def normalize_rejects(messages: DataFrame, value_col: str = "value",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages that could not be read: text that is no JSON object, or a trade
    with a missing / non-castable field. Messages of another or no event type
    are not rejects; they are skipped."""
    df = _classified(messages, value_col, list(keep))
    return df.where(F.col("_reason").isNotNull()).select(
        *keep, F.col("_raw").alias("value"), F.col("_reason").alias("reason"))


def encode_trades(trades: DataFrame) -> DataFrame:
    """Keyed JSON records for a message bus (A2): key = symbol, value = JSON."""
    fields = [f.name for f in TRADE_SCHEMA.fields if f.name in trades.columns]
    return trades.select(F.col("symbol").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def decode_trades(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Bus records -> typed trades with event time (B5, B6). Records without a
    symbol or an event time cannot enter a bar; they are the rows of
    :func:`decode_rejects`, which the streaming pipeline writes to a sink of
    their own."""
    t = F.from_json(F.col(value_col).cast("string"), TRADE_SCHEMA)
    df = records.select(t.alias("t")).select("t.*")
    df = df.withColumn("event_ts", F.timestamp_millis("trade_time"))
    return df.where(F.col("symbol").isNotNull() & F.col("event_ts").isNotNull())


def decode_rejects(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Records :func:`decode_trades` leaves out, with the text and the reason."""
    text = F.col(value_col).cast("string")
    t = records.select(text.alias("value"), F.from_json(text, TRADE_SCHEMA).alias("t"))
    reason = (F.when(F.col("t.symbol").isNull() & F.col("t.trade_time").isNull(), F.lit("malformed"))
              .when(F.col("t.symbol").isNull(), F.lit("no_symbol"))
              .when(F.col("t.trade_time").isNull(), F.lit("no_event_time")))
    return t.select("value", reason.alias("reason")).where("reason IS NOT NULL")
