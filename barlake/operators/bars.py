"""Fixed-width OHLCV + order-flow bars per symbol.

One hash aggregation keyed by (window, symbol): Spark runs a partial
aggregation before the shuffle, so only one row per (window, symbol, map
task) crosses the network however many trades there are. open/close are
``min_by``/``max_by`` over a total ordering key, so they are deterministic
after the shuffle; a row with a NULL price gets a NULL key and is ignored,
as first/last with ignorenulls would.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.exprs import notional, ordering_key, safe_div, signed_quantity
from barlake.schemas import BAR_COLUMNS

DEFAULT_WIDTH = "10 seconds"


def ohlcv_bars(trades: DataFrame, width: str = DEFAULT_WIDTH,
               order_cols: Sequence[str] = ("event_ts", "trade_id"),
               time_col: str = "event_ts") -> DataFrame:
    key = ordering_key(trades, order_cols)
    priced_key = F.when(F.col("price").isNotNull(), key)
    agg = (
        trades.groupBy(F.window(time_col, width).alias("w"), F.col("symbol"))
        .agg(
            F.min_by("price", priced_key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", priced_key).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum(notional()).alias("notional"),
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(signed_quantity()).alias("net_signed_volume"),
        )
    )
    return agg.withColumns({
        "window_start": F.col("w.start"), "window_end": F.col("w.end"),
        "vwap": safe_div("notional", "volume"),
        "order_flow_imbalance": safe_div("net_signed_volume", "volume"),
    }).select(*BAR_COLUMNS)


def order_flow(trades: DataFrame) -> DataFrame:
    """Per-trade signed quantity and notional."""
    return trades.select(
        "symbol", "trade_id", "event_ts", "price", "quantity", "is_buyer_maker",
        signed_quantity().alias("signed_qty"), notional().alias("notional"),
    )
