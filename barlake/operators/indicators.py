"""Rolling indicators over bars.

All frames are ROW frames of ``PARTITION BY symbol ORDER BY window_start``.
Catalyst plans the two levels (returns, then rolling statistics over the
returns) as Window operators over a single shuffle by symbol. For few
symbols with long histories use :mod:`barlake.operators.blocked`, which
computes the same columns over bounded blocks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.exprs import log_ratio, ratio_minus_one, safe_div
from barlake.schemas import TECHNICAL_COLUMNS

# Look-back / look-ahead depth in bars of the whole indicator set: the
# deepest look-back is 29 rows of log_ret_1, which itself looks one row back.
LOOKBACK = 30
LOOKAHEAD = 3


def symbol_window(partition=("symbol",), order=("window_start",)) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*order)


def with_returns(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    w = w or symbol_window()
    prev = F.lag("close", 1).over(w)
    return bars.select("*", ratio_minus_one("close", prev).alias("ret_1"),
                       log_ratio("close", prev).alias("log_ret_1"))


def with_rolling(rets: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    w = w or symbol_window()
    w6, w30 = w.rowsBetween(-5, Window.currentRow), w.rowsBetween(-29, Window.currentRow)
    return rets.select(
        "*",
        F.avg("close").over(w6).alias("sma_6"),
        F.avg("close").over(w30).alias("sma_30"),
        F.stddev_samp("log_ret_1").over(w30).alias("volatility_30"),
        F.avg("order_flow_imbalance").over(w6).alias("ofi_6"),
        F.avg("volume").over(w30).alias("avg_volume_30"),
    )


def technical_features(stg: DataFrame, w: WindowSpec | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    rolled = with_rolling(with_returns(stg, w), w)
    return rolled.select(
        *carry,
        *TECHNICAL_COLUMNS[:TECHNICAL_COLUMNS.index("sma_6") + 2],
        (safe_div("close", "sma_30") - 1).alias("px_vs_sma30"),
        "volatility_30", "ofi_6",
        safe_div("volume", "avg_volume_30").alias("rel_volume"),
    )


def with_future_close(df: DataFrame, w: WindowSpec | None = None, steps: int = 3) -> DataFrame:
    w = w or symbol_window()
    return df.select("*", F.lead("close", steps).over(w).alias(f"future_close_{steps}"))
