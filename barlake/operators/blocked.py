"""Blocked rolling windows: the indicator set without one task per symbol.

``PARTITION BY symbol`` puts a symbol's whole history into one task; with
few symbols and long histories that is a handful of huge, skewed tasks.
Here every bar gets its position ``g`` within its symbol, block = g div B,
and every window runs ``PARTITION BY symbol, block``. A row is also copied,
as halo, into the next block when it is among the last LOOKBACK rows of its
block, and into the previous block when among the first LOOKAHEAD rows. The
deepest look-back of the indicator set is 30 rows (29 rows of log returns,
each one row back) and the deepest look-ahead 3 rows, so every core row sees
exactly the rows it would see in the per-symbol window; halo rows are dropped
afterwards. Task size is bounded by B + 33 rows whatever the number of
symbols or the length of a history.

Positions are a plain part of the plan: bars are counted per (symbol, day),
the counts of earlier days summed per symbol (one row per symbol and day), and
the row number within the day added. Nothing is computed before an action,
nothing is checkpointed, and unused columns are pruned down to the scan."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.indicators import LOOKAHEAD, LOOKBACK, technical_features, with_future_close
from barlake.operators.marts import label_up
from barlake.schemas import ML_MART_COLUMNS
from barlake.sources.lake import save_bucketed

DEFAULT_BLOCK_ROWS = 200_000


def with_position(stg: DataFrame, col: str = "_g") -> DataFrame:
    """0-based position of each bar in its symbol's time order."""
    day = F.to_date("window_start")
    counts = stg.groupBy(F.col("symbol").alias("_s"), day.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_s", "_d", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rows = stg.withColumn("_day", day)
    in_day = F.row_number().over(Window.partitionBy("symbol", "_day").orderBy("window_start"))
    rows = rows.withColumn("_in_day", in_day)
    return (rows.join(starts, rows["symbol"].eqNullSafe(starts["_s"]) & rows["_day"].eqNullSafe(starts["_d"]))
            .withColumn(col, (F.col("_before") + F.col("_in_day") - 1).cast("bigint"))
            .drop("_s", "_d", "_day", "_before", "_in_day"))


def _with_halo(stg: DataFrame, block_rows: int) -> DataFrame:
    if block_rows <= max(LOOKBACK, LOOKAHEAD):
        raise ValueError(f"block_rows must exceed {max(LOOKBACK, LOOKAHEAD)}")
    g = with_position(stg)
    blk = F.floor(F.col("_g") / block_rows)
    off = F.col("_g") - blk * block_rows
    targets = F.array(
        F.struct(blk.alias("b"), F.lit(True).alias("core")),
        F.when(off >= block_rows - LOOKBACK, F.struct((blk + 1).alias("b"), F.lit(False).alias("core"))),
        F.when((off < LOOKAHEAD) & (blk > 0), F.struct((blk - 1).alias("b"), F.lit(False).alias("core"))),
    )
    t = F.explode(F.filter(targets, lambda x: x.isNotNull())).alias("_t")
    return g.select("*", t).select("*", F.col("_t.b").alias("_blk"), F.col("_t.core").alias("_core")) \
        .drop("_t", "_g")


def _window():
    return Window.partitionBy("symbol", "_blk").orderBy("window_start")


def blocked_technical_features(stg: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Same rows and values as :func:`technical_features`."""
    halo = _with_halo(stg, block_rows)
    out = technical_features(halo, _window(), carry=("_core",))
    return out.where("_core").drop("_core")


def blocked_indicators(stg: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Indicator table plus ``future_close_3`` for every bar, in one blocked pass."""
    return block_indicators(_with_halo(stg, block_rows))


def block_indicators(blocks: DataFrame) -> DataFrame:
    """:func:`blocked_indicators` of bars already cut into blocks with their halos. Over a table of
    :func:`save_blocks` every window runs in the task that reads the bucket: the plan has no exchange."""
    w = _window()
    feats = with_future_close(technical_features(blocks, w, carry=("_core", "_blk")), w)
    return feats.where("_core").drop("_core", "_blk")


def save_blocks(stg: DataFrame, name: str, path: str, block_rows: int = DEFAULT_BLOCK_ROWS,
                buckets: int | None = None) -> DataFrame:
    """Bars cut into blocks with their halos, saved as a table bucketed on (symbol, block) and sorted by time.

    ``stg`` is read for the positions and for the rows; give it saved bars, or the trades behind it are aggregated
    twice. Use at least as many buckets as blocks that should run at a time."""
    return save_bucketed(_with_halo(stg, block_rows), name, path, ("symbol", "_blk"),
                         ("symbol", "_blk", "window_start"), buckets)


def mart_from_indicators(ind: DataFrame) -> DataFrame:
    """The labelled mart from :func:`blocked_indicators` output (a filter)."""
    return (ind.where(F.col("future_close_3").isNotNull() & F.col("volatility_30").isNotNull())
            .select(*ML_MART_COLUMNS[:-1], label_up().alias("label_up_3")))


def blocked_ml_features(stg: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Same rows and values as ``ml_features(technical_features(stg))``:
    indicators and the 3-bar look-ahead in one blocked pass."""
    return mart_from_indicators(blocked_indicators(stg, block_rows))
