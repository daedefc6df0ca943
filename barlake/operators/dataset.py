"""Training frame, feature matrix and time-ordered splits (A10, B14, B16,
E12, F2, K1, K3, K4, D10)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.index import with_global_index
from barlake.schemas import FEATURE_COLUMNS, LABEL_COLUMN

TIME_ORDER = ("window_start", "symbol")   # ties in time broken by symbol
MIN_TRAIN_ROWS = 200
N_FOLDS = 5
HOLDOUT_FRACTION = 0.8


def clean(mart: DataFrame) -> DataFrame:
    """±inf -> NULL, then drop rows with NULL or NaN in a feature or the label."""
    cols = []
    for c in mart.columns:
        if c in FEATURE_COLUMNS:
            v = F.col(c).cast("double")
            cols.append(F.when(F.abs(v) != float("inf"), v).alias(c))
        else:
            cols.append(F.col(c))
    df = mart.select(*cols)
    ok = F.col(LABEL_COLUMN).isNotNull()
    for c in FEATURE_COLUMNS:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return df.where(ok)


def time_index(df: DataFrame, col: str = "row_idx") -> DataFrame:
    """Global 0-based position in time order (E12); distributed, see
    :mod:`barlake.functions.index`."""
    return with_global_index(df, TIME_ORDER, col)


def training_frame_from(mart: DataFrame) -> DataFrame:
    """Cleaned, time-indexed training frame (K1)."""
    return time_index(clean(mart))


def training_frame(spark: SparkSession, mart_table: str = "marts.mart_ml_features",
                   rebuild=None) -> DataFrame:
    """The mart when the table exists, else the frame rebuilt from raw bars
    by ``rebuild()`` with the same functions (A10)."""
    if spark.catalog.tableExists(mart_table):
        mart = spark.table(mart_table)
    elif rebuild is not None:
        mart = rebuild()
    else:
        raise LookupError(f"{mart_table} does not exist and no rebuild was given")
    return training_frame_from(mart)


def feature_matrix(df: DataFrame, keep: tuple[str, ...] = ("symbol", "window_start")) -> DataFrame:
    """Features as DOUBLE in fixed order, label as INT."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS],
                     F.col(LABEL_COLUMN).cast("int").alias(LABEL_COLUMN))


def row_count(indexed: DataFrame) -> int:
    """n of a checkpointed, indexed frame (one number to the driver)."""
    return indexed.count()


def fold_bounds(n: int, folds: int = N_FOLDS) -> list[tuple[int, int]]:
    """Expanding-window folds (K3): with t = n // (folds + 1), fold k tests
    rows [n - (folds-k) t, n - (folds-1-k) t) and trains on all rows before."""
    t = n // (folds + 1)
    return [(n - (folds - k) * t, n - (folds - 1 - k) * t) for k in range(folds)] if t > 0 else []


def walk_forward_folds(indexed: DataFrame, idx: str = "row_idx", folds: int = N_FOLDS,
                       n: int | None = None) -> DataFrame:
    """``test_fold`` = the fold that tests a row (NULL: rows only ever trained on)."""
    n = row_count(indexed) if n is None else n
    expr = F.lit(None).cast("int")
    for k, (lo, hi) in reversed(list(enumerate(fold_bounds(n, folds)))):
        expr = F.when((F.col(idx) >= lo) & (F.col(idx) < hi), F.lit(k)).otherwise(expr)
    return indexed.withColumn("test_fold", expr)


def fold_rows(indexed: DataFrame, fold: int, n: int, idx: str = "row_idx",
              folds: int = N_FOLDS) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one fold: a row-range filter each."""
    lo, hi = fold_bounds(n, folds)[fold]
    return indexed.where(F.col(idx) < lo), indexed.where((F.col(idx) >= lo) & (F.col(idx) < hi))


def holdout_split(indexed: DataFrame, idx: str = "row_idx", fraction: float = HOLDOUT_FRACTION,
                  n: int | None = None) -> DataFrame:
    """First floor(fraction * n) rows train, the rest test (K4)."""
    n = row_count(indexed) if n is None else n
    split = int(n * fraction)
    return indexed.withColumn("split", F.when(F.col(idx) < split, F.lit("train")).otherwise(F.lit("test")))


def split_stats(split: DataFrame) -> DataFrame:
    """n_train, n_test and the base rate (mean label over all rows)."""
    return split.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.avg(F.col(LABEL_COLUMN).cast("double")).alias("base_rate"),
    )


class NotEnoughRows(RuntimeError):
    pass


def require_rows(df: DataFrame, minimum: int = MIN_TRAIN_ROWS) -> None:
    """Refuse to train below ``minimum`` rows (J7); reads at most that many."""
    have = df.limit(minimum).count()
    if have < minimum:
        raise NotEnoughRows(f"only {have} rows available, need {minimum}")
