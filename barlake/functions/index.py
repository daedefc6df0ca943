"""Distributed positions and prefix sums over a global order.

A plain ``row_number()`` or running sum over an un-partitioned window moves
every row into one task. Here the rows are range-partitioned on the order
key, sorted within partitions and written as Parquet into the shared
checkpoint folder, one file per range. A file is then a run of the order: a
row's place is its ``_metadata.row_index`` in its file plus the rows of the
files before. The written files do not change when an executor is lost and
tasks are run again, the lineage is cut, and a reader takes only the columns
it uses from the files (a count or an index takes none of the others).
Per-file totals form a table with one row per file, whose running offsets
are computed in one small task and broadcast back; its size is the number of
ranges, known up front."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.session import scratch_path

_FILE, _ROW, _ORDER = "_file", "_row", "_order"
# Range bounds are sampled, so all rows of one key lie in one range and a range may be uneven; a file is read in splits.
_PART = r"part-(\d+)"


def _ranges(df: DataFrame, keys: Sequence[str], partitions: int | None) -> DataFrame:
    """``df`` in runs: its columns, the number of the run's file and the place in it.

    Without an explicit count there are spark.sql.shuffle.partitions ranges at
    most; AQE merges adjacent ones only, so the numbers of the tasks, which the
    file names carry, follow the order."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(
        *df.columns, F.regexp_extract(F.col("_metadata.file_name"), _PART, 1).cast("int").alias(_FILE),
        F.col("_metadata.row_index").alias(_ROW))


def _offsets(runs: DataFrame, sums: dict[str, F.Column]) -> DataFrame:
    per = runs.groupBy(F.col(_FILE).alias(_ORDER)).agg(*[e.alias(k) for k, e in sums.items()])
    before = Window.orderBy(_ORDER).rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return per.select(_ORDER, *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_off_{k}") for k in sums])


def with_global_index(df: DataFrame, keys: Sequence[str], col: str = "row_idx",
                      partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the order of ``keys`` (make the keys
    unique for a deterministic index)."""
    runs = _ranges(df, keys, partitions)
    offs = _offsets(runs, {"n": F.count(F.lit(1))})
    return (runs.join(F.broadcast(offs), F.col(_FILE) == F.col(_ORDER))
            .withColumn(col, (F.col("_off_n") + F.col(_ROW)).cast("bigint"))
            .drop(_FILE, _ROW, _ORDER, "_off_n"))


def with_prefix_sums(df: DataFrame, keys: Sequence[str], values: dict[str, str],
                     exclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` (out name -> input column) in the order of
    ``keys``; exclusive sums count the rows strictly before each row."""
    runs = _ranges(df, keys, partitions)
    offs = _offsets(runs, {k: F.sum(v) for k, v in values.items()})
    hi = -1 if exclusive else Window.currentRow
    w = Window.partitionBy(_FILE).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, hi)
    local = runs
    for k, v in values.items():
        local = local.withColumn(f"_sum_{k}", F.coalesce(F.sum(v).over(w), F.lit(0)))
    out = local.join(F.broadcast(offs), F.col(_FILE) == F.col(_ORDER))
    for k in values:
        out = out.withColumn(k, F.col(f"_off_{k}") + F.col(f"_sum_{k}"))
    return out.drop(_FILE, _ROW, _ORDER, *[f"_off_{k}" for k in values], *[f"_sum_{k}" for k in values])
