"""Parquet lake partitioned by symbol, and warehouse tables."""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.quality import Checks
from barlake.schemas import BAR_COLUMNS

RAW_TABLE = ("raw", "ohlcv_10s")
LAYERS = ("raw", "staging", "intermediate", "marts")


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Bars as Parquet under ``symbol=<s>/`` folders; the partition column
    lives in the path, not in the files (A6). Range partitioning on (symbol,
    window_start) gives each task a contiguous slice, so it writes one or two
    folders, while a symbol holding most of the data is split over many
    tasks by the sampled range bounds. ``spark.sql.shuffle.partitions`` is the
    most tasks there can be; AQE merges small ones. ``dynamic`` overwrites the
    symbol folders that the bars have and leaves the others."""
    (bars.repartitionByRange("symbol", "window_start")
     .sortWithinPartitions("symbol", "window_start")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy("symbol").parquet(path))


def scan_lake(spark: SparkSession, path: str) -> DataFrame:
    """Recursive scan with partition discovery; ``symbol`` comes back from the
    folder names. Fails when the path holds no Parquet (A5)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(f"no lake at {path}")
    it = fs.listFiles(hpath, True)
    found = None
    while found is None and it.hasNext():
        file = it.next().getPath()
        if file.getName().endswith(".parquet"):
            found = str(file.toString())
    if found is None:
        raise FileNotFoundError(f"no parquet files under {path}")
    df = read_partitioned(spark, path, found)
    return df.select(*[c for c in BAR_COLUMNS if c in df.columns])


def read_partitioned(spark: SparkSession, path: str, file: str | None = None, merge: bool = False) -> DataFrame:
    """A table partitioned by symbol folders. The schema is that of a file
    plus ``symbol string``: folder names like ``005930`` stay text instead of
    being inferred as numbers. With ``merge`` it is that of all files together,
    read from their footers by a Spark job; a column that a folder's files lack
    is NULL there (G1). Either way one scan serves all folders, and the plan does not
    grow with their number."""
    inner = spark.read.parquet(file) if file else \
        spark.read.option("mergeSchema", str(merge).lower()).parquet(path).drop("symbol")
    schema = T.StructType([f for f in inner.schema.fields if f.name != "symbol"]
                          + [T.StructField("symbol", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite a lake of many small files (one per symbol, task and trigger of
    a streaming sink) under another path, in time order per symbol."""
    write_bars(scan_lake(spark, path), target)


def layer_table(layer: str | None, name: str) -> str:
    """Layer schemas are used verbatim; no layer means the default database."""
    return f"{layer}.{name}" if layer else name


def ensure_layers(spark: SparkSession, root: str | None = None) -> str:
    """One database per layer, located in the shared warehouse folder."""
    root = warehouse_root(spark, root)
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}.db'")
    return root


def warehouse_root(spark: SparkSession, root: str | None = None) -> str:
    """Folder of the layer databases: the one given, else the session's
    ``spark.sql.warehouse.dir``. Durable tables never go below the checkpoint
    folder."""
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def save_table(df: DataFrame, layer: str, name: str, root: str | None = None, checks: Checks | None = None,
               enforce: bool = True) -> DataFrame:
    """Full refresh of a layer table (A7). The rows go into a new version
    folder; then the table's location is switched to it, one change of the
    catalog. A reader sees the whole old table or the whole new one, also one
    that is in the middle of a scan, and a write that fails leaves the old one.
    ``checks`` are evaluated on the rows as they are written (nothing is scanned
    again); with ``enforce`` a failing one keeps the new version from being
    switched in. Only a change of the columns replaces the table itself.

    Versions live below an explicit folder of the shared warehouse root, so a
    new session (or a restarted driver) need not know what is there;
    :func:`drop_versions` removes old ones."""
    spark = df.sparkSession
    root = ensure_layers(spark, root)
    table = layer_table(layer, name)
    path = f"{root}/{layer}.db/{name}/v{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    (checks.on(df) if checks else df).write.parquet(path)
    if checks and enforce:
        checks.enforce()
    if spark.catalog.tableExists(table):
        kept = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
        if kept:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    return spark.table(table)


def drop_versions(spark: SparkSession, layer: str, name: str, root: str | None = None, keep: int = 2) -> int:
    """Removes the version folders of a table but the newest ``keep``, of which the table has the last (readers of the
    one before may still run); returns how many went."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{warehouse_root(spark, root)}/{layer}.db/{name}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().startswith("v")),
                   key=lambda x: x.getName())
    return sum(bool(fs.delete(old, True)) for old in found[:-keep])


def save_bucketed(df: DataFrame, name: str, path: str, by: tuple[str, ...], sort: tuple[str, ...],
                  buckets: int | None = None) -> DataFrame:
    """A table bucketed on ``by`` and sorted in each bucket: windows, joins and aggregations on these columns read it
    without an exchange. The rows are dealt out by the hash that the buckets use, so a bucket is one file."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, *by).write.format("parquet").mode("overwrite").bucketBy(n, *by).sortBy(*sort)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def refresh_raw_table(spark: SparkSession, bars: DataFrame, root: str | None = None, checks: Checks | None = None,
                      enforce: bool = True) -> DataFrame:
    """Full refresh of ``raw.ohlcv_10s``."""
    return save_table(bars.select(*BAR_COLUMNS), *RAW_TABLE, root=root, checks=checks, enforce=enforce)


def load_audit(table: DataFrame) -> DataFrame:
    """Row and file count of a loaded table in one aggregation (A11, D5); the
    files are counted where they are read, no listing reaches the driver."""
    return (table.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"), F.count("f").alias("files")))
