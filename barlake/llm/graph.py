"""Connected components of an edge table."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import checkpoint_dir


_PASSING: list[list[str]] = []


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from a table below the shared checkpoint folder.

    Cuts the lineage, survives lost executors, and later steps read only the columns they use."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    if _PASSING:
        _PASSING[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def outcome(spark: SparkSession, make) -> DataFrame:
    """``make()`` saved, and the tables saved while making it deleted: nothing reads them once the result is written.
    If making fails they stay, as any other table."""
    _PASSING.append([])
    try:
        result = make()
        passing, _PASSING[-1] = _PASSING[-1], []
        result = saved(result)
    finally:
        _PASSING.pop()
    for path in passing:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return result


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge table (a, b); the component is its smallest node.

    Each round gives a node the smallest label among its neighbours and itself, then follows the label to that
    node's own label, so labels travel twice as far each round; rounds are cut off from each other in the shared
    checkpoint folder. Only the number of changed labels reaches the driver. Null ends and self links are ignored."""
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = saved(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = saved(both.groupBy("a").agg(F.min("b").alias("m"))
                  .select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (both.join(label, both.b == label.node).groupBy("a").agg(F.min("label").alias("m"))
                .withColumnRenamed("a", "node"))
        step = label.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("m", "label")).alias("label"))
        far = label.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        new = saved(step.join(far, "label", "left")
                    .select("node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")))
        changed = new.where("label <> old").limit(1).count()
        label = new.select("node", "label")
        if not changed:
            return label.withColumnRenamed("label", "component")
