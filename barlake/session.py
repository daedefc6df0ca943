"""Session construction (A14) and shared-storage helpers."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that every session of the engine wants; the cluster manager may
# override any of them through spark-defaults.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files of DataFrames that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Object-store settings are taken from the environment only, never literals.
_S3A_ENV = {
    "LAKE_S3_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
    "LAKE_S3_ACCESS_KEY": "spark.hadoop.fs.s3a.access.key",
    "LAKE_S3_SECRET_KEY": "spark.hadoop.fs.s3a.secret.key",
}


def object_store_conf(env: dict | None = None) -> dict[str, str]:
    """S3A settings (endpoint, path-style access, credentials, TLS off for a
    plain-HTTP endpoint) built from environment variables."""
    env = os.environ if env is None else env
    conf = {}
    for var, key in _S3A_ENV.items():
        if env.get(var):
            conf[key] = env[var]
    if conf:
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
        if "spark.hadoop.fs.s3a.access.key" in conf:
            conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = \
                "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        endpoint = conf.get("spark.hadoop.fs.s3a.endpoint", "")
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    return conf


def build_spark(app: str = "barlake", master: str | None = None, shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf.update(object_store_conf())
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster it is what ``spark.checkpoint.dir`` names. Only a local-mode
    session without that setting (tests) gets a fresh folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        d = tempfile.mkdtemp(prefix="barlake-chk-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
