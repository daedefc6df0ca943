"""Run metadata as JSON documents (A12): metrics and feature importances."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_metadata(metrics: DataFrame, importance: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    importance.coalesce(1).write.mode("overwrite").json(f"{path}/feature_importance")


def read_metadata(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema("metric string, value double").json(f"{path}/metrics"),
            spark.read.schema("feature string, importance double").json(f"{path}/feature_importance"))
