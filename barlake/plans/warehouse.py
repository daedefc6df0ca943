"""Layered warehouse build and the refresh job.

raw table -> staging view -> intermediate view -> two mart tables, with the
declared checks run inside the build; then training and the summary. Each
step is a function DataFrame -> DataFrame; the only materialisation points
are the raw table, the indicator table, the two marts, the model folder with
its metadata, and the summary."""
from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from barlake.operators import blocked as blk
from barlake.operators import dataset as ds
from barlake.operators import marts, quality, report
from barlake.operators import model as ml
from barlake.operators.staging import stg_ohlcv, stg_view_sql
from barlake.schemas import TECHNICAL_COLUMNS
from barlake.sources import lake
from barlake.sources.metadata import write_metadata

STG_VIEW = lake.layer_table("staging", "stg_ohlcv")
INT_TABLE = lake.layer_table("intermediate", "int_technical_features")
ML_MART = lake.layer_table("marts", "mart_ml_features")
SNAPSHOT_MART = lake.layer_table("marts", "mart_symbol_snapshot")
TABLES = (lake.RAW_TABLE, ("intermediate", "int_indicators_ahead"), ("marts", "mart_ml_features"),
          ("marts", "mart_symbol_snapshot"), ("marts", "market_summary"))


@dataclass
class Warehouse:
    stg: DataFrame
    features: DataFrame
    ml_mart: DataFrame
    snapshot: DataFrame
    checks: DataFrame
    mart_rows: int


def build_warehouse(spark: SparkSession, raw: DataFrame | None = None, root: str | None = None,
                    block_rows: int = blk.DEFAULT_BLOCK_ROWS, enforce_checks: bool = True,
                    raw_table: str = lake.layer_table(*lake.RAW_TABLE),
                    raw_checks: quality.Checks | None = None) -> Warehouse:
    """Staging is a catalog view over ``raw_table`` (A8, A9), or a projection
    of ``raw`` when a DataFrame is given instead of the table. The indicator
    table is saved once, with the look-ahead close; the 20-column intermediate
    view, the mart and the snapshot are derived from it. The checks of the mart
    and the snapshot are counted while these are written, those of raw were when
    the loader wrote it (``raw_checks``; without them raw is scanned). A failing
    check fails the build before the table it is about is switched in (J6), so
    readers keep the last good one. No task holds more than
    about ``block_rows`` bars however few symbols there are."""
    lake.ensure_layers(spark, root)
    if raw is None:
        raw = spark.table(raw_table)
        spark.sql(f"CREATE OR REPLACE VIEW {STG_VIEW} AS {stg_view_sql(raw, raw_table)}")
        stg = spark.table(STG_VIEW)
    else:
        stg = stg_ohlcv(raw)
    of_raw = raw_checks.report(spark) if raw_checks else quality.raw_checks(raw)
    if enforce_checks:
        quality.enforce(of_raw)
    ind = lake.save_table(blk.blocked_indicators(stg, block_rows), "intermediate", "int_indicators_ahead", root)
    spark.sql(f"CREATE OR REPLACE VIEW {INT_TABLE} AS SELECT {', '.join(TECHNICAL_COLUMNS)} FROM "
              + lake.layer_table("intermediate", "int_indicators_ahead"))
    feats = spark.table(INT_TABLE)
    of_mart, of_snapshot = quality.Checks(quality.MART), quality.Checks(quality.SNAPSHOT)
    ml_mart = lake.save_table(blk.mart_from_indicators(ind), "marts", "mart_ml_features", root, of_mart, enforce_checks)
    snapshot = lake.save_table(marts.symbol_snapshot_onepass(feats), "marts", "mart_symbol_snapshot", root,
                               of_snapshot, enforce_checks)
    checks = of_raw.unionByName(quality.report_of(spark, {**of_mart.failures, **of_snapshot.failures})) \
        .unionByName(quality.unique_symbols(snapshot))
    if enforce_checks:
        quality.enforce(checks)
    return Warehouse(stg, feats, ml_mart, snapshot, checks, of_mart.rows)


@dataclass
class StepLog:
    rows: list = field(default_factory=list)

    def add(self, step: str, rows: int, t0: float) -> None:
        self.rows.append((step, int(rows), round(time.time() - t0, 3)))


def refresh(spark: SparkSession, lake_path: str, model_dir: str, root: str | None = None, rounds: int = ml.ROUNDS,
            block_rows: int = blk.DEFAULT_BLOCK_ROWS, parallelism: int = 1) -> tuple[DataFrame, DataFrame]:
    """Load the lake into raw, build models + checks, train, summarise; each
    step runs only when the one before succeeded (M1). Returns the step log
    (step, rows, seconds) and the summary, which is also stored as
    ``marts.market_summary``."""
    log = StepLog()
    t0 = time.time()
    raw_checks = quality.Checks(quality.RAW)
    lake.refresh_raw_table(spark, lake.scan_lake(spark, lake_path), root, raw_checks, enforce=False)
    log.add("load", raw_checks.rows, t0)

    t0 = time.time()
    wh = build_warehouse(spark, root=root, block_rows=block_rows, raw_checks=raw_checks)
    log.add("build", wh.mart_rows, t0)

    t0 = time.time()
    frame = ds.training_frame(spark, ML_MART)
    result = ml.train_direction(frame, rounds, parallelism)
    ml.save_model(result.model, f"{model_dir}/model")
    write_metadata(result.metrics, result.importance, model_dir)
    log.add("train", ds.row_count(frame), t0)

    t0 = time.time()
    summary = lake.save_table(report.summary_of_table(spark, SNAPSHOT_MART), "marts", "market_summary", root)
    log.add("summary", summary.count(), t0)
    for layer, name in TABLES:
        lake.drop_versions(spark, layer, name, root)
    return spark.createDataFrame(log.rows, "step string, rows bigint, seconds double"), summary
