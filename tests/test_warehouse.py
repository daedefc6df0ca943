import pytest
from pyspark.sql import functions as F

from barlake.operators import marts, quality
from barlake.operators.indicators import technical_features
from barlake.plans import catalog
from barlake.plans import warehouse as wh
from barlake.schemas import TECHNICAL_COLUMNS
from barlake.sources import bus, lake
from tests.conftest import SF_SMALL


def test_layer_names():
    assert lake.layer_table("marts", "mart_ml_features") == "marts.mart_ml_features"
    assert lake.layer_table(None, "x") == "x"


def test_scan_lake_requires_parquet(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        lake.scan_lake(spark, f"{tmp_dir}/nothing")
    spark.createDataFrame([("a",)], "x string").write.mode("overwrite").json(f"{tmp_dir}/json")
    with pytest.raises(FileNotFoundError):
        lake.scan_lake(spark, f"{tmp_dir}/json")


def test_lake_partitioning_and_audit(spark, tmp_dir):
    bars = catalog.bars(spark, SF_SMALL)
    lake.write_bars(bars, f"{tmp_dir}/lake")
    back = lake.scan_lake(spark, f"{tmp_dir}/lake")
    assert back.count() == bars.count()
    files = back.inputFiles()
    assert files and all("/symbol=" in f for f in files)
    audit = lake.load_audit(back).first()
    assert audit.rows == bars.count() and audit.files == len(files)
    # symbol filter prunes folders
    plan = back.where(F.col("symbol") == "view")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_build_warehouse_tables_views_and_gate(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    raw = lake.refresh_raw_table(spark, catalog.bars(spark, SF_SMALL), root)
    built = wh.build_warehouse(spark, root=root, block_rows=64)
    assert spark.catalog.tableExists("marts.mart_ml_features")
    assert spark.catalog.tableExists("marts.mart_symbol_snapshot")
    assert spark.table(wh.STG_VIEW).count() == built.stg.count()
    assert spark.table(wh.INT_TABLE).count() == built.stg.count()
    views = {t.name for t in spark.catalog.listTables("staging")}
    assert "stg_ohlcv" in views
    assert built.checks.where("failures > 0").count() == 0
    assert built.features.columns == TECHNICAL_COLUMNS
    # the mart of plain per-symbol windows is the same
    cols = built.ml_mart.columns
    blocked_rows = sorted(map(tuple, built.ml_mart.select(*cols).collect()), key=repr)
    plain = marts.ml_features(technical_features(built.stg))
    plain_rows = sorted(map(tuple, plain.select(*cols).collect()), key=repr)
    assert len(plain_rows) == len(blocked_rows)
    for a, b in zip(plain_rows, blocked_rows):
        assert all(x == y or (isinstance(x, float) and abs(x - y) < 1e-9) for x, y in zip(a, b))
    # a NULL close in raw fails the build
    bad = raw.unionByName(raw.limit(1).withColumn("close", F.lit(None).cast("double")))
    with pytest.raises(quality.QualityError):
        wh.build_warehouse(spark, bad, f"{tmp_dir}/wh3")


def test_numeric_symbols_stay_text(spark, tmp_dir):
    bars = catalog.bars(spark, SF_SMALL)
    padded = bars.withColumn("symbol", F.when(F.col("symbol") == "view", "005930").otherwise("000660"))
    padded = padded.dropDuplicates(["symbol", "window_start"])
    lake.write_bars(padded, f"{tmp_dir}/lake")
    back = lake.scan_lake(spark, f"{tmp_dir}/lake")
    assert back.schema["symbol"].dataType.simpleString() == "string"
    assert {r.symbol for r in back.select("symbol").distinct().collect()} == {"005930", "000660"}
    assert back.count() == padded.count()


def test_compact_keeps_rows(spark, tmp_dir):
    bars = catalog.bars(spark, SF_SMALL)
    bars.repartition(6).write.partitionBy("symbol").parquet(f"{tmp_dir}/many")
    lake.compact(spark, f"{tmp_dir}/many", f"{tmp_dir}/few")
    many, few = lake.scan_lake(spark, f"{tmp_dir}/many"), lake.scan_lake(spark, f"{tmp_dir}/few")
    assert few.count() == many.count() and len(few.inputFiles()) < len(many.inputFiles())


def test_fallback_reads(spark):
    from barlake.operators import report, serving
    assert serving.served_table(spark, "marts.nothing_here", "raw.nothing_here") is None
    text = report.summary_of_table(spark, "marts.nothing_here").first()
    assert text.assets == 0 and text.summary == report.EMPTY_SUMMARY


def test_warehouse_root_is_the_warehouse_folder(spark):
    assert lake.warehouse_root(spark, "/x/") == "/x"
    assert lake.warehouse_root(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def test_stack_frames(spark):
    from barlake.operators.stack import stack_frames
    a, b = spark.sql("SELECT 1 AS x, 'p' AS y"), spark.sql("SELECT 'q' AS y, 2 AS x")
    c = spark.sql("SELECT 3 AS x")
    assert sorted(map(tuple, stack_frames([a, b, c]).select("x", "y").collect())) == [(1, "p"), (2, "q"), (3, None)]
    with pytest.raises(ValueError):
        stack_frames([])


def test_bus_options():
    src = bus.source_options("trades", servers="broker:9092")
    assert src == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "trades",
                   "startingOffsets": "latest", "maxOffsetsPerTrigger": "20000"}
    assert "maxOffsetsPerTrigger" not in bus.source_options("trades", max_per_trigger=None)
    sink = bus.sink_options("trades", servers="broker:9092")
    assert sink["kafka.compression.type"] == "lz4" and sink["topic"] == "trades"


def test_padded_read_prunes_and_pushes(spark, tmp_dir):
    from barlake.operators import serving
    from barlake.operators.indicators import technical_features
    from barlake.operators.staging import stg_ohlcv
    lake.write_bars(catalog.bars(spark, SF_SMALL), f"{tmp_dir}/lake")
    stg = stg_ohlcv(lake.scan_lake(spark, f"{tmp_dir}/lake"))
    padded = serving.recent_symbol_bars(stg, "VIEW", 20)
    full = serving.symbol_bars(technical_features(stg), "VIEW", 20)
    assert padded.collect() == full.collect()
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = padded._jdf.queryExecution().explainString(mode)
    assert "PartitionFilters: [isnotnull(symbol" in plan
    assert "GreaterThanOrEqual(window_start," in plan


def test_symbol_bars_falls_back_to_raw_columns(spark):
    from barlake.operators import serving
    raw = catalog.bars(spark, SF_SMALL)
    out = serving.symbol_bars(raw, "View", 5)
    assert out.columns == serving.RAW_SERIES
    ts = [r.window_start for r in out.collect()]
    assert len(ts) == 5 and ts == sorted(ts)
    newest = raw.where("symbol = 'view'").agg(F.max("window_start")).first()[0]
    assert ts[-1] == newest
