import pytest
from pyspark.sql import functions as F

from barlake.functions.index import with_global_index
from barlake.operators import blocked, marts, quality
from barlake.operators.indicators import technical_features
from barlake.operators.staging import stg_ohlcv
from barlake.plans import catalog
from barlake.sources import lake
from tests.conftest import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(df.collect(), key=repr)


def test_refresh_never_hides_a_table(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    make = lambda n, **c: lake.save_table(spark.range(n).withColumns(c), "marts", "t_swap", root)
    old = make(5)
    reader = spark.table("marts.t_swap")                    # planned before the refresh, run after it
    assert make(7).count() == 7 and spark.table("marts.t_swap").count() == 7
    assert reader.count() == 5 and old.count() == 5
    # a table may be rewritten from itself
    assert lake.save_table(spark.table("marts.t_swap").where("id > 2"), "marts", "t_swap", root).count() == 4
    # a failed write leaves the last one
    with pytest.raises(Exception, match="broken"):
        lake.save_table(spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken")))
                                              .otherwise(F.col("id")).cast("bigint").alias("id")),
                        "marts", "t_swap", root)
    assert spark.table("marts.t_swap").count() == 4
    # other columns replace the table
    assert make(2, x=F.lit("a")).columns == ["id", "x"] and spark.table("marts.t_swap").count() == 2
    assert lake.drop_versions(spark, "marts", "t_swap", root) >= 2
    assert spark.table("marts.t_swap").count() == 2 and lake.drop_versions(spark, "marts", "t_swap", root) == 0


def test_checks_come_with_the_write_and_keep_bad_rows_out(spark, tmp_dir):
    good = catalog.bars(spark, SF_SMALL)
    checks = quality.Checks(quality.RAW)
    lake.refresh_raw_table(spark, good, f"{tmp_dir}/wh", checks)
    assert checks.rows == good.count() and set(checks.failures.values()) == {0}
    assert _rows(checks.report(spark)) == _rows(quality.raw_checks(good))
    bad = good.withColumn("close", F.when(F.col("trade_count") > 1, F.col("close")))
    checks = quality.Checks(quality.RAW)
    with pytest.raises(quality.QualityError, match="not_null.close"):
        lake.refresh_raw_table(spark, bad, f"{tmp_dir}/wh", checks)
    assert spark.table("raw.ohlcv_10s").where("close IS NULL").count() == 0
    assert _rows(checks.report(spark)) == _rows(quality.raw_checks(bad))
    later = quality.Checks(quality.RAW)
    lake.refresh_raw_table(spark, bad, f"{tmp_dir}/wh", later, enforce=False)
    assert later.failures == checks.failures and spark.table("raw.ohlcv_10s").where("close IS NULL").count() > 0


def test_observed_report_equals_the_scanned_one(spark):
    report = catalog.QUERIES["quality_report"](spark, SF_SMALL)
    p = catalog.prepared(spark, SF_SMALL)
    ind = blocked.block_indicators(p.blocks)
    scanned = quality.quality_report(p.raw, blocked.mart_from_indicators(ind), marts.symbol_snapshot(stg_ohlcv(p.raw)))
    assert _rows(report) == _rows(scanned)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and all("/snapshot" in line for line in scans)     # neither raw nor mart is scanned again


@pytest.mark.parametrize("block_rows,buckets", [(31, 3), (64, 5), (100_000, 2)])
def test_windows_over_saved_blocks_have_no_exchange(spark, tmp_dir, block_rows, buckets):
    stg = stg_ohlcv(catalog.prepared(spark, SF_SMALL).raw)
    blocks = blocked.save_blocks(stg, f"blocks_{block_rows}", f"{tmp_dir}/blocks", block_rows, buckets)
    got = blocked.block_indicators(blocks).drop("future_close_3")
    plan = _plan(got)
    assert "Exchange" not in plan and "Window" in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    want = technical_features(stg)
    assert got.columns == want.columns
    for a, b in zip(_rows(got), _rows(want)):
        assert all(x == y or (isinstance(x, float) and abs(x - y) < 1e-9) for x, y in zip(a, b))


def test_trades_are_aggregated_once_for_all_queries(spark, monkeypatch):
    from barlake.plans import catalog as c
    monkeypatch.setattr(c, "_PREPARED", {})
    made = []
    monkeypatch.setattr(c, "bars", lambda s, sf, real=c.bars: made.append(sf) or real(s, sf))
    for key in ("technical_features", "ml_features", "symbol_snapshot", "market_summary", "quality_report", "time_index"):
        plan = c.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan, key
    assert made == [SF_SMALL]


def test_index_reads_runs_of_files_and_only_the_columns_it_uses(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("k"), F.lit("wide" * 50).alias("payload"),
                                  F.lit(None).cast("string").alias("part-9"))
    indexed = with_global_index(df, ["k"], "g", partitions=9)
    plan = _plan(indexed.select("k", "g"))
    assert "payload" not in plan and "ExistingRDD" not in plan and "InMemoryTableScan" not in plan
    assert "SinglePartition" in plan                        # the offsets: one row per file
    assert indexed.columns == ["k", "payload", "part-9", "g"]
    assert indexed.where("k <> g").count() == 0 and indexed.count() == 3000
    none = with_global_index(df.limit(0), ["k"], "g")
    assert none.count() == 0 and none.columns == indexed.columns


def test_scan_of_folders_with_other_columns(spark, tmp_dir):
    for s, extra in (("007", {}), ("b", {"x": F.lit(1.5)}), ("c", {"y": F.lit("t")})):
        spark.range(2).withColumns(extra).write.parquet(f"{tmp_dir}/lake/symbol={s}")
    got = lake.read_partitioned(spark, f"{tmp_dir}/lake", merge=True)
    assert set(got.columns) == {"id", "x", "y", "symbol"}
    assert sorted(map(tuple, got.select("symbol", "id", "x", "y").collect()), key=repr) == sorted(
        [(s, i, 1.5 if s == "b" else None, "t" if s == "c" else None) for s in ("007", "b", "c") for i in range(2)], key=repr)
    assert _plan(got).count("FileScan") == 1
