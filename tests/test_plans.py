"""Plan-shape guards: no Python evaluation, no cartesian or sort-merge joins,
hash (not sort) aggregation for bars with the packed ordering key, and the
one-pass snapshot without a join."""
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

KEYS = ["ohlcv_bars", "technical_features_blocked", "ml_features", "symbol_snapshot_onepass", "symbol_bars",
        "normalize_trades", "quality_report", "market_summary", "roc_auc", "time_index"]


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "SortMergeJoin"):
        assert bad not in plan, f"{key}: {bad}"
    if key == "ohlcv_bars":
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    if key == "symbol_snapshot_onepass":
        joins = [l for l in plan.split("\n") if "Join" in l and "_before" not in l and "_s" not in l]
        assert joins == [], joins          # only the day-offset lookup joins
