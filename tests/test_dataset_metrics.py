import math

import pytest
from pyspark.sql import Row, functions as F

from barlake.operators import dataset as ds
from barlake.operators import metrics as mx
from barlake.plans import catalog
from tests.conftest import SF_SMALL


def test_fold_bounds_follow_reference_law():
    # 1,430 rows: t = 238, last fold ends at n; hold-out 1,144 / 286
    b = ds.fold_bounds(1430)
    assert len(b) == 5 and b[0] == (1430 - 5 * 238, 1430 - 4 * 238) and b[-1][1] == 1430
    assert int(1430 * 0.8) == 1144
    assert ds.fold_bounds(5) == []


def test_time_index_is_dense_and_ordered(spark):
    frame = ds.training_frame_from(catalog.mart(spark, SF_SMALL))
    n = frame.count()
    got = [r.row_idx for r in frame.orderBy("window_start", "symbol").select("row_idx").collect()]
    assert got == list(range(n))


def test_clean_drops_inf_nan_and_null(spark):
    base = dict(symbol="a", window_start=None, close=1.0, ret_1=0.1, log_ret_1=0.1, px_vs_sma30=0.0,
                volatility_30=0.1, order_flow_imbalance=0.0, ofi_6=0.0, rel_volume=1.0, trade_count=3,
                future_close_3=1.0, label_up_3=1)
    rows = [Row(**base), Row(**dict(base, ret_1=float("inf"))), Row(**dict(base, ofi_6=float("nan"))),
            Row(**dict(base, rel_volume=None)), Row(**dict(base, label_up_3=None))]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, close double, ret_1 double, "
                               "log_ret_1 double, px_vs_sma30 double, volatility_30 double, "
                               "order_flow_imbalance double, ofi_6 double, rel_volume double, trade_count bigint, "
                               "future_close_3 double, label_up_3 int")
    assert ds.clean(df).count() == 1


def test_require_rows(spark):
    df = spark.range(150)
    with pytest.raises(ds.NotEnoughRows):
        ds.require_rows(df)
    ds.require_rows(spark.range(250))


def _scored(spark, pairs):
    return spark.createDataFrame([Row(label_up_3=y, prob_up=p) for y, p in pairs])


def test_auc_edge_cases(spark):
    one_class = mx.roc_auc(_scored(spark, [(1, 0.2), (1, 0.7)])).first()
    assert math.isnan(one_class.auc)
    tied = mx.roc_auc(_scored(spark, [(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)])).first()
    assert tied.auc == 0.5
    perfect = mx.roc_auc(_scored(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])).first()
    assert perfect.auc == 1.0
    # brute force on a small mixed case
    pairs = [(1, 0.3), (0, 0.3), (0, 0.1), (1, 0.9), (0, 0.7), (1, 0.7), (0, 0.95)]
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(mx.roc_auc(_scored(spark, pairs)).first().auc - want) < 1e-12


def test_metrics_zero_when_undefined(spark):
    m = mx.classification_metrics(_scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_index_and_prefix_sums_over_many_partitions(spark):
    from barlake.functions.index import with_global_index, with_prefix_sums
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    g = with_global_index(df, ["k"], "g", partitions=7)
    got = sorted((r.k, r.g) for r in g.collect())
    assert all(k == i for k, i in got)                # k is a permutation of 0..4999
    p = with_prefix_sums(df, ["k"], {"run": "v"}, exclusive=True, partitions=7).orderBy("k").collect()
    total = 0
    for r in p:
        assert r.run == total
        total += r.v


def test_training_frame_table_or_rebuild(spark):
    with pytest.raises(LookupError):
        ds.training_frame(spark, "marts.no_such_mart")
    rebuilt = ds.training_frame(spark, "marts.no_such_mart", rebuild=lambda: catalog.mart(spark, SF_SMALL))
    direct = ds.training_frame_from(catalog.mart(spark, SF_SMALL))
    assert rebuilt.count() == direct.count() > 0
    assert rebuilt.columns == direct.columns


def test_latest_feature_row_of_one_symbol(spark):
    from barlake.operators import marts
    frame = ds.training_frame_from(catalog.mart(spark, SF_SMALL))
    one = marts.latest_features(frame, "VIEW").collect()
    assert len(one) == 1 and one[0].symbol == "view"
    newest = frame.where("symbol = 'view'").agg(F.max("window_start")).first()[0]
    assert one[0].window_start == newest
    assert marts.latest_features(frame, "NOPE").count() == 0
