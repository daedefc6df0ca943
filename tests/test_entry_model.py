from pyspark.sql import functions as F

import __spark_entry__ as entry
from barlake.operators import dataset as ds
from barlake.operators import model as ml
from barlake.plans import catalog
from barlake.session import object_store_conf
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 5
    assert df.columns[:3] == ["symbol", "as_of", "last_price"]


def test_registry_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    assert all(callable(f) for f in q.values())


def test_train_score_roundtrip(spark, tmp_dir):
    frame = ds.training_frame_from(catalog.mart(spark, SF_SMALL))
    res = ml.train_direction(frame, rounds=3)
    metrics = {r.metric: r.value for r in res.metrics.collect()}
    assert {"cv_auc", "test_auc", "test_accuracy", "test_f1", "test_precision", "test_recall", "n_train",
            "n_test", "base_rate"} <= set(metrics)
    n = frame.count()
    assert metrics["n_train"] == int(n * 0.8) and metrics["n_train"] + metrics["n_test"] == n
    imp = res.importance.collect()
    assert [r.feature for r in imp] == ml.FEATURE_COLUMNS and abs(sum(r.importance for r in imp) - 1) < 1e-9
    ml.save_model(res.model, f"{tmp_dir}/m")
    back = ml.load_model(f"{tmp_dir}/m")
    a = ml.predict(res.model, frame).orderBy("row_idx").select("prob_up").collect()
    b = ml.predict(back, frame).orderBy("row_idx").select("prob_up").collect()
    assert a == b and all(0 <= r.prob_up <= 1 for r in a)
    latest = ml.score_latest(back, frame).collect()
    assert len(latest) == 5 and {r.direction for r in latest} <= {"up", "down"}
    zero = spark.createDataFrame([(None,) * 8], ", ".join(f"{c} double" for c in ml.FEATURE_COLUMNS))
    z = ml.score_requests(back, zero).first()
    assert 0 <= z.prob_up <= 1 and z.rel_volume == 1.0


def test_object_store_conf_from_env():
    conf = object_store_conf({"LAKE_S3_ENDPOINT": "http://object-store:9000", "LAKE_S3_ACCESS_KEY": "a",
                              "LAKE_S3_SECRET_KEY": "b"})
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.aws.credentials.provider"].endswith("SimpleAWSCredentialsProvider")
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert object_store_conf({}) == {}


def test_fit_parallelism_does_not_change_results(spark):
    frame = ds.training_frame_from(catalog.mart(spark, SF_SMALL))
    a = {r.metric: r.value for r in ml.train_direction(frame, rounds=2, parallelism=1).metrics.collect()}
    b = {r.metric: r.value for r in ml.train_direction(frame, rounds=2, parallelism=3).metrics.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == b[k] or (a[k] != a[k] and b[k] != b[k])      # NaN == NaN


class _Sizes:
    """Stands in for the learner: rows of each task of the fit's input, and the features in their order."""

    def fit(self, data):
        return data.rdd.mapPartitions(lambda rows: [[r.trade_count for r in rows]]).collect()


def _runs(spark, rows, files):
    """A frame in ``files`` runs of the time order."""
    idx = F.col("id").cast("double")
    return spark.range(0, rows, 1, files).select(F.col("id").alias("row_idx"), *[idx.alias(c) for c in ml.FEATURE_COLUMNS],
                                                 F.lit(1).alias(ml.LABEL_COLUMN))


def test_tasks_of_a_fold_hold_equal_runs(spark, monkeypatch):
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(ml, "pipeline", lambda rounds: _Sizes())
    frame = _runs(spark, 800, 8)
    # the first 200 rows lie in two of the eight files
    small, one = ml.fit_many([(frame.where("row_idx < 200"), 200), (frame.where("row_idx < 40"), 40)])
    assert small == [[float(i) for i in range(k, k + 50)] for k in range(0, 200, 50)]
    assert [len(x) for x in one] == [40]


def test_tasks_grow_rather_than_their_number():
    assert ml.fit_tasks([40, 50_000, 60_000], 12) == [1, 1, 2]
    rows = [1_300_000 * k // 6 for k in range(1, 6)] + [1_040_000]
    now, more = ml.fit_tasks(rows, 12), ml.fit_tasks([2 * n for n in rows], 12)
    assert sum(now) <= 24 + len(rows) and now == more
    assert ml.fit_tasks([40_000_000], 12) == [40]      # a task's rows stay bounded
