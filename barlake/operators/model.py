"""Direction classifier with MLlib.

Gradient-boosted trees replace the reference's boosted-tree learner: same
interface (8 named features in a fixed order -> probability of "up"), same
validation protocol (5 expanding walk-forward folds, then a time-ordered
80/20 hold-out). Every fit and every evaluation is a distributed Spark job;
the driver only loops over the five folds."""
from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import dataset as ds
from barlake.operators.marts import latest_features
from barlake.operators.metrics import classification_metrics, mean_auc, roc_auc, roc_auc_by
from barlake.operators.serving import accepted_requests, decide
from barlake.schemas import FEATURE_COLUMNS, LABEL_COLUMN
from barlake.session import checkpoint_dir

# Reference hyper-parameters where MLlib has an equivalent: 400 rounds,
# learning rate 0.03, row and column sampling 0.8, seed 42; 31 leaves ~ depth 5.
ROUNDS = 400
STEP = 0.03
MAX_DEPTH = 5
SUBSAMPLE = 0.8
FEATURE_SUBSET = "0.8"
SEED = 42
ROWS_PER_TASK = 50_000
TASKS_PER_CORE = 2
MAX_ROWS_PER_TASK = 1_000_000


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame        # metric, value
    importance: DataFrame     # feature, importance
    fold_auc: DataFrame       # fold, pos, neg, auc


def pipeline(rounds: int = ROUNDS, step: float = STEP, max_depth: int = MAX_DEPTH,
             subsample: float = SUBSAMPLE, feature_subset: str = FEATURE_SUBSET,
             seed: int = SEED) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")
    gbt = GBTClassifier(labelCol=LABEL_COLUMN, featuresCol="features", maxIter=rounds, stepSize=step,
                        maxDepth=max_depth, subsamplingRate=subsample,
                        featureSubsetStrategy=feature_subset, seed=seed)
    return Pipeline(stages=[assembler, gbt])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds prob_up = P(class 1) (K7); input features are cast to DOUBLE."""
    feats = df.select(*[c for c in df.columns if c not in FEATURE_COLUMNS],
                      *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS])
    out = model.transform(feats)
    return out.withColumn("prob_up", vector_to_array("probability")[1]) \
        .drop("features", "rawPrediction", "probability", "prediction")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """prob_up, direction, confidence (K7 + K8)."""
    return decide(score(model, df))


def fit_tasks(rows: list[int], cores: int) -> list[int]:
    """Tasks of each fit. Every round is a handful of jobs over the whole
    input, so the fixed cost of a task counts 2,000 times in a fit: small
    inputs use few tasks (``ROWS_PER_TASK`` each), and once the fits together
    have ``TASKS_PER_CORE`` tasks a core, tasks grow rather than their number
    (to ``MAX_ROWS_PER_TASK``)."""
    per_task = max(ROWS_PER_TASK, math.ceil(sum(rows) / (TASKS_PER_CORE * cores)))
    return [max(1, math.ceil(n / min(per_task, MAX_ROWS_PER_TASK))) for n in rows]


def fit_input(train: DataFrame, rows: int, tasks: int) -> DataFrame:
    """The feature matrix of the first ``rows`` rows in ``tasks`` equal runs of the time order. The files
    of the frame are runs of it as well, so merging them would leave some tasks of a fold without rows and
    others with several shares, and the slowest task sets the time of every job."""
    if tasks == 1:
        return ds.feature_matrix(train, keep=()).coalesce(1)
    run = F.floor(F.col("row_idx") / math.ceil(rows / tasks)).cast("int")
    return ds.feature_matrix(train, keep=("row_idx",)).repartitionById(tasks, run) \
        .sortWithinPartitions("row_idx").drop("row_idx")


def _fit(train: DataFrame, rounds: int, rows: int, tasks: int) -> PipelineModel:
    """One fit over checkpointed input: the learner keeps its binned rows cached, but every task of its
    2,000 jobs would carry (and report the metrics of) the plan that the input comes from."""
    checkpoint_dir(train.sparkSession)
    return pipeline(rounds).fit(fit_input(train, rows, tasks).checkpoint())


def fit_many(trains: list[tuple[DataFrame, int]], rounds: int = ROUNDS, parallelism: int = 1) -> list[PipelineModel]:
    """Independent fits over (rows, number of rows), up to ``parallelism`` at
    a time: each fit is a chain of Spark jobs submitted from its own driver
    thread (the scheme of MLlib's CrossValidator ``parallelism``); seeded, so
    the models do not depend on it."""
    if not trains:
        return []
    tasks = fit_tasks([n for _, n in trains], trains[0][0].sparkSession.sparkContext.defaultParallelism)
    if parallelism <= 1 or len(trains) <= 1:
        return [_fit(t, rounds, n, k) for (t, n), k in zip(trains, tasks)]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda a: _fit(a[0][0], rounds, a[0][1], a[1]), zip(trains, tasks)))


def walk_forward_cv(frame: DataFrame, rounds: int = ROUNDS, n: int | None = None,
                    parallelism: int = 1, models: list[PipelineModel] | None = None) -> DataFrame:
    """AUC of each expanding fold (K6); one fit per fold, and one pass over the
    scores of all test folds."""
    n = ds.row_count(frame) if n is None else n
    splits = [ds.fold_rows(frame, k, n) for k in range(len(ds.fold_bounds(n)))]
    models = models or fit_many([(tr, lo) for (tr, _), (lo, _) in zip(splits, ds.fold_bounds(n))], rounds,
                                parallelism)
    tests = [score(model, test).select(F.lit(k).alias("fold"), LABEL_COLUMN, "prob_up")
             for k, ((_, test), model) in enumerate(zip(splits, models))]
    return roc_auc_by(reduce(DataFrame.unionByName, tests), "fold")


def feature_importance(model: PipelineModel) -> DataFrame:
    """Normalised MLlib importances per named feature."""
    gbt = model.stages[-1]
    names = model.stages[0].getInputCols()
    values = gbt.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(v) for v in values])),
                                 "feature string, importance double")


def _metric_rows(df: DataFrame, cols: list[str], prefix: str = "") -> DataFrame:
    stack = ", ".join(f"'{prefix}{c}', CAST({c} AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")


def train_direction(frame: DataFrame, rounds: int = ROUNDS, parallelism: int = 1) -> TrainResult:
    """Walk-forward CV, then fit on the first 80 % and evaluate on the rest
    (K5, K12). The five fold fits and the hold-out fit are independent and
    run ``parallelism`` at a time."""
    ds.require_rows(frame)
    n = ds.row_count(frame)
    split = ds.holdout_split(frame, n=n)
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    fold_trains = [(ds.fold_rows(frame, k, n)[0], lo) for k, (lo, _) in enumerate(ds.fold_bounds(n))]
    fitted = fit_many([*fold_trains, (train, int(n * ds.HOLDOUT_FRACTION))], rounds, parallelism)
    folds = walk_forward_cv(frame, rounds, n, models=fitted[:-1])
    cv = mean_auc(folds)
    model = fitted[-1]
    scored = score(model, test)
    cls = classification_metrics(scored)
    auc = roc_auc(scored)
    stats = ds.split_stats(split)
    metrics = (_metric_rows(cv, ["cv_auc"])
               .unionByName(_metric_rows(auc.select(F.col("auc").alias("test_auc")), ["test_auc"]))
               .unionByName(_metric_rows(cls, ["accuracy", "f1", "precision", "recall"], "test_"))
               .unionByName(_metric_rows(stats, ["n_train", "n_test", "base_rate"])))
    return TrainResult(model, metrics, feature_importance(model), folds)


def save_model(model: PipelineModel, path: str) -> None:
    """The fitted pipeline with its assembler stage, so the feature order travels with it."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_latest(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Newest row of every symbol of ``frame`` scored in one job (K9). With
    the training frame (parity) the row is the last one with a known future;
    pass the indicator table for the live row."""
    return predict(model, latest_features(frame)).select(
        "symbol", "window_start", "prob_up", "direction", "confidence")


def score_requests(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Validated requests (defaults filled, constraints held) scored."""
    return predict(model, accepted_requests(requests))
