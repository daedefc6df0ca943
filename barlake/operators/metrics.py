"""Evaluation metrics as aggregations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.index import with_prefix_sums


def confusion(scored: DataFrame, label: str = "label_up_3", prob: str = "prob_up",
              threshold: float = 0.5) -> DataFrame:
    pred = F.col(prob) >= threshold
    y = F.col(label) == 1
    return scored.agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn"))


def _ratio(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def classification_metrics(scored: DataFrame, label: str = "label_up_3", prob: str = "prob_up",
                           threshold: float = 0.5) -> DataFrame:
    """Accuracy, F1, precision, recall at p >= threshold; 0 when a
    denominator is 0 (D7). One aggregation pass."""
    c = confusion(scored, label, prob, threshold)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    return c.select(
        "tp", "fp", "tn", "fn",
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        precision.alias("precision"), recall.alias("recall"))


def roc_auc_by(scored: DataFrame, group: str, label: str = "label_up_3", prob: str = "prob_up") -> DataFrame:
    """(group, pos, neg, auc) of every group: exact ROC-AUC (Mann-Whitney, ties
    count half), NaN unless both classes occur (D8, D9).

    Rows are grouped by (group, score) first, so the running count of negatives
    runs over distinct scores only, once for all groups and distributed by
    range (no single-task window). The count at a group's lowest score is that
    of the groups before and is taken off again; twice the statistic is a whole
    number, so nothing is lost in the difference."""
    by_score = scored.groupBy(F.col(group).alias("_g"), F.col(prob).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    run = with_prefix_sums(by_score, ["_g", "_s"], {"_below": "_neg"}, exclusive=True)
    exact = "decimal(38,0)"
    agg = run.groupBy("_g").agg(
        F.sum(F.col("_pos").cast(exact) * (2 * F.col("_below") + F.col("_neg")).cast("decimal(20,0)")).alias("_u2"),
        F.min("_below").alias("_before"), F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"))
    u = (F.col("_u2") - 2 * F.col("_before").cast("decimal(19,0)") * F.col("pos").cast("decimal(18,0)")).cast("double") / 2
    auc = F.when((F.col("pos") > 0) & (F.col("neg") > 0),
                 u / (F.col("pos").cast("double") * F.col("neg"))).otherwise(F.lit(float("nan")))
    return agg.select(F.col("_g").alias(group), "pos", "neg", auc.alias("auc"))


def roc_auc(scored: DataFrame, label: str = "label_up_3", prob: str = "prob_up") -> DataFrame:
    """(pos, neg, auc) over all rows; one row also for none."""
    every = roc_auc_by(scored.withColumn("_all", F.lit(0)), "_all", label, prob)
    # a global aggregation of the single group, which has a row when there is no group either
    return every.agg(F.coalesce(F.max("pos"), F.lit(0)).cast("bigint").alias("pos"),
                     F.coalesce(F.max("neg"), F.lit(0)).cast("bigint").alias("neg"),
                     F.coalesce(F.max("auc"), F.lit(float("nan"))).alias("auc"))


def mean_auc(folds: DataFrame) -> DataFrame:
    """(cv_auc): the mean of the folds that have an AUC, NaN without one."""
    return folds.where(~F.isnan("auc")).agg(F.avg("auc").alias("cv_auc")) \
        .select(F.coalesce("cv_auc", F.lit(float("nan"))).alias("cv_auc"))
