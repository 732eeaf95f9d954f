"""Prediction evaluation.

Every metric derives from one grouped pass over the predictions
(partially aggregated map-side, so the shuffle carries at most a few
rows per class and map task); the rest works on per-class rows."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ordered import dense_rank_by, running_sums
from revlens.session import materialize


def pair_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
                .agg(F.count(F.lit(1)).alias("n")))


def class_stats(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class (union of labels and predictions): support, predicted, tp -
    one pass over the predictions: each row counts once for its label's
    class and once for its predicted class (partially aggregated before
    the single shuffle)."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    roles = F.array(F.struct(y.alias("cls"), F.lit(1).alias("s"), F.lit(0).alias("p"), (y == p).cast("int").alias("t")),
                    F.struct(p.alias("cls"), F.lit(0).alias("s"), F.lit(1).alias("p"), F.lit(0).alias("t")))
    return (pred.select(F.explode(roles).alias("r"))
                .groupBy(F.col("r.cls").alias("cls"))
                .agg(F.sum("r.s").cast("bigint").alias("support"), F.sum("r.p").cast("bigint").alias("predicted"),
                     F.sum("r.t").cast("bigint").alias("tp")))


def per_class(stats: DataFrame) -> DataFrame:
    """Precision, recall, f1 per class (0 where undefined)."""
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    c = stats.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return c.withColumn("f1", f1)


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1."""
    c = pair_counts(pred, label, prediction)
    return c.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) /
                  F.sum("n")).alias("accuracy"))


def weighted_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     digits: int = 12) -> DataFrame:
    """Support-weighted precision, recall and F1 over the classes that
    occur as labels (the multiclass evaluator's definition), plus accuracy."""
    pc = per_class(class_stats(pred, label, prediction)).filter(F.col("support") > 0)
    tot = F.sum("support")
    return pc.agg(
        F.round(F.sum(F.col("support") * F.col("precision")) / tot, digits).alias("weighted_precision"),
        F.round(F.sum(F.col("support") * F.col("recall")) / tot, digits).alias("weighted_recall"),
        F.round(F.sum(F.col("support") * F.col("f1")) / tot, digits).alias("weighted_f1"),
        F.round(F.sum("tp") / tot, digits).alias("accuracy"),
    )


def confusion_matrix(pred: DataFrame, classes: list[int], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per class seen as label or as prediction, one column per
    predicted class and ``pred_other`` for all other predictions and nulls, so
    that a row sums to the class's support."""
    c = pair_counts(pred, label, prediction)
    roles = F.array(F.struct("label", "prediction", "n"),
                    F.when(F.col("prediction").isNotNull(),
                           F.struct(F.col("prediction").alias("label"), F.lit(None).cast("double").alias("prediction"),
                                    F.lit(0).cast("bigint").alias("n"))))
    c = c.select(F.explode(roles).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    aggs = [F.sum(F.when(F.col("prediction") == float(k), F.col("n")).otherwise(0)).cast("bigint").alias(f"pred_{k}")
            for k in classes]
    known = F.coalesce(F.col("prediction").isin([float(k) for k in classes]), F.lit(False))
    aggs.append(F.sum(F.when(known, 0).otherwise(F.col("n"))).cast("bigint").alias("pred_other"))
    return c.groupBy(F.col("label").cast("int").alias("label")).agg(*aggs)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          digits: int = 12) -> DataFrame:
    """Per class precision, recall, f1, support; then accuracy, macro
    and weighted averages (classes = labels and predictions seen)."""
    pc = materialize(per_class(class_stats(pred, label, prediction)))  # a row per class, read four times
    rnd = lambda c: F.round(c, digits)
    rows = pc.select(F.col("cls").cast("int").cast("string").alias("class"),
                     rnd(F.col("precision")).alias("precision"), rnd(F.col("recall")).alias("recall"),
                     rnd(F.col("f1")).alias("f1"), F.col("support").cast("bigint").alias("support"))
    tot = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("class"), rnd(F.avg("precision")).alias("precision"),
                   rnd(F.avg("recall")).alias("recall"), rnd(F.avg("f1")).alias("f1"),
                   tot.cast("bigint").alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("class"),
                      rnd(F.sum(F.col("support") * F.col("precision")) / tot).alias("precision"),
                      rnd(F.sum(F.col("support") * F.col("recall")) / tot).alias("recall"),
                      rnd(F.sum(F.col("support") * F.col("f1")) / tot).alias("f1"),
                      tot.cast("bigint").alias("support"))
    acc = pc.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), rnd(F.sum("tp") / tot).alias("f1"),
                 tot.cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def with_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    """The rows that have a label and a score."""
    s = F.col(score).cast("double")
    return scored.filter(F.col(label).isNotNull() & s.isNotNull() & ~F.isnan(s))


def roc_points(scored: DataFrame, label: str, score: str, positive) -> DataFrame:
    """E5: one-vs-rest ROC curve, one point per distinct score threshold
    (descending): fpr and tpr of "score >= threshold", and the origin (threshold infinity).  Rows are reduced to
    per-score counts first; the cumulative counts come from range-
    partitioned running sums, not a single-task window.  Rows without a label
    or a score (null or NaN) are on no side of a threshold and are left out."""
    per_score = (with_score(scored, label, score).groupBy(F.col(score).alias("threshold"))
                       .agg(F.sum(F.when(F.col(label) == positive, 1).otherwise(0)).cast("bigint").alias("tp"),
                            F.sum(F.when(F.col(label) == positive, 0).otherwise(1)).cast("bigint").alias("fp")))
    return _curve(per_score)


def _curve(per_threshold: DataFrame) -> DataFrame:
    """Points from (threshold, tp, fp), and the origin."""
    cum = running_sums(per_threshold, [("threshold", False)], ["tp", "fp"])
    # the running sums rest on a checkpoint: the totals don't read the predictions again
    totals = cum.agg(F.max("cum_tp").alias("P"), F.max("cum_fp").alias("N"))
    P, N = totals.select("P").scalar(), totals.select("N").scalar()
    # try_divide: a single-class input has no curve (null), not an ANSI error
    points = cum.select(F.col("threshold").cast("double").alias("threshold"), "tp", "fp", "cum_tp", "cum_fp",
                        F.try_divide(F.col("cum_fp").cast("double"), N).alias("fpr"),
                        F.try_divide(F.col("cum_tp").cast("double"), P).alias("tpr"))
    zero = F.lit(0).cast("bigint")
    origin = totals.filter(F.col("P").isNotNull()).select(
        F.lit(float("inf")).alias("threshold"), zero.alias("tp"), zero.alias("fp"), zero.alias("cum_tp"), zero.alias("cum_fp"),
        F.try_divide(F.lit(0.0), F.col("N")).alias("fpr"), F.try_divide(F.lit(0.0), F.col("P")).alias("tpr"))
    return points.unionByName(origin)


def drop_collinear(points: DataFrame) -> DataFrame:
    """E5 without the points that lie on the line between their neighbours:
    those whose step from the point before equals the step to the next one.
    The ends stay.  Neighbours meet by position in an equi-join."""
    placed = materialize(dense_rank_by(points, [("threshold", False)], name="at"))
    after = placed.select((F.col("at") - 1).alias("at"), F.col("tp").alias("next_tp"), F.col("fp").alias("next_fp"))
    straight = (F.col("at") > 1) & (F.col("tp") == F.col("next_tp")) & (F.col("fp") == F.col("next_fp"))
    return placed.join(after, "at", "left").filter(~F.coalesce(straight, F.lit(False))).select(*points.columns)


SKETCH_SIZE = 800


def roc_points_sketched(scored: DataFrame, label: str, score: str, positive, max_points: int = 1000,
                        sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """E5 with at most ``max_points`` thresholds (the origin included), however many scores there are.

    Thresholds are quantiles of all scores from mergeable KLL sketches.  The
    counts at each threshold are exact: only thresholds are left out, so every
    point lies on the exact curve."""
    s = with_score(scored, label, score).select(F.col(score).cast("double").alias("s"),
                                                F.coalesce(F.col(label) == positive, F.lit(False)).alias("p"))
    n = max_points - 1
    shares = F.array(*[F.lit(i / n) for i in range(n)])
    sketch = s.agg(F.kll_sketch_agg_double("s", sketch_size).alias("k"), F.min("s").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    cuts = sketch.select(F.array_sort(F.array_distinct(F.concat(F.array("least"), F.kll_sketch_get_quantile_double("k", shares)))).alias("c"))
    found = cuts.head()
    if found is None:
        return roc_points(scored, label, score, positive).limit(0)
    # at most max_points numbers: the largest cut not above a score stands for it
    table = np.unique(np.array(found["c"][:n + 1], float))[:n].tolist()
    splits = sorted({float("-inf"), *table, float("inf")})
    cut = Bucketizer(splits=splits, inputCol="s", outputCol="at").transform(s)
    numbers = F.array(*[F.lit(c) for c in splits])
    binned = cut.withColumn("threshold", F.element_at(numbers, F.col("at").cast("int") + 1))
    per_cut = binned.groupBy("threshold").agg(F.sum(F.col("p").cast("int")).cast("bigint").alias("tp"),
                                              F.sum((~F.col("p")).cast("int")).cast("bigint").alias("fp"))
    return _curve(per_cut)


def roc_auc(scored: DataFrame, label: str, score: str, positive, digits: int = 10) -> DataFrame:
    """Trapezoidal area under the E5 curve (from the origin)."""
    return _area(roc_points(scored, label, score, positive), digits).select("auc")


def roc_auc_sketched(scored: DataFrame, label: str, score: str, positive, digits: int = 10, max_points: int = 1000) -> DataFrame:
    """E6 from a bounded number of thresholds: auc and ``error``, a bound of its
    distance from the exact area (half the positives times the negatives that
    share a threshold, over all such pairs)."""
    return _area(roc_points_sketched(scored, label, score, positive, max_points), digits)


def _area(pts: DataFrame, digits: int) -> DataFrame:
    P = F.sum(F.col("tp").cast("double"))
    N = F.sum(F.col("fp").cast("double"))
    area = F.try_divide(F.sum(F.col("fp").cast("double") * (2 * F.col("cum_tp") - F.col("tp")).cast("double")),
                        2 * P * N)
    mixed = F.try_divide(F.sum(F.col("tp").cast("double") * F.col("fp").cast("double")), 2 * P * N)
    return pts.agg(F.round(area, digits).alias("auc"), mixed.alias("error"))
