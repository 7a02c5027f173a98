"""ROC curves of many models in one sorted pass.

Scores are counted by (model, score) first, so ties are one point and a
model's curve has as many points as distinct scores. Running sums over each
model's points from the highest score down (``ranks.running_sums``: ranges,
totals per range, carry) give true and false positives at every threshold;
area, best threshold and best F1 of all models are one aggregate over them.
No task sorts a whole model, and no curve reaches the driver.

Rows without a score or label are left out. A model without rows of both
classes has no area (null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from churnkit.operators.ranks import running_sums


def roc_points(scored: DataFrame, model: str = "model", score: str = "score", label: str = "label") -> DataFrame:
    """(model, threshold, pos, neg, tp, fp): for every distinct score, the
    rows with it and the rows with at least it, by class."""
    points = (scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(model).alias("model"), F.col(score).alias("threshold"))
              .agg(F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) != 1.0).alias("neg")))
    return running_sums(points, ["model"], [F.desc("threshold")], {"tp": "pos", "fp": "neg"})


def roc_curve(points: DataFrame) -> DataFrame:
    """(model, threshold, tp, fp, tpr, fpr) of ``roc_points``."""
    totals = points.groupBy(F.col("model").alias("_model")).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    joined = points.join(totals, points["model"].eqNullSafe(totals["_model"]))
    return joined.select("model", "threshold", "tp", "fp", F.try_divide("tp", "_p").alias("tpr"),
                         F.try_divide("fp", "_n").alias("fpr"))


def roc_summary(points: DataFrame) -> DataFrame:
    """One row per model: n_pos, n_neg, area_under_roc (trapezoids between
    the points), and the threshold of best F1 (ties: the highest)."""
    # twice the area under the step from the point before, in whole numbers
    step = F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos"))
    sums = points.groupBy("model").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(step).alias("_area"),
        # with P positives F1 = 2 tp / (tp + fp + P); the order needs P
        F.max("tp").alias("_p"))
    both = points.join(sums.select(F.col("model").alias("_model"), "_p"), F.col("model").eqNullSafe(F.col("_model")))
    f1 = F.try_divide(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("_p"))
    best = both.groupBy(F.col("model").alias("_model")).agg(F.max(F.struct(f1.alias("f1"), "threshold")).alias("_best"))
    area = F.try_divide(F.col("_area"), 2.0 * F.col("n_pos") * F.col("n_neg"))
    return (sums.join(best, sums["model"].eqNullSafe(best["_model"]))
            .select("model", "n_pos", "n_neg", area.alias("area_under_roc"), F.col("_best.f1").alias("best_f1"),
                    F.col("_best.threshold").alias("best_threshold")))
