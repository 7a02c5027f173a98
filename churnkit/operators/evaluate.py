"""Evaluation (E1-E4, E7-E9): AUC, confusion counts and the metrics derived
from them.

Confusion counts are ONE aggregate (four conditional counts) instead of a
job per cell; precision / recall / F1 / accuracy follow from the four
numbers, class-weighted as the multiclass evaluator reports them and for
the churn class alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, functions as F


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """Tp, fp, tn, fn in one pass, of all rows or for each group ``by``."""
    p, y = F.col(prediction), F.col(label)
    return (pred.groupBy(*by) if by else pred).agg(
        F.count_if((p == 1.0) & (y == 1.0)).alias("tp"),
        F.count_if((p == 1.0) & (y == 0.0)).alias("fp"),
        F.count_if((p == 0.0) & (y == 0.0)).alias("tn"),
        F.count_if((p == 0.0) & (y == 1.0)).alias("fn"),
    )


def _div(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b is 0 (the evaluator's convention)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def confusion_pct(counts: DataFrame) -> DataFrame:
    """Each cell as % of all rows."""
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return counts.select(*[(_div(F.col(c), total) * F.lit(100.0)).alias(f"{c}_pct")
                           for c in ("tp", "fp", "tn", "fn")])


def metrics_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E2 / E3 from confusion counts: accuracy, class-weighted precision /
    recall / F1 (the multiclass evaluator's ``weighted*`` and ``f1``) and
    the churn-class precision / recall / F1."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(p1 * r1 * 2.0, p1 + r1), _div(p0 * r0 * 2.0, p0 + r0)
    w1, w0 = _div(tp + fn, n), _div(tn + fp, n)
    return counts.select(
        *by,
        _div(tp + tn, n).alias("accuracy"),
        (w0 * p0 + w1 * p1).alias("weighted_precision"),
        (w0 * r0 + w1 * r1).alias("weighted_recall"),
        (w0 * f1_0 + w1 * f1_1).alias("weighted_f1"),
        p1.alias("churn_precision"),
        r1.alias("churn_recall"),
        f1_1.alias("churn_f1"),
    )


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return metrics_from_counts(confusion_counts(pred, label, prediction))


def area_under_roc(pred: DataFrame, label: str = "label", raw: str = "rawPrediction",
                   num_bins: int = 0) -> float:
    """Area under ROC; ``num_bins=0`` = exact curve (distributed sort of
    the scores), a positive value down-samples the curve."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label,
                                       metricName="areaUnderROC", numBins=num_bins)
    return ev.evaluate(pred)


def confusion_comparison(named: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Confusion counts of several models, one row per model."""
    rows = [confusion_counts(p).select(F.lit(name).alias("model"), "*") for name, p in named]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
