"""Evaluator arithmetic on a fixed prediction table, against MLlib's evaluators."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from churnkit.operators import evaluate

ROWS = [(1.0, 1.0)] * 2 + [(1.0, 0.0)] + [(0.0, 0.0)] * 6 + [(0.0, 1.0)]


@pytest.fixture(scope="module")
def pred(spark):
    return spark.createDataFrame(ROWS, "prediction double, label double")


def test_confusion(pred):
    r = evaluate.confusion_counts(pred).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 1, 6, 1)


def test_metrics_match_evaluator(pred):
    m = evaluate.classification_metrics(pred).first().asDict()
    for ours, theirs in (("weighted_f1", "f1"), ("accuracy", "accuracy"),
                         ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")):
        ref = MulticlassClassificationEvaluator(metricName=theirs).evaluate(pred)
        assert m[ours] == pytest.approx(ref, abs=1e-12), ours
    assert m["churn_f1"] == pytest.approx(2 / 3)
    assert m["accuracy"] == pytest.approx(0.8)


def test_confusion_pct(pred):
    r = evaluate.confusion_pct(evaluate.confusion_counts(pred)).first()
    assert (r.tp_pct, r.fp_pct, r.tn_pct, r.fn_pct) == pytest.approx((20.0, 10.0, 60.0, 10.0))
