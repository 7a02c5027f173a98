"""ML: split determinism, leak guard, save/load parity, entry smoke."""

import pytest

import __spark_entry__ as E
from churnkit.operators import mlprep, train
from churnkit.plans import registry
from tests.conftest import SF001, SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["userId", "gender", "unique_artist_count"]


def test_split_is_deterministic(spark):
    users = registry.user_table(spark, SF01)
    a = sorted(map(tuple, mlprep.assign_split(users).select("userId", "split").collect()))
    b = sorted(map(tuple, mlprep.assign_split(users.repartition(7)).select("userId", "split").collect()))
    assert a == b
    counts = {r.split: r["count"] for r in mlprep.assign_split(users).groupBy("split").count().collect()}
    assert set(counts) == {"train", "validation", "test"}


def test_leaky_inputs_refused():
    with pytest.raises(ValueError):
        mlprep.model_inputs(numeric=["Cancel", "Home"])


def test_single_class_split_refused(spark):
    with pytest.raises(ValueError):
        train.PreparedSplits(registry.user_table(spark, SF001).filter("churn_label = 0"))


def test_save_load_parity(spark):
    rows = E.queries()["model_save_load"](spark, SF01).collect()
    assert rows and all(r.same for r in rows)


def test_lr_metrics_deterministic(spark):
    s = train.PreparedSplits(registry.user_table(spark, SF01))
    _, m1, _ = train.train_and_evaluate(train.logistic_regression(), s.train, s.validation)
    _, m2, _ = train.train_and_evaluate(train.logistic_regression(), s.train, s.validation)
    assert m1 == m2


def test_an_empty_grid_is_one_candidate():
    assert len(train.param_grid(train.logistic_regression(), {})) == 1
    assert len(train.param_grid(train.logistic_regression())) == 27


def test_missing_inputs_are_named(spark):
    from churnkit.operators import score
    from churnkit.session import scratch_path
    from pyspark.ml import Pipeline
    s = train.PreparedSplits(registry.user_table(spark, SF01))
    model = Pipeline(stages=[*mlprep.transform_stages(s.inputs), train.logistic_regression()]).fit(s.raw_train)
    path = scratch_path(spark, "model")
    score.save_model(model, path, s.inputs)
    with pytest.raises(ValueError, match="state"):
        score.score_with_saved_model(spark, path, s.raw_test.drop("state"))


def test_written_splits_equal_the_transformed_ones(spark):
    from churnkit.plans import queries_ml
    got = E.queries()["splits_json_roundtrip"](spark, SF01)
    want = queries_ml._transformed(train.PreparedSplits(registry.user_table(spark, SF01)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_boosted_trees_are_tuned_by_five_folds(spark, monkeypatch):
    asked, whole = [], train.cross_validate

    def spy(*args, folds=5, **kw):
        asked.append(folds)
        # trees of one level: the test is of the job's shape
        return whole(*args, folds=folds, **kw | {"estimator": kw["estimator"].setMaxIter(1).setMaxDepth(1)})

    monkeypatch.setattr(train, "cross_validate", spy)
    row, = registry.queries()["cross_validate_gbt_scores"](spark, SF01).collect()
    assert row.is_best and 0 < row.avg_f1 <= 1
    assert all(0 <= row[f"{split}_{m}"] <= 1 for split in ("validation", "test") for m in ("auc", "f1"))
    assert registry.queries()["cross_validate_gbt"](spark, SF01).first().n_candidates == 1
    assert asked == [5, 5]
