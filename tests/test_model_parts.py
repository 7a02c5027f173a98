"""Running sums, ROC curves, fold statistics and contributions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.operators import explain, folds, mlprep, ranks, roc, train


@pytest.fixture
def many_ranges(spark):
    """Ranges are not joined, so small tables are dealt over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_sums_and_numbers(many_ranges):
    rng = random.Random(1)
    rows = [(g, i, rng.randrange(5)) for g in ("a", "b", None) for i in range({"a": 400, "b": 3, None: 60}[g])]
    rng.shuffle(rows)
    df = many_ranges.createDataFrame(rows, "g string, i int, v long").repartition(6)
    found = ranks.running_sums(df, ["g"], [F.desc("i")], {"total": "v"}).collect()
    wanted = {(g, i): sum(v for h, j, v in rows if h == g and j >= i) for g, i, _ in rows}
    assert {(r.g, r.i): r.total for r in found} == wanted and len(found) == len(rows)
    numbers = ranks.numbered(df, [F.desc("v"), "i", "g"], "n", 7).collect()
    order = sorted(numbers, key=lambda r: r.n)
    assert [r.n for r in order] == list(range(7, 7 + len(rows)))
    keys = [(-r.v, r.i) for r in order]
    assert keys == sorted(keys)
    assert ranks.numbered(df.where("false"), ["i"], "n").collect() == []


def test_roc_equals_the_evaluator(many_ranges):
    rng = random.Random(2)
    rows = [(m, rng.randrange(n) / n, float(rng.random() < 0.3)) for m, n in (("few", 4), ("many", 5000)) for _ in range(700)]
    rows += [("one", 0.5, 1.0), (None, 0.1, 0.0), (None, 0.2, 1.0), ("few", None, 1.0), ("few", 0.5, None)]
    df = many_ranges.createDataFrame(rows, "model string, score double, label double").repartition(5)
    points = roc.roc_points(df).cache()
    found = {r.model: r for r in roc.roc_summary(points).collect()}
    for m in ("few", "many", None):
        part = df.where(F.col("model").eqNullSafe(F.lit(m))).dropna(subset=["score", "label"])
        area = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(part)
        assert found[m].area_under_roc == pytest.approx(area, abs=1e-12)
        own = [(s, y) for k, s, y in rows if k == m and s is not None and y is not None]
        best = max((2 * sum(y for s, y in own if s >= t) / (sum(s >= t for s, _ in own) + sum(y for _, y in own)), t)
                   for t in {s for s, _ in own})
        assert (found[m].best_f1, found[m].best_threshold) == pytest.approx(best)
    assert found["one"].area_under_roc is None
    curve = {(r.model, r.threshold): (r.tp, r.fp) for r in roc.roc_curve(points).collect()}
    assert curve["few", 0.0] == (found["few"].n_pos, found["few"].n_neg)


def users(spark, n=300):
    rng = random.Random(3)
    rows = [(f"u{i}", float(rng.random() < 0.4), rng.choice("xyyzzz") if rng.random() > 0.1 else None, rng.choice("FM"),
             1e8 + rng.random(), rng.randrange(9), 5.0) for i in range(n)]
    return spark.createDataFrame(rows, "userId string, label double, state string, gender string, far double, small long, same double")


def test_fold_transforms_equal_the_fitted_pipeline(spark):
    inputs = ["far", "small", "same", "state_encoded", "gender_encoded"]
    data = users(spark).withColumn("fold", (mlprep.split_bucket() % 3).cast("int")).cache()
    found = folds.fold_statistics(data, inputs)
    for k in range(3):
        inside = data.where(F.col("fold") != k)
        fitted = mlprep.feature_transform(inputs).fit(inside).transform(data)
        wanted = {r.userId: r.v for r in fitted.select("userId", vector_to_array("scaled_features").alias("v")).collect()}
        mine = data.select("userId", vector_to_array(folds.scaled_vector(found.without(k))).alias("v")).collect()
        for r in mine:
            assert r.v == pytest.approx(wanted[r.userId], abs=1e-6)


def test_moments_of_values_far_from_zero():
    rng = np.random.default_rng(4)
    parts = [1e9 + rng.random(n) for n in (5, 1, 40)]
    merged = sum((folds.Moments(len(p), p.mean(), ((p - p.mean()) ** 2).sum()) for p in parts), folds.Moments())
    whole = np.concatenate(parts)
    assert merged.mean == pytest.approx(whole.mean()) and merged.sd == pytest.approx(whole.std(ddof=1), rel=1e-6)


def test_empty_folds_are_refused(spark):
    with pytest.raises(ValueError, match="folds without rows"):
        train.cross_validate(users(spark, 3), ["small"], grid={}, folds=50)


def test_frequency_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    index = mlprep.frequency_index(df, "v")
    assert [tuple(r) for r in index.orderBy("idx").collect()] == [("b", 2, 0), ("c", 2, 1), ("a", 1, 2)]
    more = df.union(spark.createDataFrame([("new",)], "v string"))
    found = mlprep.with_frequency_index(more, "v", index).collect()
    assert {r.v: r.v_index for r in found} == {"b": 0, "c": 1, "a": 2, None: 3, "new": 3} and len(found) == 7
    assert mlprep.frequency_index(df.where("false"), "v").collect() == []


# contributions ---------------------------------------------------------------
def conditional(node, x, known, value):
    """The tree's mean value where only the slots ``known`` are known."""
    if "Leaf" in node.getClass().getSimpleName():
        return value(node)
    split, children = node.split(), (node.leftChild(), node.rightChild())
    if split.featureIndex() in known:
        return conditional(children[0 if x[split.featureIndex()] <= split.threshold() else 1], x, known, value)
    total = node.impurityStats().count()
    return sum(c.impurityStats().count() / total * conditional(c, x, known, value) for c in children)


def shapley_brute(root, x, value):
    n, out = len(x), []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        out.append(sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                       * (conditional(root, x, {*s, i}, value) - conditional(root, x, set(s), value))
                       for k in range(n) for s in itertools.combinations(others, k)))
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x = [rng.randrange(6) / 2, rng.random(), float(rng.randrange(2)), rng.random()]
        rows.append((f"u{i}", float((x[0] > 1) ^ (x[1] > 0.4) or (x[2] > 0 and rng.random() < 0.6)), *x))
    df = spark.createDataFrame(rows, "userId string, label double, a double, b double, c double, d double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="scaled_features").transform(df).cache()


MODELS = {
    "tree": lambda: DecisionTreeClassifier(featuresCol="scaled_features", maxDepth=5),
    "forest": lambda: train.random_forest().setNumTrees(4),
    "boosted": lambda: train.gradient_boosted_trees().setMaxIter(4),
}


@pytest.mark.parametrize("name", MODELS)
def test_tree_contributions(spark, vectors, name):
    model = MODELS[name]().fit(vectors)
    some = vectors.limit(25).cache()
    found = explain.tree_contributions(model, some).collect()
    pred = {r.userId: r for r in model.transform(some).collect()}
    assert {r.feature for r in found} == set("abcd") and len(found) == 100
    share = lambda n: list(n.impurityStats().stats())[1] / sum(n.impurityStats().stats())
    boosted = name == "boosted"
    trees = [(1.0, model)] if name == "tree" else [
        (w if boosted else 1 / 4, t) for w, t in zip(model.treeWeights, model.trees)]
    value = (lambda n: n.prediction()) if boosted else share
    for user, r in pred.items():
        own = {x.feature: x.contribution for x in found if x.userId == user}
        base = next(x.base_value for x in found if x.userId == user)
        raw = r.rawPrediction[1] if boosted else r.probability[1]
        assert base + sum(own.values()) == pytest.approx(raw, abs=1e-9)
        x = [r.a, r.b, r.c, r.d]
        brute = sum(w * np.array(shapley_brute(t._java_obj.rootNode(), x, value)) for w, t in trees)
        assert [own[f] for f in "abcd"] == pytest.approx(list(brute), abs=1e-9)
        if user in list(pred)[4:]:
            break


def test_lr_contributions_add_up(spark, vectors):
    model = train.logistic_regression().fit(vectors)
    means = explain.mean_vector(vectors, "scaled_features")
    found = explain.lr_contributions(model, vectors, means).collect()
    totals = {}
    for r in found:
        totals[r.userId] = totals.get(r.userId, r.base_value) + r.contribution
    for r in model.transform(vectors).collect():
        assert totals[r.userId] == pytest.approx(r.rawPrediction[1], abs=1e-9)
    assert sum(r.contribution for r in found) == pytest.approx(0, abs=1e-6)


def test_a_tree_without_splits(spark, vectors):
    one = vectors.where("label = 1")
    model = train.gradient_boosted_trees().setMaxIter(1).fit(one.union(one.limit(1).withColumn("label", F.lit(0.0))).limit(2))
    assert all(r.contribution == 0 or r.base_value is not None for r in explain.tree_contributions(model, one.limit(3)).collect())
