"""What speaks for a single prediction (R5, R7): additive contributions.

Logistic regression: slot i of a user adds coefficient_i x (value_i -
mean_i) to the log odds of the mean user.

Trees: path-dependent Shapley values. A leaf is reached through conditions
on a few slots U. With the slots S known to the reader, the leaf counts with
the product of o_j (does the user meet the conditions on j: 0 or 1) over S
and of z_j (the share of training rows that go the leaf's way at the splits
on j) over the others, so its Shapley values depend only on which of the
conditions the user meets. Each pattern met in a batch is worked out once;
per user remain comparisons and a lookup. The trees travel to the tasks as
plain lists (a node each), whatever the number of users.

The contributions of a user and the base value add up to the model's raw
score: the log odds, the boosted trees' sum, the forest's mean probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from churnkit.operators import mlprep


def _long(df: DataFrame, names: dict[int, str], key: str) -> DataFrame:
    """(key, base_value, contributions) as a row per slot with a name."""
    lookup = F.array(*[F.lit(names.get(i, f"f{i}")) for i in range(max(names, default=-1) + 1)])
    rows = df.select(key, "base_value", F.posexplode("contributions").alias("idx", "contribution"))
    name = F.coalesce(F.get(lookup, F.col("idx")), F.concat(F.lit("f"), F.col("idx").cast("string")))
    return rows.select(key, "base_value", "idx", name.alias("feature"), "contribution")


def mean_vector(df: DataFrame, vec: str) -> list[float]:
    """The mean of each slot: one aggregate, one row."""
    return df.select(Summarizer.mean(F.col(vec))).first()[0].toArray().tolist()


def lr_contributions(model, df: DataFrame, means: Sequence[float], vec: str = "scaled_features",
                     key: str = "userId") -> DataFrame:
    """(key, base_value, idx, feature, contribution) of a binary logistic
    regression; ``means`` are those of the training split."""
    coefficients = model.coefficients.toArray().tolist()
    base = model.intercept + sum(c * m for c, m in zip(coefficients, means))
    weights, centre = (F.array(*map(F.lit, map(float, v))) for v in (coefficients, means))
    gaps = F.zip_with(vector_to_array(vec), centre, lambda x, m: x - m)
    rows = df.select(key, F.lit(float(base)).alias("base_value"),
                     F.zip_with(gaps, weights, lambda g, c: g * c).alias("contributions"))
    return _long(rows, dict(mlprep.vector_names(df, vec)), key)


# trees ---------------------------------------------------------------------
class Leaf:
    """A leaf: its value, the share of rows that reach it, and for each slot
    on its path the conditions and z. A condition is (threshold, left) or
    (set of left categories, left)."""

    def __init__(self, value: float, cover: float, path: dict[int, list], z: dict[int, float]):
        self.value, self.cover = value, cover
        self.slots = sorted(path)
        self.conditions = [path[s] for s in self.slots]
        self.z = [z[s] for s in self.slots]


def leaves_of(root, value) -> list[Leaf]:
    """The leaves of a fitted tree; ``value(node)`` is a leaf's value."""
    out: list[Leaf] = []

    def visit(node, cover, path, z):
        if "Leaf" in node.getClass().getSimpleName():
            out.append(Leaf(value(node), cover, path, z))
            return
        split = node.split()
        slot, total = split.featureIndex(), node.impurityStats().count()
        test = (split.threshold() if "Continuous" in split.getClass().getSimpleName()
                else frozenset(float(x) for x in split.leftCategories()))
        for left, child in ((True, node.leftChild()), (False, node.rightChild())):
            share = child.impurityStats().count() / total
            visit(child, cover * share, {**path, slot: [*path.get(slot, ()), (test, left)]},
                  {**z, slot: z.get(slot, 1.0) * share})

    visit(root, 1.0, {}, {})
    return out


def _met(x: np.ndarray, conditions: list) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test, left in conditions:
        goes_left = np.isin(x, list(test)) if isinstance(test, frozenset) else x <= test
        out &= goes_left == left
    return out


def leaf_values(leaf: Leaf, met: Sequence[bool]) -> np.ndarray:
    """Shapley values of the leaf's slots for a user that meets the
    conditions ``met``."""
    d = len(leaf.slots)
    weight = [math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)]
    out = np.zeros(d)
    for i in range(d):
        by_size = np.ones(1)  # known slots -> sum of products over the sets of that size
        for j in range(d):
            if j != i:
                by_size = np.convolve(by_size, [leaf.z[j], float(met[j])])
        out[i] = leaf.value * (float(met[i]) - leaf.z[i]) * float(by_size @ np.array(weight))
    return out


def tree_parts(model) -> list[tuple[float, list[Leaf]]]:
    """(weight, leaves) of each tree of a fitted classifier: boosted trees
    by their predictions, forests and single trees by the churn share."""
    def share(node):
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats)

    trees = getattr(model, "trees", None)
    if trees is None:
        return [(1.0, leaves_of(model._java_obj.rootNode(), share))]
    boosted = "GBT" in type(model).__name__
    weights = model.treeWeights if boosted else [1.0 / len(trees)] * len(trees)
    return [(float(w), leaves_of(t._java_obj.rootNode(), (lambda n: n.prediction()) if boosted else share))
            for w, t in zip(weights, trees)]


def base_value(parts: list[tuple[float, list[Leaf]]]) -> float:
    return sum(w * sum(leaf.cover * leaf.value for leaf in leaves) for w, leaves in parts)


def shapley(x: np.ndarray, parts: list[tuple[float, list[Leaf]]]) -> np.ndarray:
    """Contributions of every slot of the rows ``x``."""
    out = np.zeros_like(x, dtype=float)
    for weight, leaves in parts:
        for leaf in leaves:
            if not leaf.slots:
                continue
            met = np.stack([_met(x[:, s], c) for s, c in zip(leaf.slots, leaf.conditions)], axis=1)
            patterns, back = np.unique(met, axis=0, return_inverse=True)
            table = np.stack([leaf_values(leaf, p) for p in patterns])
            out[:, leaf.slots] += weight * table[back.reshape(-1)]
    return out


def tree_contributions(model, df: DataFrame, vec: str = "scaled_features", key: str = "userId") -> DataFrame:
    """(key, base_value, idx, feature, contribution) of a fitted tree,
    forest or boosted trees."""
    parts = tree_parts(model)
    base, slots = base_value(parts), model.numFeatures

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, slots)
            values = shapley(x, parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([base] * len(x), pa.float64()), pa.array(list(values), pa.list_(pa.float64()))],
                names=[key, "base_value", "contributions"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, vector_to_array(vec).alias("_x")).mapInArrow(
        explain, f"`{key}` {kind}, base_value double, contributions array<double>")
    return _long(rows, dict(mlprep.vector_names(df, vec)), key)
