"""Cross-validation transforms from mergeable statistics.

One aggregate (grouping sets over the fold and each categorical) gives, per
fold, the rows, mean and squared deviations of every numeric input and the
counts of every category. The statistics of all folds but one are merged
from those of the single folds, so k transform fits need one pass instead of
k times several. Merging is by means and squared deviations: subtracting
sums of squares would lose the digits of inputs far from zero.

A fold's transform (categories by falling count, one-hot, standardised)
is an expression with these numbers in it; its values equal those of the
fitted pipeline of ``mlprep``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from churnkit.operators import mlprep
from churnkit.schema import CATEGORICAL_COLUMNS


@dataclass(frozen=True)
class Moments:
    """Rows, mean and sum of squared deviations; ``+`` merges two sets."""
    n: int = 0
    mean: float = 0.0
    dev: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * other.n / n, self.dev + other.dev + gap * gap * self.n * other.n / n)

    @property
    def sd(self) -> float:
        return math.sqrt(self.dev / (self.n - 1)) if self.n > 1 else 0.0


@dataclass
class FoldStatistics:
    numeric: dict[int, dict[str, Moments]]  # fold -> input -> moments
    rows: dict[int, int]
    counts: dict[int, dict[str, dict[str, int]]]  # fold -> categorical -> value -> rows

    def without(self, fold: int) -> list[tuple[str, object, Moments]]:
        """The slots of the transform fitted on the other folds: (input,
        category or None, moments)."""
        others = [k for k in self.rows if k != fold]
        n = sum(self.rows[k] for k in others)
        out = []
        for c in next(iter(self.numeric.values())):
            out.append((c, None, sum((self.numeric[k][c] for k in others), Moments())))
        for c in next(iter(self.counts.values())):
            merged: dict[str, int] = {}
            for k in others:
                for value, m in self.counts[k][c].items():
                    merged[value] = merged.get(value, 0) + m
            for value, m in sorted(merged.items(), key=lambda x: (-x[1], x[0])):
                out.append((c, value, Moments(n, m / n, m - m * m / n)))
        return out


def fold_statistics(data: DataFrame, inputs: Sequence[str] | None = None, fold: str = "fold") -> FoldStatistics:
    """The statistics of each fold, in one aggregate. What reaches the
    driver is a row per fold and per fold's category, as with the indexer."""
    inputs = list(inputs or mlprep.model_inputs())
    categoricals = [c for c in CATEGORICAL_COLUMNS if mlprep.encoded_col(c) in inputs]
    numeric = [c for c in inputs if c not in map(mlprep.encoded_col, CATEGORICAL_COLUMNS)]
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"_mean{i}"), (F.var_pop(x) * n).alias(f"_dev{i}")]
    rows = data.groupingSets([[fold], *([fold, c] for c in categoricals)], fold, *categoricals).agg(
        F.grouping_id().alias("_gid"), *aggs).collect()
    whole = (1 << len(categoricals)) - 1
    out = FoldStatistics({}, {}, {})
    for r in rows:
        if r["_gid"] == whole:
            out.rows[r[fold]] = r["_n"]
            out.numeric[r[fold]] = {c: Moments(r["_n"], r[f"_mean{i}"], r[f"_dev{i}"]) for i, c in enumerate(numeric)}
    out.counts = {k: {c: {} for c in categoricals} for k in out.rows}
    for r in rows:
        for i, c in enumerate(categoricals):
            if r["_gid"] == whole - (1 << (len(categoricals) - 1 - i)) and r[c] is not None:
                out.counts[r[fold]][c][r[c]] = r["_n"]
    return out


def scaled_vector(slots: list[tuple[str, object, Moments]]) -> Column:
    """The standardised vector of a fold's transform; a constant slot is 0."""
    values = []
    for c, category, m in slots:
        x = F.col(c).cast("double") if category is None else F.when(F.col(c) == category, 1.0).otherwise(0.0)
        values.append((x - F.lit(m.mean)) * F.lit(1.0 / m.sd) if m.sd > 0 else F.lit(0.0))
    return array_to_vector(F.array(*values))
