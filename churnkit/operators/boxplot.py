"""The numbers behind box plots (A29): exact quartiles from mergeable
sketches, whiskers and outliers.

``value_sketches`` reduces values to a KLL sketch, count, least and largest
per group, and ``merge_sketches`` adds up those of finer groups (days,
regions), so a new day's values need not wait for the old ones to be read.

A sketch gives approximate quantiles. ``quartiles`` turns them into exact
ones without a sort: a band around each approximate quartile is read off the
sketch, one pass counts the values below the band and those inside by value,
and the value at rank max(1, ceil(p n)) is picked from a running count over
the band. Whether the rank lies in the band is checked; where it does not
(KLL's error holds with a probability, not always) the band is moved to all
that lies on the side of the miss, which holds the rank for certain, and the
pass is repeated for these alone. No task gathers a group's values.

``box_plot`` adds what Tukey's plot draws: the whisker ends are the outermost
values within 1.5 quartile ranges of the box, what lies beyond are outliers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from churnkit.operators.joins import sized_broadcast
from churnkit.session import reliable_checkpoint

QUARTILES = (0.25, 0.5, 0.75)
SKETCH_K = 2000
REACH = 1.5
NAMES = ("q1", "median", "q3")


def rank_error(k: int) -> float:
    """The rank error (a share of n) that a KLL sketch of size ``k`` keeps
    with 99 % probability."""
    return 2.296 / k ** 0.9021


def value_sketches(values: DataFrame, group: Sequence[str], k: int = SKETCH_K, value: str = "value") -> DataFrame:
    """(group, n, min_value, max_value, sketch) of the non-null values."""
    return values.groupBy(*group).agg(
        F.count(value).alias("n"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.kll_sketch_agg_double(value, k).alias("sketch"))


def merge_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """``value_sketches`` of coarser groups."""
    return sketches.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def on_groups(a: DataFrame, b: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, nulls being equal; those of ``a`` stay."""
    names = {c: f"_group_{i}" for i, c in enumerate(group)}
    b = b.withColumnsRenamed(names)
    condition = F.lit(True)
    for c, other in names.items():
        condition = condition & a[c].eqNullSafe(b[other])
    return a.join(b, condition, how).drop(*names.values())


def _targets(sketches: DataFrame, group: Sequence[str], slack: float) -> DataFrame:
    """(group, q, rank, lo, hi): each quartile's rank and band."""
    probabilities = F.array(*[F.lit(min(max(p + d, 0.0), 1.0)) for p in QUARTILES for d in (-slack, slack)])
    ends = F.kll_sketch_get_quantile_double("sketch", probabilities)
    each = [F.struct(F.lit(i).alias("q"), F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("n"))).cast("long").alias("rank"),
                     F.col("_ends")[2 * i].alias("lo"), F.col("_ends")[2 * i + 1].alias("hi"))
            for i, p in enumerate(QUARTILES)]
    return (sketches.where(F.col("n") > 0).withColumn("_ends", ends)
            .select(*group, F.explode(F.array(*each)).alias("t")).select(*group, "t.*"))


def _look(values: DataFrame, targets: DataFrame, group: Sequence[str], max_groups: int) -> DataFrame:
    """(group, q, rank, lo, hi, below, inside, picked) of each target: the
    values below the band and inside, and the value at the rank (null if
    that lies elsewhere)."""
    v = F.col("value")
    side = F.when(v < F.col("lo"), 0).when(v <= F.col("hi"), 1)
    target = [*group, "q", "rank", "lo", "hi"]
    counted = (on_groups(values.where(v.isNotNull()), sized_broadcast(targets, len(QUARTILES) * max_groups), group)
               .withColumn("_side", side).where(F.col("_side").isNotNull())
               .groupBy(*target, "_side", F.when(F.col("_side") == 1, v).alias("v")).agg(F.count(F.lit(1)).alias("c")))
    whole = Window.partitionBy(*target)
    upto = F.sum("c").over(whole.orderBy("_side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.select("*", upto.alias("_upto"), F.sum(F.when(F.col("_side") == 0, F.col("c"))).over(whole).alias("_below"))
    found = ranked.groupBy(*target).agg(
        F.coalesce(F.max("_below"), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("_side") == 1, F.col("c"))), F.lit(0)).alias("inside"),
        F.min(F.when((F.col("_side") == 1) & (F.col("_upto") >= F.col("rank")), F.col("v"))).alias("_value"))
    hit = (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("inside"))
    found = found.select(*group, "q", "below", "inside", F.when(hit, F.col("_value")).alias("picked"))
    # a band without values, and none below it, has no counts
    return on_groups(targets, found, [*group, "q"], "left")


def quartiles(values: DataFrame, group: Sequence[str], sketches: DataFrame | None = None, k: int = SKETCH_K,
              slack: float | None = None, max_groups: int = 10_000) -> DataFrame:
    """(group, n, min_value, q1, median, q3, max_value) of ``values``
    (group, value), exact. ``sketches`` (of the same values) saves the pass
    that makes them; ``slack`` is the band's reach to each side, a share of
    the values."""
    sketches = reliable_checkpoint(value_sketches(values, group, k) if sketches is None else sketches)
    slack = 1.5 * rank_error(k) if slack is None else slack
    ends = sketches.select(*group, "n", "min_value", "max_value")
    targets = _targets(sketches, group, slack)
    picked = reliable_checkpoint(_look(values, targets, group, max_groups))
    missed = picked.where(F.col("picked").isNull())
    if not missed.isEmpty():
        wider = on_groups(missed.drop("picked"), ends.drop("n"), group)
        low = F.col("rank") <= F.coalesce("below", F.lit(0))
        wider = wider.select(*group, "q", "rank", F.when(low, F.col("min_value")).otherwise(F.col("lo")).alias("lo"),
                             F.when(low, F.greatest("lo", "hi")).otherwise(F.col("max_value")).alias("hi"))
        again = _look(values, reliable_checkpoint(wider), group, max_groups)
        picked = picked.where(F.col("picked").isNotNull()).unionByName(again)
    wide = picked.groupBy(*group).agg(*[F.max(F.when(F.col("q") == i, F.col("picked"))).alias(c) for i, c in enumerate(NAMES)])
    return on_groups(ends, wide, group, "left").select(*group, "n", "min_value", *NAMES, "max_value")


def _fences(box: DataFrame) -> DataFrame:
    spread = (F.col("q3") - F.col("q1")) * REACH
    return box.withColumns({"_low": F.col("q1") - spread, "_high": F.col("q3") + spread})


def box_plot(values: DataFrame, box: DataFrame, group: Sequence[str]) -> DataFrame:
    """``box`` (of ``quartiles``) with lower_whisker, upper_whisker and
    n_outliers."""
    v = F.col("value")
    within = v.between(F.col("_low"), F.col("_high"))
    fences = _fences(box).select(*group, "_low", "_high")
    ends = on_groups(values.where(v.isNotNull()), fences, group).groupBy(*group).agg(
        F.min(F.when(within, v)).alias("lower_whisker"), F.max(F.when(within, v)).alias("upper_whisker"),
        F.count_if(~within).alias("n_outliers"))
    return on_groups(box, ends, group, "left")


def outliers(values: DataFrame, box: DataFrame, group: Sequence[str]) -> DataFrame:
    """The rows of ``values`` (with whatever other columns) beyond the
    whiskers."""
    fences = _fences(box).select(*group, "_low", "_high")
    beyond = on_groups(values, fences, group)
    return beyond.where((F.col("value") < F.col("_low")) | (F.col("value") > F.col("_high"))).select(*values.columns)
