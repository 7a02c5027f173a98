"""Running sums and row numbers over a whole table, without one task that
sees all of it.

A window without partitions puts every row in one task. Here rows are dealt
into ranges of the order, sorted, and summed within each range; the totals
of the ranges before (one row for each range and group) are carried in. The
ranges are checkpointed first, so that both passes see the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from churnkit.session import reliable_checkpoint

_PART = "_range"


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence, sums: dict[str, str]) -> DataFrame:
    """``df`` with the running sums named by the keys of ``sums``, of the
    columns they map to, over each group in the given order. Rows that tie
    in (group, order) must be one row."""
    dealt = reliable_checkpoint(df.repartitionByRange(*group, *order)).withColumn(_PART, F.spark_partition_id())
    totals = dealt.groupBy(*group, _PART).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # a row for each group and range it reaches into
    carried = totals.select(*[F.col(g).alias(f"_by_{g}") for g in group], F.col(_PART).alias("_from"),
                            *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    within = Window.partitionBy(*group, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.select("*", *[F.sum(c).over(within).alias(n) for n, c in sums.items()])
    meet = local[_PART] == carried["_from"]
    for g in group:
        meet = meet & local[g].eqNullSafe(carried[f"_by_{g}"])
    return local.join(carried, meet).select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def numbered(df: DataFrame, order: Sequence, name: str, first: int = 0) -> DataFrame:
    """``df`` with ``name`` = ``first``, ``first`` + 1, ... in the given
    order (rows that tie completely are numbered in any order)."""
    dealt = reliable_checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place within the range
    dealt = dealt.select("*", F.spark_partition_id().alias(_PART), row.alias("_row"))
    counts = dealt.groupBy(_PART).count().collect()  # one row for each range
    at, carried = first, []
    for part, n in sorted((r[0], r[1]) for r in counts):
        carried.append((part, at))
        at += n
    if not carried:
        return df.withColumn(name, F.lit(None).cast("long"))
    offsets = df.sparkSession.createDataFrame(carried, f"{_PART} int, _first long")
    return dealt.join(F.broadcast(offsets), _PART).select(*df.columns, (F.col("_first") + F.col("_row")).alias(name))
