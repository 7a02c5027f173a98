"""Join helpers (J1, J2) with size-checked broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest side (rows) that may be shipped to every executor.
DEFAULT_BROADCAST_ROWS = 200_000


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. A larger side is returned
    unchanged, so the join falls back to a shuffle join (with AQE's runtime
    size check and skew splitting).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def join_user_aggregates(*tables: DataFrame, key: str = "userId") -> DataFrame:
    """Inner equi-join of per-user tables on ``key``.

    Every input has one row per user, so no join multiplies rows. When the
    inputs are aggregates hash-partitioned on the key, the sort-merge join
    reuses that partitioning (no extra exchange)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, on=key, how="inner")
    return out


def semi_join(events: DataFrame, ids: DataFrame, key: str = "userId", anti: bool = False,
              max_broadcast_rows: int | None = None) -> DataFrame:
    """Keep events whose ``key`` is (or, with ``anti``, is not) in ``ids``.

    Replaces "collect the ids to the driver, then ``isin``": the id set stays
    distributed. By default AQE decides at run time from the materialised
    size of ``ids`` (broadcast under its threshold, else a shuffle join with
    skew splitting). ``max_broadcast_rows`` forces an up-front row-count
    check instead (worth it only when ``ids`` is cheap to count).

    ``ids`` is used as given: duplicates do not change a semi / anti join,
    and re-de-duplicating on ``key`` here would leave that side partitioned
    on the key, which turns off AQE's skew split (see
    ``label.churned_users``)."""
    ids = ids.select(key)
    if max_broadcast_rows is not None:
        ids = sized_broadcast(ids, max_broadcast_rows)
    return events.join(ids, on=key, how="left_anti" if anti else "left_semi")
