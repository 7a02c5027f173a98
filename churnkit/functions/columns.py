"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from churnkit.schema import CHURN_PAGE, LENGTH_DECIMAL


def sanitize_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores, in one projection."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def exact_length(col: str = "length") -> Column:
    """The part of a song length that sums exactly, whatever the order in
    which partial sums are merged: the length as a decimal where it is one
    of at most six decimals and twelve digits before them, else null."""
    exact = F.col(col).try_cast(LENGTH_DECIMAL)
    return F.when(exact.cast("double") == F.col(col), exact)


def other_length(col: str = "length") -> Column:
    """What ``exact_length`` leaves: huge, very fine or NaN lengths, summed
    as doubles, so no length is rounded, left out or fails the job."""
    exact = exact_length(col)
    return F.when(exact.isNull(), F.col(col))


def length_sum(exact: Column, other: Column) -> Column:
    """Total length of summed ``exact_length`` and ``other_length`` values,
    null if there is neither."""
    return F.when(other.isNull(), exact.cast("double")).otherwise(
        F.coalesce(exact.cast("double"), F.lit(0.0)) + other)


def total_length(col: str = "length") -> Column:
    """Aggregate: the total length."""
    return length_sum(F.sum(exact_length(col)), F.sum(other_length(col)))


def is_churn_event(page_col: str = "page") -> Column:
    """1 on the churn marker page, else 0 (null page -> 0)."""
    return F.when(F.col(page_col) == F.lit(CHURN_PAGE), 1).otherwise(0)


def event_order(columns) -> Column:
    """The place of an event among its user's, one DECIMAL(38,0): ts, then
    ``event_id`` where the log (``columns``) has one, else ``itemInSession``.

    A fixed-width decimal keeps ``min`` inside a hash aggregate; a struct or
    string buffer would force a sort-based aggregate over the raw events.
    Value ts * 10^20 + tie: two ties differ by less than 2^64 < 10^20, so a
    later ts always gives a larger value, and at equal ts the tie decides
    (negative ids included); |ts| < 10^17 (epoch ms) keeps the value within
    38 digits. The value is never null: an event without a ts comes last,
    one without a tie counts as 0; events that tie completely are ordered
    by the values taken from them (see ``first_values``)."""
    ties = [c for c in ("event_id", "itemInSession") if c in columns]
    return F.expr(
        "CAST(coalesce(ts, 99999999999999999) AS DECIMAL(20,0)) * CAST(100000000000000000000 AS DECIMAL(21,0))"
        f" + CAST(coalesce({', '.join([*ties, '0'])}) AS DECIMAL(20,0))"
    ).cast("decimal(38,0)")


def first_values(df: DataFrame, key: str, cols, with_label: str | None = None) -> DataFrame:
    """(key, *cols) of each key's earliest event (see ``event_order``).

    Stage 1 is a hash aggregate on (key, *cols) keeping the earliest order
    value; it combines map-side, so a hot key shrinks to one row per value
    combination before the shuffle. Stage 2 picks, per key, the combination
    holding the overall earliest event (small input). ``with_label`` adds
    the key's churn flag under that name from the same pass (no second
    scan, no join)."""
    cols = list(cols)
    extra1 = [F.max(is_churn_event()).alias("_churn")] if with_label else []
    stage1 = df.groupBy(key, *cols).agg(F.min(event_order(df.columns)).alias("_order"), *extra1)
    first = F.min(F.struct(F.col("_order"), *[F.col(c) for c in cols])).alias("_first")
    extra2 = [F.max("_churn").cast("int").alias(with_label)] if with_label else []
    out = stage1.groupBy(key).agg(first, *extra2)
    return out.select(key, *[F.col(f"_first.{c}").alias(c) for c in cols], *([with_label] if with_label else []))
