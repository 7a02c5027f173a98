"""Projection, filtering, null handling, de-duplication (P1-P19) and the
date / location preparation of the event log (L2, L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from churnkit.functions.columns import first_values
from churnkit.functions.dates import epoch_ms_to_date, epoch_ms_to_timestamp, event_month
from churnkit.functions.location import first_state, state_of
from churnkit.schema import UNUSED_EVENT_COLUMNS


def project_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str] = UNUSED_EVENT_COLUMNS) -> DataFrame:
    """Names match case-insensitively; unknown names are ignored."""
    return df.drop(*cols)


def filter_missing_user(df: DataFrame, key: str = "userId") -> DataFrame:
    """P5: keep events of a real user (``''`` and null ids are dropped).
    A plain comparison, so Catalyst can push it into the scan."""
    return df.filter(F.col(key) != "")


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """P6."""
    return df.filter(F.col(col) == F.lit(value))


def filter_is_null(df: DataFrame, col: str) -> DataFrame:
    """P8."""
    return df.filter(F.col(col).isNull())


def add_event_dates(df: DataFrame, keep_ts: bool = True) -> DataFrame:
    """L2 (F1-F3): event / registration timestamps and dates plus the month.

    ``ts`` (epoch ms) stays by default: with ``event_id`` it orders a user's
    events deterministically ("first" gender / state)."""
    out = df.withColumns({
        "ts_ts": epoch_ms_to_timestamp("ts"),
        "ts_todate": epoch_ms_to_date("ts"),
        "registration_ts": epoch_ms_to_timestamp("registration"),
        "registration_todate": epoch_ms_to_date("registration"),
    })
    out = out.withColumn("month", event_month("ts_todate"))
    drop = ["registration", "ts_ts", "registration_ts"] + ([] if keep_ts else ["ts"])
    return out.drop(*drop)


def add_state(df: DataFrame) -> DataFrame:
    """L3 (F5, F6): ``state`` = text after ``", "``; ``state1`` = its first state."""
    return df.withColumn("state", state_of("location")).withColumn("state1", first_state("state"))


def prepare_events(df: DataFrame) -> DataFrame:
    """P5 -> P2 -> L2 -> L3: the cleaned event table the features are built on."""
    return add_state(add_event_dates(drop_columns(filter_missing_user(df))))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column in ONE pass, as (column, null_count) rows."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, null_count)")


def drop_null_rows(df: DataFrame) -> DataFrame:
    """P12."""
    return df.na.drop(how="any")


def fill_null_zero(df: DataFrame) -> DataFrame:
    """Numeric nulls -> 0; string columns are left as they are."""
    return df.na.fill(0)


def dedup_by_user(df: DataFrame, cols: Sequence[str], key: str = "userId") -> DataFrame:
    """One row per user, the values of its first event by (ts, event_id).

    Aggregates instead of a window: partial results are combined before the
    shuffle, so a hot user is never sorted whole in one task."""
    return first_values(df, key, cols)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """P15."""
    return df.select(col).distinct()


def duplicate_key_check(df: DataFrame, key: str = "userId") -> DataFrame:
    """Rows minus distinct keys (0 when the key is unique)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("duplicate_keys"))


def top_n(df: DataFrame, n: int, *order_cols) -> DataFrame:
    """Ordered top-n; planned as TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition)."""
    return df.orderBy(*order_cols).limit(n)
