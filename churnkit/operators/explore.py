"""Exploration queries over events and users.

All are single aggregates (map-side combined) or aggregates over per-user
rows; user-level "first" values come from ``first_values`` (no window over
a user's events, no driver round trip).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from churnkit.functions.columns import first_values, total_length
from churnkit.functions.dates import days_between
from churnkit.operators.boxplot import SKETCH_K, quartiles
from churnkit.operators.label import churned_users, label_events
from churnkit.schema import CHURN_PAGE


def _mean_length(col="length"):
    return F.try_divide(total_length(col), F.count(col))


def table_dims(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns) of each table; one counting
    aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows",
                     F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_users(events: DataFrame, key: str = "userId") -> DataFrame:
    """A2: distinct users and distinct churners, in one pass."""
    return events.agg(
        F.count_distinct(key).alias("n_users"),
        F.count_distinct(F.when(F.col("page") == CHURN_PAGE, F.col(key))).alias("n_churners"),
    )


def missing_user_profile(raw_events: DataFrame) -> DataFrame:
    """A3: events without a user id, by ``auth``."""
    return (raw_events.filter(F.col("userId") == "")
            .groupBy("auth").agg(F.count(F.lit(1)).alias("n_events")))


def visits_per_page(events: DataFrame) -> DataFrame:
    """A4."""
    return events.groupBy("page").agg(F.count(F.lit(1)).alias("visits")).orderBy("page")


def users_per(events: DataFrame, col: str, key: str = "userId") -> DataFrame:
    """Distinct users per value of ``col``."""
    return events.groupBy(col).agg(F.count_distinct(key).alias("n_users"))


def date_range(events: DataFrame, date_col: str = "ts_todate") -> DataFrame:
    """A7."""
    return events.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def count_nonnull_by_group(events: DataFrame, col: str) -> DataFrame:
    """``count(col)`` per value of ``col`` (the null group counts 0)."""
    return events.groupBy(col).agg(F.count(col).alias("n_nonnull"), F.count(F.lit(1)).alias("n_rows"))


def label_distribution(events: DataFrame, key: str = "userId") -> DataFrame:
    """Events per label. Aggregate first (events and label per user, one
    pass), then add up per label: no event-level join."""
    per_user = per_user_with_label(events, [F.count(F.lit(1)).alias("n")], key)
    return per_user.groupBy("churn_lab").agg(F.sum("n").alias("n_events"))


def churn_rate(labels: DataFrame) -> DataFrame:
    """Users, churners and churners as % of users."""
    return labels.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum("churn_label").cast("bigint").alias("n_churners"),
        F.try_divide(F.sum("churn_label").cast("double") * F.lit(100.0), F.count(F.lit(1)))
        .alias("churn_rate_pct"),
    )


def per_user_with_label(events: DataFrame, aggs: Sequence, key: str = "userId") -> DataFrame:
    """Per-user aggregates plus the user's churn label in the same aggregate."""
    return events.groupBy(key).agg(
        *aggs, F.max(F.when(F.col("page") == CHURN_PAGE, 1).otherwise(0)).cast("int").alias("churn_lab"))


def events_per_user(events: DataFrame) -> DataFrame:
    """Events per user (the source calls them sessions)."""
    return per_user_with_label(events, [F.count(F.lit(1)).alias("n_events")])


def artist_plays_by_label(events: DataFrame, key: str = "userId", churned: DataFrame | None = None) -> DataFrame:
    """Plays per (artist, label); the null artist (non-song events) is a
    group. Events are reduced to (user, artist) counts, which are joined to
    the churners as events are in ``label_events``: neither side of the join
    is partitioned on the user beforehand, so a user with a large catalogue
    is split among tasks. Counts are then added up per (artist, label). The
    second scan keeps the marker rows and two columns. Where ``events`` are a
    part of the log, ``churned`` names the churners."""
    churned = churned_users(events, key) if churned is None else churned
    plays = events.groupBy(key, "artist").agg(F.count(F.lit(1)).alias("n"))
    return label_events(plays, key, churned).groupBy("artist", "churn_lab").agg(
        F.sum("n").alias("plays"))


def distinct_per_user(events: DataFrame, col: str, alias: str) -> DataFrame:
    """Distinct values of ``col`` per user, with label."""
    return per_user_with_label(events, [F.count_distinct(col).alias(alias)])


def users_by_first(events: DataFrame, cols: Sequence[str], with_label: bool = True,
                   key: str = "userId") -> DataFrame:
    """Users counted by the value(s) of their first
    event (and label)."""
    firsts = first_values(events, key, cols, with_label="churn_lab" if with_label else None)
    group = [*cols, "churn_lab"] if with_label else list(cols)
    return firsts.groupBy(*group).agg(F.count(F.lit(1)).alias("user_count"))


def listening_per_user(events: DataFrame) -> DataFrame:
    """Total and mean song length per user (null when no song)."""
    return per_user_with_label(events, [
        total_length().alias("total_session_length"),
        _mean_length().alias("avg_session_length"),
    ])


def page_visits_per_user(events: DataFrame) -> DataFrame:
    """Visits per (user, page), with the user's label."""
    visits = events.groupBy("userId", "page").agg(F.count(F.lit(1)).alias("visits"))
    # label from the reduced rows (at most one per page and user): one scan,
    # and the per-user window holds at most #pages rows
    churned = F.max((F.col("page") == CHURN_PAGE).cast("int")).over(Window.partitionBy("userId"))
    return visits.withColumn("churn_lab", churned)


def mean_visits_by_page_label(page_visits: DataFrame) -> DataFrame:
    """Mean visits per user by (page, label) (the bar chart's numbers)."""
    return page_visits.groupBy("page", "churn_lab").agg(
        F.try_divide(F.sum("visits").cast("double"), F.count("visits")).alias("mean_visits"),
        F.count(F.lit(1)).alias("n_users"))


def items_per_user(events: DataFrame) -> DataFrame:
    """A24."""
    return per_user_with_label(events, [F.sum("itemInSession").alias("total_items")])


def days_since_registration(events: DataFrame, key: str = "userId") -> DataFrame:
    """Days from registration to the user's first event, with label."""
    with_days = events.withColumn(
        "NumDaysSinceRegistration", days_between("ts_todate", "registration_todate"))
    return first_values(with_days, key, ["NumDaysSinceRegistration"], with_label="churn_lab")


def metric_values(users: DataFrame, metrics: Sequence[str], label: str = "churn_label",
                  keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, label, metric, value): the users' metrics, one row each."""
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return users.selectExpr(*[f"`{c}`" for c in (*keep, label)], f"stack({len(metrics)}, {pairs}) AS (metric, value)")


def metric_summary_by_label(users: DataFrame, metrics: Sequence[str], label: str = "churn_label",
                            accuracy: int = SKETCH_K) -> DataFrame:
    """Five-number summary (min, quartiles, max) of per-user metrics by
    label, the numbers behind the box plots. Quartiles are exact: the value
    at rank max(1, ceil(p * n)) of the group's non-null values (see
    ``boxplot``), whatever the sketch's ``accuracy`` (its size, 8 at least)."""
    found = quartiles(metric_values(users, metrics, label), ["metric", label], k=max(accuracy, 8))
    return found.select("metric", label, "n", "min_value", "q1", "median", "q3", "max_value")
