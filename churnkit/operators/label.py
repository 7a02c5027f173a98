"""Churn labelling (L1) and the churner semi/anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from churnkit.functions.columns import is_churn_event
from churnkit.operators.joins import semi_join
from churnkit.schema import CHURN_PAGE


def churned_users(events: DataFrame, key: str = "userId") -> DataFrame:
    """Distinct ids of users with a churn-marker event.

    De-duplicated on (user, page) over the marker rows: the same rows as the
    distinct users, since the filter fixes the page. The result is then
    hash-partitioned on the pair, not on the user alone, so a join on the
    user gives this side a shuffle of its own. AQE's skew-join split needs a
    shuffle stage under both join inputs; were this side already partitioned
    on the user, the planner would skip its exchange and the events of a hot
    user on the other side would stay whole in one task."""
    return events.filter(F.col("page") == CHURN_PAGE).select(key, "page").distinct().select(key)


def user_labels(events: DataFrame, key: str = "userId") -> DataFrame:
    """One row per user: ``churn_label`` 1 if any event is the marker, else 0.
    Map-side ``max`` per user, so skewed users are pre-reduced."""
    return events.groupBy(key).agg(F.max(is_churn_event()).cast("int").alias("churn_label"))


def label_events(events: DataFrame, key: str = "userId", churned: DataFrame | None = None) -> DataFrame:
    """L1: ``churn_lab`` on every event of its user (or on rows derived from
    events, given the ``churned`` users).

    The churner set is computed distributed and joined back (no driver
    round trip, no id list in the plan). Its size is only known at run
    time: AQE broadcasts it when the materialised side is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise the join
    stays a shuffle join whose skewed (hot-user) partitions AQE splits."""
    flags = (churned_users(events, key) if churned is None else churned).withColumn("_churned", F.lit(1))
    out = events.join(flags, on=key, how="left")
    return out.withColumn("churn_lab", F.coalesce(F.col("_churned"), F.lit(0))).drop("_churned")


def churned_user_events(events: DataFrame, key: str = "userId") -> DataFrame:
    """J2 (semi): events of users who churned."""
    return semi_join(events, churned_users(events, key), key)


def retained_user_events(events: DataFrame, key: str = "userId") -> DataFrame:
    """J2 (anti): events of users who did not churn."""
    return semi_join(events, churned_users(events, key), key, anti=True)
