"""The event log laid out by user, so that joins on the user need no shuffle
of events (L1, J2).

``lay_out`` writes the log once as a bucketed, sorted Parquet table. Every
later join on the user then reads the buckets as they lie: only the other
side, an id set with a row per user, is exchanged to meet them.

A bucket is one task, so a user with a third of all events must not lie in
one bucket. Users of more than ``heavy`` events are cut into parts of about
that many by a hash of the whole event, and the buckets hash (user, part).
The number of parts of each such user is kept beside the table (at most
events / ``heavy`` rows); an id set is repeated for its users' parts before
it meets the events. Events that agree in every column share a part.

The table's definition (buckets, schema) lies with the data, so ``open_layout``
registers it in any session that can read the folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from churnkit.operators.joins import sized_broadcast
from churnkit.schema import CHURN_PAGE

HEAVY_EVENTS = 1_000_000
PART = "user_part"


class Layout:
    """The laid-out ``events`` (with the column ``user_part``) and ``parts``
    (user, parts) of the heavy users."""

    def __init__(self, events: DataFrame, parts: DataFrame, key: str, buckets: int):
        self.events, self.parts, self.key, self.buckets = events, parts, key, buckets


def heavy_users(events: DataFrame, heavy: int, key: str = "userId") -> DataFrame:
    """(user, parts) of the users with more than ``heavy`` events."""
    return (events.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy)
            .select(key, F.ceil(F.col("n") / heavy).cast("int").alias("parts")))


def lay_out(events: DataFrame, path: str, buckets: int | None = None, heavy: int = HEAVY_EVENTS,
            key: str = "userId") -> Layout:
    """Write ``events`` to the folder ``path``, which must be new."""
    spark = events.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy_users(events, heavy, key).write.parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts").withColumnRenamed(key, "_user")
    parts = sized_broadcast(parts)
    # the whole event is hashed: the same on every run, whatever the partitioning
    part = F.when(F.col("parts").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*events.columns), F.col("parts"))).cast("int")
    cut = (events.join(parts, events[key].eqNullSafe(parts["_user"]), "left")
           .select(*events.columns, part.alias(PART)))
    definition = json.dumps({"key": key, "buckets": buckets, "schema": json.loads(cut.schema.json())})
    # each task writes one bucket, as one file
    (cut.repartition(buckets, key, PART).write.format("parquet").bucketBy(buckets, key, PART).sortBy(key, PART)
     .option("path", f"{path}/events").saveAsTable(f"churnkit_layout_{uuid.uuid4().hex[:12]}"))
    spark.createDataFrame([(definition,)], "definition string").coalesce(1).write.text(f"{path}/definition")
    return open_layout(spark, path)


def open_layout(spark: SparkSession, path: str) -> Layout:
    """A layout written before, by this or another session."""
    definition = json.loads(spark.read.text(f"{path}/definition").first()[0])
    key, buckets = definition["key"], definition["buckets"]
    schema = T.StructType.fromJson(definition["schema"])
    name = f"churnkit_layout_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`, {PART}) "
              f"SORTED BY (`{key}`, {PART}) INTO {buckets} BUCKETS LOCATION '{path}/events'")
    return Layout(spark.table(name), spark.read.parquet(f"{path}/parts"), key, buckets)


def spread(ids: DataFrame, layout: Layout) -> DataFrame:
    """``ids`` (one row per user) repeated for each part of its user."""
    parts = F.coalesce(F.col("parts"), F.lit(1))
    return (ids.join(layout.parts, layout.key, "left")
            .withColumn(PART, F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"))


def churned_ids(layout: Layout) -> DataFrame:
    """The users with a churn marker, one row for each of their parts."""
    marked = layout.events.where(F.col("page") == CHURN_PAGE).select(layout.key).distinct()
    return spread(marked, layout)


def label_laid_out(layout: Layout) -> DataFrame:
    """L1: ``churn_lab`` on every event of its user."""
    flags = churned_ids(layout).withColumn("_churned", F.lit(1))
    return (layout.events.join(flags, [layout.key, PART], "left")
            .withColumn("churn_lab", F.coalesce("_churned", F.lit(0))).drop("_churned", PART))


def churned_events(layout: Layout, anti: bool = False) -> DataFrame:
    """Events of users who churned (with ``anti``, who did not)."""
    how = "left_anti" if anti else "left_semi"
    return layout.events.join(churned_ids(layout), [layout.key, PART], how).drop(PART)
