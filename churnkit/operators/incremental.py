"""The feature table kept up to date load by load.

The batch job reads the whole log. Here every load reads only its own dates
and leaves per-user partial aggregates that can be merged with those of
other loads; the feature table is computed from the partials alone:

* ``days``: per user and month, the exact sums and three 31-bit sets of the
  month's days (all, with a song length, with an item number). Sets are
  merged by OR, so averages per day and month are exact.
* ``visits``: per user, gender, state and page, the count and the order of
  the first event.
* ``sets``: the user's distinct artists and songs as bitmaps over ids of a
  dictionary (``bitmap_construct_agg``; merged by ``bitmap_or_agg``), so
  distinct counts are exact, not estimated. The dictionary gives new
  values the next ids; it only grows.

A load is named and covers a range of dates; loading a name again replaces
it. Every load writes folders of a version of its own and then one line in
the store's log; readers follow the log. A load that dies leaves no trace
in the results, and nothing that is read is overwritten. ``compact`` merges
the current loads into a base of one row per key; loads replaced after that
make the base stale, and readers go back to the single loads. One writer
at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnkit.operators import clean, features
from churnkit.operators.ranks import numbered
from churnkit.session import reliable_checkpoint
from churnkit.sources.landing import EVENT_DATE

TABLES = {
    "days": "userId string, month date, days int, days_len int, days_items int, len_sum decimal(38,6), "
            "len_other double, len_cnt long, items_sum long, items_cnt long, n_events long",
    "visits": "userId string, gender string, state1 string, page string, n_events long, first_order decimal(38,0)",
    "sets": "userId string, kind string, bucket long, bits binary",
}
_LOG = "seq long, kind string, name string, version string, first_day date, last_day date, holds array<string>"
_DICTIONARY = "value string, id long"
_KINDS = ("artist", "song")
_SUMS = ("len_sum", "len_other", "len_cnt", "items_sum", "items_cnt", "n_events")
_DAY_SETS = ("days", "days_len", "days_items")


class FeatureStore:
    """Partial aggregates in the folder ``path`` on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # what the store holds ------------------------------------------------
    def _exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def log(self) -> list:
        """The log's lines in order (a line for each load or base)."""
        if not self._exists("log"):
            return []
        return self.spark.read.schema(_LOG).parquet(f"{self.path}/log").orderBy("seq").collect()

    def loads(self) -> dict[str, object]:
        """The current line of each load."""
        return {line.name: line for line in self.log() if line.kind == "load"}

    def versions(self) -> list[str]:
        """The versions to read: the newest base that holds no replaced load,
        and the loads that it does not hold."""
        current = [line.version for line in self.loads().values()]
        for line in reversed(self.log()):
            if line.kind == "base" and set(line.holds) <= set(current):
                return [line.version, *(v for v in current if v not in line.holds)]
        return current

    def _append(self, kind: str, name: str, version: str, first=None, last=None, holds=()) -> None:
        line = (len(self.log()), kind, name, version, first, last, list(holds))
        self.spark.createDataFrame([line], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def read(self, table: str, versions: list[str] | None = None) -> DataFrame:
        """The partials of the given versions (by default the current)."""
        versions = self.versions() if versions is None else versions
        if not versions:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(*[f"{self.path}/{table}/{v}" for v in versions])

    def _write(self, table: str, version: str, rows: DataFrame) -> None:
        rows.select(*[c.split()[0] for c in TABLES[table].split(", ")]).write.parquet(f"{self.path}/{table}/{version}")

    def dictionary(self, kind: str) -> DataFrame:
        if not self._exists(f"dictionary/{kind}"):
            return self.spark.createDataFrame([], _DICTIONARY)
        return self.spark.read.schema(_DICTIONARY).parquet(f"{self.path}/dictionary/{kind}")

    # loading -------------------------------------------------------------
    def load(self, landed: DataFrame, name: str, first: dt.date, last: dt.date) -> str:
        """Aggregate the dates ``first`` to ``last`` of the landed log under
        ``name``. Only these dates' partitions are read, and only the
        users that are active in them get new rows."""
        for other in self.loads().values():
            if other.name != name and first <= other.last_day and other.first_day <= last:
                raise ValueError(f"load {other.name} covers {other.first_day} to {other.last_day} already")
        version = f"{name}-{uuid.uuid4().hex[:12]}"
        grains = reliable_checkpoint(features.event_grains(self.rows_of(landed, first, last)))
        gid = F.col("_gid")
        self._write("days", version, _merged_days(_day_rows(grains.where(gid == features.GID["day"]))))
        visits = grains.where(gid == features.GID["profile"]).select("userId", "gender", "state1", "page", "n_events",
                                                                     "first_order")
        self._write("visits", version, visits)
        sets = None
        for kind in _KINDS:
            pairs = grains.where((gid == features.GID[kind]) & F.col(kind).isNotNull()).select(
                "userId", F.col(kind).alias("value"))
            self._learn(kind, pairs)
            bits = _bitmaps(pairs.join(self.dictionary(kind), "value"), kind)
            sets = bits if sets is None else sets.union(bits)
        self._write("sets", version, sets)
        self._append("load", name, version, first, last)
        return version

    @staticmethod
    def rows_of(landed: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        """The prepared events of a range of dates."""
        return clean.prepare_events(landed.where(F.col(EVENT_DATE).between(F.lit(first), F.lit(last))))

    def _learn(self, kind: str, pairs: DataFrame) -> None:
        """Give the next ids to values that the dictionary lacks."""
        known = self.dictionary(kind)
        new = pairs.select("value").distinct().join(known, "value", "left_anti")
        last = known.agg(F.max("id")).first()[0] or 0
        numbered(new, ["value"], "id", last + 1).write.mode("append").parquet(f"{self.path}/dictionary/{kind}")

    def compact(self) -> str | None:
        """Merge the current loads into a base."""
        holds = [line.version for line in self.loads().values()]
        if not holds:
            return None
        version, parts = f"base-{uuid.uuid4().hex[:12]}", self.versions()
        self._write("days", version, _merged_days(self.read("days", parts)))
        self._write("visits", version, _merged_visits(self.read("visits", parts)))
        self._write("sets", version, _merged_sets(self.read("sets", parts)))
        self._append("base", version, version, holds=holds)
        return version

    # features ------------------------------------------------------------
    def features(self, pages=None, users: DataFrame | None = None) -> DataFrame:
        """The feature table from the partials, or the rows of ``users``
        (userId). Pages that are not named are found in ``visits``."""
        days, visits, sets = (self.read(t) for t in TABLES)
        if users is not None:
            days, visits, sets = (t.join(users.select("userId").distinct(), "userId", "left_semi")
                                  for t in (days, visits, sets))
        pages = features.pages_of(visits) if pages is None else tuple(pages)
        columns = {p: features.page_column(p) for p in dict.fromkeys((*pages, features.CHURN_PAGE))}

        def month_if(days_set):
            return F.when(F.col(days_set) != 0, F.expr("shiftleft(1, month(month))"))

        zero = F.lit(0).cast("long")
        by_month = _merged_days(days).select(
            "userId", *_SUMS, *[F.bit_count(c).cast("long").alias(c.replace("days", "n_days")) for c in _DAY_SETS],
            *[month_if(c).alias(c.replace("days", "months")) for c in _DAY_SETS],
            zero.alias("unique_artist_count"), zero.alias("unique_song_count"))
        profiles = _merged_visits(visits).groupBy("userId", "gender", "state1").agg(
            F.min("first_order").alias("first_order"),
            *[F.sum(F.when(F.col("page") == p, F.col("n_events"))).alias(c) for p, c in columns.items()])
        counts = _merged_sets(sets).groupBy("userId").agg(
            *[F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits"))).alias(f"unique_{k}_count") for k in _KINDS])
        part = by_month.unionByName(profiles, True).unionByName(counts, True)
        return features.features_from_rollup(part, pages)

    def features_of_load(self, name: str, pages=None) -> DataFrame:
        """The feature rows that a load has changed: those of its users."""
        users = self.read("days", [self.loads()[name].version])
        return self.features(pages, users)


def _day_rows(grains: DataFrame) -> DataFrame:
    """A row per user and day, the day as a set of one."""
    bit = F.expr("shiftleft(1, dayofmonth(ts_todate) - 1)")
    return grains.select(
        "userId", F.trunc("ts_todate", "month").alias("month"), bit.alias("days"),
        F.when(F.col("len_cnt") > 0, bit).otherwise(0).alias("days_len"),
        F.when(F.col("items_sum").isNotNull(), bit).otherwise(0).alias("days_items"), *_SUMS)


def _merged_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("userId", "month").agg(
        *[F.bit_or(c).alias(c) for c in _DAY_SETS],
        *[F.sum(c).cast("decimal(38,6)" if c == "len_sum" else "double" if c == "len_other" else "long").alias(c)
          for c in _SUMS])


def _merged_visits(rows: DataFrame) -> DataFrame:
    return rows.groupBy("userId", "gender", "state1", "page").agg(
        F.sum("n_events").alias("n_events"), F.min("first_order").alias("first_order"))


def _bitmaps(pairs: DataFrame, kind: str) -> DataFrame:
    """Bitmaps of (userId, id) pairs that are distinct."""
    return pairs.groupBy("userId", F.lit(kind).alias("kind"), F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def _merged_sets(rows: DataFrame) -> DataFrame:
    return rows.groupBy("userId", "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
