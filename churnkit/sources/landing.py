"""Landing the JSON event log as Parquet, one partition per event date.

``land_events`` reads the log once with its declared schema and writes the
good rows partitioned by date with dynamic partition overwrite: the dates
of the landed lines are replaced, all others stay as they are. Landing is
thus idempotent, and a date can be landed again from corrected lines.

* Lines that do not fit the schema, rows without a timestamp (they belong
  to no date) and rows of a date that was not announced go to a quarantine
  table, with the reason and the line, under the name of their batch.
* Counts come from ``DataFrame.observe`` in the writing pass. The
  observation stands behind the shuffle, in the writing stage itself, whose
  tasks count once each: a map task that is run again after a lost executor
  does not count its rows twice. A second pass writes the quarantine, and
  only if the first has counted any such line. The observing pass runs in a
  session of its own with the same settings: a session that has observed
  holds an object that cannot be serialised, and fitted models carry their
  session to the executors.
* Rows are dealt to files by ``REBALANCE`` on the date: the planner splits a
  large date into files of the advisory size and joins small ones, instead
  of a file for each task and date. Within a file rows are sorted by user.

A date's lines must be landed together: landing replaces the date. ``days``
names the dates a batch is allowed to replace, so that a stray line cannot
replace a date by itself.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from churnkit.functions.dates import epoch_ms_to_date
from churnkit.schema import EVENT_SCHEMA
from churnkit.sources.io import CORRUPT, read_events_json

EVENT_DATE = "event_date"
UNREADABLE, NO_TIMESTAMP, OTHER_DAY = "unreadable", "no timestamp", "other day"
_REASON, _LINE = "reason", "line"
_BATCH_NAME = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass(frozen=True)
class Landed:
    """What a batch held: lines read, rows landed, lines per reason."""
    lines: int
    rows: int
    unreadable: int
    no_timestamp: int
    other_day: int

    @property
    def quarantined(self) -> int:
        return self.unreadable + self.no_timestamp + self.other_day


def landed_schema(schema: T.StructType = EVENT_SCHEMA) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(EVENT_DATE, T.DateType(), True)])


def _judged(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[dt.date] | None) -> DataFrame:
    """Every line with its date and the reason not to land it (null: none).
    All columns of the schema are read wherever this is used: a line is only
    held against the columns that are."""
    rows = read_events_json(spark, path, schema, keep_bad_lines=True).withColumn(EVENT_DATE, epoch_ms_to_date("ts"))
    reason = F.when(F.col(CORRUPT).isNotNull(), UNREADABLE).when(F.col("ts").isNull(), NO_TIMESTAMP)
    if days is not None:
        reason = reason.when(~F.col(EVENT_DATE).isin(*days) if days else F.lit(True), OTHER_DAY)
    return rows.withColumn(_REASON, reason)


def _observing_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def land_events(spark: SparkSession, path: str, target: str, quarantine: str, batch: str,
                schema: T.StructType = EVENT_SCHEMA, days: Sequence[dt.date] | None = None) -> Landed:
    """Land the JSON lines at ``path`` in the table ``target``; lines that
    cannot be landed replace those of the same ``batch`` in ``quarantine``."""
    if not _BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, '_', '.' and '-': {batch!r}")
    seen = Observation()

    def of(reason):
        return F.count_if(F.col(_REASON) == reason)

    counted = _judged(_observing_session(spark), path, schema, days).hint("rebalance", EVENT_DATE).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(_REASON).isNull()).alias("rows"),
        of(UNREADABLE).alias("unreadable"), of(NO_TIMESTAMP).alias("no_timestamp"), of(OTHER_DAY).alias("other_day"))
    good = counted.where(F.col(_REASON).isNull()).select(*[f.name for f in landed_schema(schema).fields])
    (good.sortWithinPartitions(EVENT_DATE, "userId").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(EVENT_DATE).parquet(target))
    landed = Landed(**seen.get)
    _replace_quarantine(spark, _judged(spark, path, schema, days), schema, quarantine, batch, landed.quarantined)
    return landed


def _replace_quarantine(spark, judged: DataFrame, schema, quarantine: str, batch: str, lines: int) -> None:
    if not lines:  # an empty write would leave the batch's earlier lines
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{quarantine}/batch={batch}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        return
    line = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[f.name for f in schema.fields])))
    (judged.where(F.col(_REASON).isNotNull()).select(F.lit(batch).alias("batch"), _REASON, line.alias(_LINE))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(quarantine))


def read_landed(spark: SparkSession, target: str, first: dt.date | None = None, last: dt.date | None = None,
                schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The landed log, of all dates or from ``first`` to ``last``: other
    dates' files are not opened."""
    rows = spark.read.schema(landed_schema(schema)).parquet(target)
    if first is not None:
        rows = rows.where(F.col(EVENT_DATE) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(EVENT_DATE) <= F.lit(last))
    return rows


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """(batch, reason, line) of the lines that were not landed."""
    return spark.read.schema(f"{_REASON} string, {_LINE} string, batch string").parquet(quarantine).select(
        "batch", _REASON, _LINE)
