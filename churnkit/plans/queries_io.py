"""Registered source / sink round trips and catalog queries.

Round trips write into a fresh folder under the shared checkpoint
directory (``spark.checkpoint.dir``) and read back with declared schemas.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnkit.operators import clean, features
from churnkit.operators.incremental import FeatureStore
from churnkit.plans import oracle as O
from churnkit.plans.registry import events, register, user_table
from churnkit.schema import EVENT_SCHEMA, LOG_SCHEMA
from churnkit.session import scratch_path, table_path
from churnkit.sources import io, landing, layout

W = O.with_ctes
EVENT_COLS = ", ".join(f.name for f in EVENT_SCHEMA.fields)


@register("scan_json", W(f"SELECT {EVENT_COLS} FROM event_log", "event_log"))
def q_scan_json(spark, sf_dir):
    path = scratch_path(spark, "events-json")
    io.write_json(events(spark, sf_dir), path)
    return io.read_events_json(spark, path)


@register("scan_parquet", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'view'")
def q_scan_parquet(spark, sf_dir):
    """The given table as it stands; columns and filter reach the scan."""
    raw = io.read_parquet(spark, table_path(sf_dir, "events"))
    return raw.where("event_type = 'view'").select("event_id", "user_id", "event_type", "value")


@register("parquet_roundtrip", W(f"SELECT {EVENT_COLS} FROM event_log", "event_log"))
def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "events-parquet")
    io.write_parquet(events(spark, sf_dir), path)
    return io.read_parquet(spark, path)


@register("feature_json_roundtrip", W("SELECT * FROM features", "features"))
def q_feature_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "features-json")
    io.write_json(user_table(spark, sf_dir), path)
    return io.read_features_json(spark, path, O.TEST_PAGES)


_RAW_COLUMNS = ", ".join(f"r.{c}" if c in ("gender", "state") else f"f.{c}" for c in O.TEST_FEATURE_COLUMNS)


@register("features_from_raw_log", W(
    f"SELECT {_RAW_COLUMNS} FROM features f JOIN raw_firsts r ON f.userId = r.userId", "features",
    extra="raw_firsts AS (SELECT userId, gender, state1 AS state FROM (SELECT userId, gender, state1, row_number() OVER ("
          "PARTITION BY userId ORDER BY ts, coalesce(itemInSession, 0), gender NULLS FIRST, state1 NULLS FIRST) AS rn "
          "FROM prepared) WHERE rn = 1)"))
def q_features_from_raw_log(spark, sf_dir):
    """L9 on the log as the service writes it: JSON lines, no event id."""
    path = scratch_path(spark, "raw-log")
    io.write_json(events(spark, sf_dir).drop("event_id"), path)
    return features.user_features(clean.prepare_events(io.read_events_json(spark, path, LOG_SCHEMA)))


@register("scan_csv", W("SELECT * FROM features", "features"))
def q_scan_csv(spark, sf_dir):
    path = scratch_path(spark, "features-csv")
    io.write_csv(user_table(spark, sf_dir), path)
    return io.read_features_csv(spark, path, O.TEST_PAGES)


@register("preview_topn", W(
    "SELECT userId, event_id, ts, page FROM prepared ORDER BY ts, event_id LIMIT 10", "prepared"))
def q_preview_topn(spark, sf_dir):
    ev = clean.prepare_events(events(spark, sf_dir)).select("userId", "event_id", "ts", "page")
    return io.preview(ev, 10, "ts", "event_id")


_TYPES = {f.name: f.dataType.simpleString() for f in io.feature_schema(O.TEST_PAGES).fields}


@register("describe_schema", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM features"
    for c, t in _TYPES.items()), "features"))
def q_describe_schema(spark, sf_dir):
    return io.describe_schema(user_table(spark, sf_dir))


@register("sql_view_query", W(
    "SELECT page, count(*) AS visits, count(DISTINCT userId) AS n_users FROM prepared GROUP BY page",
    "prepared"))
def q_sql_view_query(spark, sf_dir):
    """S11 + the SQL path: register a temp view, query it with Spark SQL."""
    clean.prepare_events(events(spark, sf_dir)).createOrReplaceTempView("churnkit_events")
    return spark.sql("SELECT page, count(*) AS visits, count(DISTINCT userId) AS n_users "
                     "FROM churnkit_events GROUP BY page")


# ---------------------------------------------------------------------------
# The log landed as date-partitioned Parquet, and what builds on it
# ---------------------------------------------------------------------------

def _log_lines(events, bad: bool):
    """The log as JSON lines; with ``bad`` some lines that cannot be landed
    are added, one for every event of a few ids."""
    lines = events.select(F.to_json(F.struct(*events.columns)).alias("value"))
    if not bad:
        return lines
    for rest, end in ((7, ""), (9, ',"ts":"later"}'), (11, ',"userId":"u"}')):
        some = events.where(F.col("event_id") % 50 == rest)
        lines = lines.union(some.select(F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(end))))
    return lines


def _landed(spark, sf_dir, bad=True):
    """Land the test log; (table, quarantine, counts)."""
    base = scratch_path(spark, "landing")
    _log_lines(events(spark, sf_dir), bad).write.text(f"{base}/lines")
    counts = landing.land_events(spark, f"{base}/lines", f"{base}/events", f"{base}/bad", "first")
    return f"{base}/events", f"{base}/bad", counts


_DATE = "CAST(make_timestamp(CAST(ts AS BIGINT) * 1000) AS DATE)"


@register("land_events", W(f"SELECT {EVENT_COLS}, {_DATE} AS event_date FROM event_log", "event_log"))
def q_land_events(spark, sf_dir):
    """S1 -> S4: the JSON log with planted bad lines as Parquet by date."""
    return landing.read_landed(spark, _landed(spark, sf_dir)[0])


_BAD_SQL = " UNION ALL ".join(
    f"SELECT 'first' AS batch, '{reason}' AS reason, '{{\"event_id\":' || event_id || '{end}' AS line FROM event_log "
    f"WHERE event_id % 50 = {rest}" for reason, rest, end in (
        ("unreadable", 7, ""), ("unreadable", 9, ',"ts":"later"}'), ("no timestamp", 11, ',"userId":"u"}')))


@register("land_quarantine", W(_BAD_SQL, "event_log"))
def q_land_quarantine(spark, sf_dir):
    return landing.read_quarantine(spark, _landed(spark, sf_dir)[1])


@register("land_counts", W(
    "SELECT count(*) + count(*) FILTER (event_id % 50 IN (7, 9, 11)) AS lines, count(*) AS rows, "
    "count(*) FILTER (event_id % 50 IN (7, 9)) AS unreadable, count(*) FILTER (event_id % 50 = 11) AS no_timestamp, "
    "CAST(0 AS BIGINT) AS other_day FROM event_log", "event_log"))
def q_land_counts(spark, sf_dir):
    """The counts observed while the log was written."""
    c = _landed(spark, sf_dir)[2]
    return spark.createDataFrame([(c.lines, c.rows, c.unreadable, c.no_timestamp, c.other_day)],
                                 "lines long, rows long, unreadable long, no_timestamp long, other_day long")


@register("incremental_features", W("SELECT * FROM features", "features"))
def q_incremental_features(spark, sf_dir):
    """L8 / L9 from three loads of the landed log, one of them loaded again
    after a compaction."""
    log = landing.read_landed(spark, _landed(spark, sf_dir, bad=False)[0])
    first, last = log.agg(F.min("event_date"), F.max("event_date")).first()
    third = (last - first) / 3
    starts = [first, first + third, first + 2 * third, last + dt.timedelta(days=1)]
    store = FeatureStore(spark, scratch_path(spark, "feature-store"))
    ranges = [(a, b - dt.timedelta(days=1)) for a, b in zip(starts, starts[1:])]
    for i, (a, b) in enumerate(ranges[:2]):
        store.load(log, f"load-{i}", a, b)
    store.compact()
    store.load(log, "load-2", *ranges[2])
    store.load(log, "load-1", *ranges[1])
    return store.features()


def _laid_out(spark, sf_dir):
    """The cleaned log laid out by user, a user of more than 200 events in
    parts."""
    log = clean.filter_missing_user(events(spark, sf_dir))
    return layout.lay_out(log, scratch_path(spark, "layout"), heavy=200)


@register("label_events_laid_out", W("SELECT userId, event_id, page, churn_lab FROM labelled", "labelled"))
def q_label_events_laid_out(spark, sf_dir):
    return layout.label_laid_out(_laid_out(spark, sf_dir)).select("userId", "event_id", "page", "churn_lab")


@register("churned_events_laid_out", W(
    "SELECT userId, event_id, page FROM labelled WHERE churn_lab = 1", "labelled"))
def q_churned_events_laid_out(spark, sf_dir):
    return layout.churned_events(_laid_out(spark, sf_dir)).select("userId", "event_id", "page")


@register("retained_events_laid_out", W(
    "SELECT userId, event_id, page FROM labelled WHERE churn_lab = 0", "labelled"))
def q_retained_events_laid_out(spark, sf_dir):
    return layout.churned_events(_laid_out(spark, sf_dir), anti=True).select("userId", "event_id", "page")


# ---------------------------------------------------------------------------
# Streaming: the events table read as a file stream
# ---------------------------------------------------------------------------

_STREAM_SQL = W(
    "SELECT userId, count(*) AS n_events, count(length) AS n_songs, "
    f"CAST(sum({O.LEN}) AS DOUBLE) AS total_session_length, "
    "CAST(sum(itemInSession) AS BIGINT) AS total_items, "
    "CAST(max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS INTEGER) AS churn_label, "
    "min(ts) AS first_ts, max(ts) AS last_ts, "
    + O.PAGE_COUNTS + ", CAST(0 AS BIGINT) AS other_pages FROM event_log WHERE userId <> '' GROUP BY userId",
    "event_log")


@register("streaming_user_activity", _STREAM_SQL)
def q_streaming_user_activity(spark, sf_dir):
    from churnkit.sources.adapter import event_log_from
    from churnkit.streaming import activity
    raw = activity.read_events_stream(spark, table_path(sf_dir, "events"))
    stream = event_log_from(spark, sf_dir, raw)
    changelog, ckpt = scratch_path(spark, "activity-log"), scratch_path(spark, "activity-ckpt")
    query = activity.start_activity_stream(stream, changelog, ckpt, pages=O.TEST_PAGES)
    query.awaitTermination()
    return activity.latest_activity(spark, changelog, pages=O.TEST_PAGES)
