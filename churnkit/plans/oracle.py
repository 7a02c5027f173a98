"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

Each statement is written in the plain shape of the source workflow
(aggregate per table, then join), independent of the Spark plan, and uses
exact arithmetic where Spark does: song lengths are summed as
DECIMAL(18,6) and averages divide the exact total by a count.
"""

from __future__ import annotations

from churnkit.schema import PAGES, feature_columns, page_column
from churnkit.sources.adapter import EXTRA_PAGES, PAGES_BY_TYPE

# The pages of the test tables' event log, and the feature columns they make.
TEST_PAGES = (*PAGES, *EXTRA_PAGES)
TEST_PAGE_COLUMNS = tuple(page_column(p) for p in TEST_PAGES)
TEST_FEATURE_COLUMNS = feature_columns(TEST_PAGES)

PLAYS = "e.event_type = 'view' AND c.c_custkey % 31 <> 0"
PAGE_CASES = "\n         ".join(
    f"WHEN e.event_type = '{kind}' THEN [" + ", ".join(f"'{p}'" for p in pages)
    + f"][CAST(e.event_id % {len(pages)} AS INTEGER) + 1]" for kind, pages in PAGES_BY_TYPE.items())

EVENT_LOG = f"""
event_log AS (
  SELECT
    e.event_id AS event_id,
    CASE WHEN {PLAYS}
         THEN 'artist_' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 20 AS VARCHAR) END AS artist,
    CASE WHEN e.event_id % 37 = 0 THEN 'Guest'
         WHEN e.event_type = 'error' AND e.value > 200 THEN 'Cancelled'
         ELSE 'Logged In' END AS auth,
    c.c_name AS firstName,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS itemInSession,
    n.n_name AS lastName,
    CASE WHEN {PLAYS} THEN e.value END AS length,
    CASE WHEN c.c_acctbal > 4500 THEN 'paid' ELSE 'free' END AS level,
    CASE WHEN c.c_custkey % 29 = 0 THEN n.n_name
         ELSE n.n_name || ', ' || substr(r.r_name, 1, 2) || '-' || substr(n.n_name, 1, 2) END AS location,
    CASE WHEN e.event_type IN ('view', 'signup') THEN 'GET' ELSE 'PUT' END AS method,
    CASE WHEN e.event_type = 'error' AND e.value > 200 THEN 'Cancellation Confirmation'
         WHEN e.event_type = 'error' THEN 'Error'
         WHEN {PLAYS} THEN 'NextSong'
         {PAGE_CASES}
         ELSE 'Home' END AS page,
    CAST(1672531200000 + (c.c_custkey % 365) * 86400000 AS BIGINT) AS registration,
    CAST(e.user_id * 100 + day(e.ts) AS BIGINT) AS sessionId,
    CASE WHEN {PLAYS}
         THEN 'song_' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS VARCHAR) END AS song,
    CAST(CASE WHEN e.event_id % 37 = 0 THEN NULL
              WHEN e.event_type = 'error' AND e.value <= 200 THEN 404
              ELSE 200 END AS BIGINT) AS status,
    CAST(epoch_us(e.ts) // 1000 + (e.event_id % 3) * 2678400000 AS BIGINT) AS ts,
    c.c_mktsegment AS userAgent,
    CASE WHEN e.event_id % 37 = 0 THEN '' ELSE CAST(e.user_id AS VARCHAR) END AS userId
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

# P5 -> P2 -> L2 -> L3
PREPARED = """
prepared AS (
  SELECT event_id, artist, gender, itemInSession, length, location, page, song, ts, userId,
         CAST(make_timestamp(CAST(ts AS BIGINT) * 1000) AS DATE) AS ts_todate,
         CAST(make_timestamp(CAST(registration AS BIGINT) * 1000) AS DATE) AS registration_todate,
         CAST(month(CAST(make_timestamp(CAST(ts AS BIGINT) * 1000) AS DATE)) AS INTEGER) AS month,
         string_split(location, ', ')[2] AS state,
         string_split(string_split(location, ', ')[2], '-')[1] AS state1
  FROM event_log
  WHERE userId <> ''
)"""

# P5 only, every column kept, plus state and dates
CLEAN = """
clean_events AS (
  SELECT *,
         CAST(make_timestamp(CAST(ts AS BIGINT) * 1000) AS DATE) AS ts_todate,
         CAST(make_timestamp(CAST(registration AS BIGINT) * 1000) AS DATE) AS registration_todate,
         CAST(month(CAST(make_timestamp(CAST(ts AS BIGINT) * 1000) AS DATE)) AS INTEGER) AS month,
         string_split(location, ', ')[2] AS state,
         string_split(string_split(location, ', ')[2], '-')[1] AS state1
  FROM event_log
  WHERE userId <> ''
)"""

LABELLED = """
labelled AS (
  SELECT ce.*, lb.churn_label AS churn_lab
  FROM clean_events ce JOIN labels lb ON ce.userId = lb.userId
)"""

LABELS = """
labels AS (
  SELECT userId, CAST(max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS INTEGER) AS churn_label
  FROM prepared GROUP BY userId
)"""

FIRSTS = """
firsts AS (
  SELECT userId, gender, state1 AS state FROM (
    SELECT userId, gender, state1,
           row_number() OVER (PARTITION BY userId ORDER BY ts, event_id) AS rn
    FROM prepared) WHERE rn = 1
)"""

LEN = "CAST(length AS DECIMAL(18,6))"

PAGE_COUNTS = ",\n    ".join(
    f"count(*) FILTER (WHERE page = '{p}') AS {c}" for p, c in zip(TEST_PAGES, TEST_PAGE_COLUMNS))

TOTALS = f"""
totals AS (
  SELECT userId,
    count(DISTINCT artist) AS unique_artist_count,
    CAST(sum({LEN}) AS DOUBLE) AS total_session_length,
    CAST(sum({LEN}) AS DOUBLE) / nullif(count(length), 0) AS avg_session_length,
    count(DISTINCT song) AS unique_song_count,
    CAST(sum(itemInSession) AS BIGINT) AS total_items,
    CAST(sum(itemInSession) AS DOUBLE) / nullif(count(itemInSession), 0) AS avg_items
  FROM prepared GROUP BY userId
)"""

MONTHLY = f"""
per_month AS (
  SELECT userId, month, sum({LEN}) AS l, sum(itemInSession) AS i, count(*) AS n
  FROM prepared GROUP BY userId, month
),
monthly AS (
  SELECT userId,
    CAST(sum(l) AS DOUBLE) / nullif(count(l), 0) AS avg_session_length_per_month,
    CAST(sum(i) AS DOUBLE) / nullif(count(i), 0) AS avg_items_per_month,
    CAST(sum(n) AS DOUBLE) / count(*) AS avg_count_session_per_month
  FROM per_month GROUP BY userId
)"""

DAILY = f"""
per_day AS (
  SELECT userId, ts_todate, sum({LEN}) AS l, sum(itemInSession) AS i, count(*) AS n
  FROM prepared GROUP BY userId, ts_todate
),
daily AS (
  SELECT userId,
    CAST(sum(l) AS DOUBLE) / nullif(count(l), 0) AS avg_session_length_per_day,
    CAST(sum(i) AS DOUBLE) / nullif(count(i), 0) AS avg_items_per_day,
    CAST(sum(n) AS DOUBLE) / count(*) AS avg_count_session_per_day
  FROM per_day GROUP BY userId
)"""

PAGE_PIVOT = f"""
page_pivot AS (
  SELECT userId,
    {PAGE_COUNTS}
  FROM prepared GROUP BY userId
)"""

FEATURE_SELECT = """
  SELECT t.userId, f.gender, t.unique_artist_count, f.state, t.total_session_length,
         t.avg_session_length, lb.churn_label, t.unique_song_count, t.total_items, t.avg_items,
         m.avg_session_length_per_month, m.avg_items_per_month, m.avg_count_session_per_month,
         d.avg_session_length_per_day, d.avg_items_per_day, d.avg_count_session_per_day,
         {pages}
  FROM totals t
  JOIN firsts f ON t.userId = f.userId
  JOIN labels lb ON t.userId = lb.userId
  JOIN monthly m ON t.userId = m.userId
  JOIN daily d ON t.userId = d.userId
  JOIN page_pivot p ON t.userId = p.userId""".format(
    pages=", ".join(f"p.{c}" for c in TEST_PAGE_COLUMNS))

FEATURES = f"""
features AS ({FEATURE_SELECT}
)"""

_CTES = {
    "event_log": EVENT_LOG,
    "clean_events": CLEAN,
    "labelled": LABELLED,
    "prepared": PREPARED,
    "labels": LABELS,
    "firsts": FIRSTS,
    "totals": TOTALS,
    "monthly": MONTHLY,
    "daily": DAILY,
    "page_pivot": PAGE_PIVOT,
    "features": FEATURES,
}
_DEPS = {
    "event_log": [],
    "clean_events": ["event_log"],
    "labelled": ["clean_events", "labels"],
    "prepared": ["event_log"],
    "labels": ["prepared"],
    "firsts": ["prepared"],
    "totals": ["prepared"],
    "monthly": ["prepared"],
    "daily": ["prepared"],
    "page_pivot": ["prepared"],
    "features": ["totals", "firsts", "labels", "monthly", "daily", "page_pivot"],
}


def with_ctes(body: str, *needs: str, extra: str = "") -> str:
    """``WITH`` the named building blocks (and their dependencies) + body.
    ``extra`` is appended as further CTEs (text without leading comma)."""
    order: list[str] = []

    def visit(name):
        for d in _DEPS[name]:
            visit(d)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    parts = [_CTES[n].strip() for n in order]
    if extra.strip():
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def first_of(source: str, cols, key: str = "userId") -> str:
    """Subquery: each key's values at its earliest event by (ts, event_id)."""
    c = ", ".join(cols)
    return (f"(SELECT {key}, {c} FROM (SELECT {key}, {c}, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM {source}) WHERE rn = 1)")
