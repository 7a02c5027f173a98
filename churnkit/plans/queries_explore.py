"""Registered exploration, cleaning, labelling and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.functions.columns import sanitize_names
from churnkit.functions.location import city_of
from churnkit.operators import boxplot, clean, explore, features, hitters, label
from churnkit.operators.joins import join_user_aggregates
from churnkit.plans import oracle as O
from churnkit.plans.registry import events, prepared, register, user_table
from churnkit.plans.oracle import TEST_FEATURE_COLUMNS as FEATURE_COLUMNS, TEST_PAGE_COLUMNS as PAGE_COLUMNS
from churnkit.schema import EVENT_SCHEMA, UNUSED_EVENT_COLUMNS
from churnkit.session import reliable_checkpoint


def clean_events(spark, sf_dir):
    """P5 only (all columns kept) plus state and dates, for the exploration."""
    ev = clean.add_state(clean.filter_missing_user(events(spark, sf_dir)))
    from churnkit.functions.dates import epoch_ms_to_date
    return ev.withColumns({
        "ts_todate": epoch_ms_to_date("ts"),
        "registration_todate": epoch_ms_to_date("registration"),
    }).withColumn("month", F.month("ts_todate"))


def labelled(spark, sf_dir):
    return label.label_events(clean_events(spark, sf_dir))


W = O.with_ctes
EVENT_COLS = [f.name for f in EVENT_SCHEMA.fields]
FEATURE_LIST = ", ".join(FEATURE_COLUMNS)

# ---------------------------------------------------------------------------
# P: projection, filter, nulls, dedup, sort
# ---------------------------------------------------------------------------


@register("filter_missing_user", W(f"SELECT {', '.join(EVENT_COLS)} FROM event_log WHERE userId <> ''", "event_log"))
def q_filter_missing_user(spark, sf_dir):
    return clean.filter_missing_user(events(spark, sf_dir))


@register("project_columns", W("SELECT userId, page, artist, song FROM clean_events", "clean_events"))
def q_project_columns(spark, sf_dir):
    return clean.project_columns(clean_events(spark, sf_dir), ["userId", "page", "artist", "song"])


_KEPT = [c for c in EVENT_COLS if c.lower() not in {u.lower() for u in UNUSED_EVENT_COLUMNS}]


@register("drop_columns", W(f"SELECT {', '.join(_KEPT)} FROM event_log WHERE userId <> ''", "event_log"))
def q_drop_columns(spark, sf_dir):
    # lower-case names on purpose: drop matches case-insensitively
    return clean.drop_columns(clean.filter_missing_user(events(spark, sf_dir)),
                              [c.lower() for c in UNUSED_EVENT_COLUMNS])


@register("filter_eq", W("SELECT userId, event_id, ts, page FROM clean_events "
                         "WHERE page = 'Cancellation Confirmation'", "clean_events"))
def q_filter_eq(spark, sf_dir):
    return clean.filter_eq(clean_events(spark, sf_dir), "page", "Cancellation Confirmation") \
        .select("userId", "event_id", "ts", "page")


@register("filter_is_null", W("SELECT userId, event_id, page FROM clean_events WHERE artist IS NULL",
                              "clean_events"))
def q_filter_is_null(spark, sf_dir):
    return clean.filter_is_null(clean_events(spark, sf_dir), "artist").select("userId", "event_id", "page")


@register("label_events", W("SELECT userId, event_id, page, churn_lab FROM labelled", "labelled"))
def q_label_events(spark, sf_dir):
    return labelled(spark, sf_dir).select("userId", "event_id", "page", "churn_lab")


@register("null_profile", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM features"
    for c in FEATURE_COLUMNS), "features"))
def q_null_profile(spark, sf_dir):
    return clean.null_profile(user_table(spark, sf_dir))


@register("drop_null_rows", W("SELECT * FROM features WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in FEATURE_COLUMNS), "features"))
def q_drop_null_rows(spark, sf_dir):
    return clean.drop_null_rows(user_table(spark, sf_dir))


def _fill_expr(c):
    if c in ("userId", "gender", "state"):
        return c
    if c == "churn_label":
        return "CAST(coalesce(churn_label, 0) AS INTEGER) AS churn_label"
    return f"coalesce({c}, 0) AS {c}"


@register("fill_null_zero", W("SELECT " + ", ".join(_fill_expr(c) for c in FEATURE_COLUMNS)
                              + " FROM features", "features"))
def q_fill_null_zero(spark, sf_dir):
    return clean.fill_null_zero(user_table(spark, sf_dir))


@register("dedup_by_user", W("SELECT * FROM " + O.first_of("clean_events", ["gender", "level", "location"]),
                             "clean_events"))
def q_dedup_by_user(spark, sf_dir):
    return clean.dedup_by_user(clean_events(spark, sf_dir), ["gender", "level", "location"])


@register("distinct_values", W("SELECT DISTINCT page FROM clean_events", "clean_events"))
def q_distinct_values(spark, sf_dir):
    return clean.distinct_values(clean_events(spark, sf_dir), "page")


@register("artist_plays_by_label", W(
    "SELECT artist, churn_lab, count(*) AS plays FROM labelled GROUP BY artist, churn_lab", "labelled"))
def q_artist_plays_by_label(spark, sf_dir):
    return explore.artist_plays_by_label(clean_events(spark, sf_dir))


@register("top_artists", W(
    "SELECT artist, churn_lab, count(*) AS plays FROM labelled GROUP BY artist, churn_lab "
    "ORDER BY plays DESC, artist ASC NULLS FIRST, churn_lab ASC LIMIT 10", "labelled"))
def q_top_artists(spark, sf_dir):
    plays = explore.artist_plays_by_label(clean_events(spark, sf_dir))
    return clean.top_n(plays, 10, F.desc("plays"), F.asc_nulls_first("artist"), F.asc("churn_lab"))


@register("top_artists_by_candidates", W(
    "SELECT artist, churn_lab, count(*) AS plays FROM labelled GROUP BY artist, churn_lab "
    "ORDER BY plays DESC, artist ASC NULLS FIRST, churn_lab ASC LIMIT 10", "labelled"))
def q_top_artists_by_candidates(spark, sf_dir):
    """P17 from bounded summaries, with exact counts of the candidates."""
    return hitters.top_artists(clean_events(spark, sf_dir), 10)


@register("lowest_listening_users", W(
    "SELECT userId, churn_label, total_session_length, avg_session_length FROM features "
    "ORDER BY total_session_length ASC NULLS LAST, userId LIMIT 10", "features"))
def q_lowest_listening_users(spark, sf_dir):
    users = user_table(spark, sf_dir).select("userId", "churn_label", "total_session_length",
                                             "avg_session_length")
    return clean.top_n(users, 10, F.asc_nulls_last("total_session_length"), F.asc("userId"))


@register("duplicate_key_check", W(
    "SELECT count(*) - count(DISTINCT userId) AS duplicate_keys FROM features", "features"))
def q_duplicate_key_check(spark, sf_dir):
    return clean.duplicate_key_check(user_table(spark, sf_dir))


@register("users_without_plays", W(
    f"SELECT {FEATURE_LIST} FROM features WHERE total_session_length IS NULL", "features"))
def q_users_without_plays(spark, sf_dir):
    return clean.filter_is_null(user_table(spark, sf_dir), "total_session_length")


# ---------------------------------------------------------------------------
# F: scalar functions
# ---------------------------------------------------------------------------

@register("event_dates", W(
    "SELECT userId, event_id, make_timestamp(ts * 1000) AS ts_ts, ts_todate, registration_todate, month "
    "FROM prepared", "prepared"))
def q_event_dates(spark, sf_dir):
    from churnkit.functions.dates import epoch_ms_to_timestamp
    return prepared(spark, sf_dir).select(
        "userId", "event_id", epoch_ms_to_timestamp("ts").alias("ts_ts"), "ts_todate",
        "registration_todate", "month")


@register("days_since_registration", W(
    "SELECT f.userId, f.NumDaysSinceRegistration, lb.churn_label AS churn_lab FROM "
    + O.first_of("(SELECT userId, ts, event_id, CAST(datediff('day', registration_todate, ts_todate) AS INTEGER)"
                 " AS NumDaysSinceRegistration FROM prepared)", ["NumDaysSinceRegistration"])
    + " f JOIN labels lb ON f.userId = lb.userId", "prepared", "labels"))
def q_days_since_registration(spark, sf_dir):
    return explore.days_since_registration(prepared(spark, sf_dir))


@register("split_location", W(
    "SELECT DISTINCT location, string_split(location, ', ')[1] AS city, state, state1 FROM clean_events",
    "clean_events"))
def q_split_location(spark, sf_dir):
    return clean_events(spark, sf_dir).select("location", city_of("location").alias("city"), "state", "state1").distinct()


# ---------------------------------------------------------------------------
# A: aggregations
# ---------------------------------------------------------------------------

@register("table_dims", W(
    f"SELECT 'event_log' AS table_name, count(*) AS n_rows, CAST({len(EVENT_COLS)} AS BIGINT) AS n_columns "
    "FROM event_log UNION ALL "
    f"SELECT 'user_features', count(*), CAST({len(FEATURE_COLUMNS)} AS BIGINT) FROM features",
    "event_log", "features"))
def q_table_dims(spark, sf_dir):
    return explore.table_dims({"event_log": events(spark, sf_dir), "user_features": user_table(spark, sf_dir)})


@register("distinct_users", W(
    "SELECT count(DISTINCT userId) AS n_users, "
    "count(DISTINCT CASE WHEN page = 'Cancellation Confirmation' THEN userId END) AS n_churners "
    "FROM clean_events", "clean_events"))
def q_distinct_users(spark, sf_dir):
    return explore.distinct_users(clean_events(spark, sf_dir))


@register("missing_user_profile", W(
    "SELECT auth, count(*) AS n_events FROM event_log WHERE userId = '' GROUP BY auth", "event_log"))
def q_missing_user_profile(spark, sf_dir):
    return explore.missing_user_profile(events(spark, sf_dir))


@register("visits_per_page", W(
    "SELECT page, count(*) AS visits FROM clean_events GROUP BY page ORDER BY page", "clean_events"))
def q_visits_per_page(spark, sf_dir):
    return explore.visits_per_page(clean_events(spark, sf_dir))


@register("users_per_auth", W(
    "SELECT auth, count(DISTINCT userId) AS n_users FROM event_log GROUP BY auth", "event_log"))
def q_users_per_auth(spark, sf_dir):
    return explore.users_per(events(spark, sf_dir), "auth")


@register("users_per_level", W(
    "SELECT level, count(DISTINCT userId) AS n_users FROM clean_events GROUP BY level", "clean_events"))
def q_users_per_level(spark, sf_dir):
    return explore.users_per(clean_events(spark, sf_dir), "level")


@register("date_range", W(
    "SELECT min(ts_todate) AS first_date, max(ts_todate) AS last_date FROM clean_events", "clean_events"))
def q_date_range(spark, sf_dir):
    return explore.date_range(clean_events(spark, sf_dir))


@register("count_nonnull_by_group", W(
    "SELECT status, count(status) AS n_nonnull, count(*) AS n_rows FROM event_log GROUP BY status",
    "event_log"))
def q_count_nonnull_by_group(spark, sf_dir):
    return explore.count_nonnull_by_group(events(spark, sf_dir), "status")


@register("label_distribution", W(
    "SELECT churn_lab, count(*) AS n_events FROM labelled GROUP BY churn_lab", "labelled"))
def q_label_distribution(spark, sf_dir):
    return explore.label_distribution(clean_events(spark, sf_dir))


@register("churn_rate", W(
    "SELECT count(*) AS n_users, CAST(sum(churn_label) AS BIGINT) AS n_churners, "
    "CAST(sum(churn_label) AS DOUBLE) * 100.0 / count(*) AS churn_rate_pct FROM labels", "labels"))
def q_churn_rate(spark, sf_dir):
    return explore.churn_rate(label.user_labels(prepared(spark, sf_dir)))


@register("events_per_user", W(
    "SELECT userId, count(*) AS n_events, churn_label AS churn_lab FROM prepared JOIN labels USING (userId) "
    "GROUP BY userId, churn_label", "prepared", "labels"))
def q_events_per_user(spark, sf_dir):
    return explore.events_per_user(prepared(spark, sf_dir))


@register("distinct_artists_per_user", W(
    "SELECT userId, count(DISTINCT artist) AS unique_artists, max(CASE WHEN page = 'Cancellation Confirmation' "
    "THEN 1 ELSE 0 END) AS churn_lab FROM prepared GROUP BY userId", "prepared"))
def q_distinct_artists_per_user(spark, sf_dir):
    return explore.distinct_per_user(prepared(spark, sf_dir), "artist", "unique_artists")


@register("distinct_songs_per_user", W(
    "SELECT userId, count(DISTINCT song) AS UniqueSongs, max(CASE WHEN page = 'Cancellation Confirmation' "
    "THEN 1 ELSE 0 END) AS churn_lab FROM prepared GROUP BY userId", "prepared"))
def q_distinct_songs_per_user(spark, sf_dir):
    return explore.distinct_per_user(prepared(spark, sf_dir), "song", "UniqueSongs")


@register("distinct_pages_per_user", W(
    "SELECT userId, count(DISTINCT page) AS UniquePages, max(CASE WHEN page = 'Cancellation Confirmation' "
    "THEN 1 ELSE 0 END) AS churn_lab FROM prepared GROUP BY userId", "prepared"))
def q_distinct_pages_per_user(spark, sf_dir):
    return explore.distinct_per_user(prepared(spark, sf_dir), "page", "UniquePages")


def _by_first_sql(cols, with_label=True):
    c = ", ".join(cols)
    if with_label:
        return W(f"SELECT {c}, lb.churn_label AS churn_lab, count(*) AS user_count FROM "
                 + O.first_of("clean_events", cols) + " f JOIN labels lb ON f.userId = lb.userId "
                 f"GROUP BY {c}, lb.churn_label", "clean_events", "labels")
    return W(f"SELECT {c}, count(*) AS user_count FROM " + O.first_of("clean_events", cols) + f" f GROUP BY {c}",
             "clean_events")


@register("users_by_gender_label", _by_first_sql(["gender"]))
def q_users_by_gender_label(spark, sf_dir):
    return explore.users_by_first(clean_events(spark, sf_dir), ["gender"])


@register("users_by_level_label", _by_first_sql(["level"]))
def q_users_by_level_label(spark, sf_dir):
    return explore.users_by_first(clean_events(spark, sf_dir), ["level"])


@register("users_per_location", _by_first_sql(["location"], with_label=False))
def q_users_per_location(spark, sf_dir):
    return explore.users_by_first(clean_events(spark, sf_dir), ["location"], with_label=False)


@register("users_by_state_label", _by_first_sql(["state1"]))
def q_users_by_state_label(spark, sf_dir):
    return explore.users_by_first(clean_events(spark, sf_dir), ["state1"])


@register("listening_per_user", W(
    f"SELECT userId, CAST(sum({O.LEN}) AS DOUBLE) AS total_session_length, "
    f"CAST(sum({O.LEN}) AS DOUBLE) / nullif(count(length), 0) AS avg_session_length, "
    "max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS churn_lab "
    "FROM prepared GROUP BY userId", "prepared"))
def q_listening_per_user(spark, sf_dir):
    return explore.listening_per_user(prepared(spark, sf_dir))


@register("page_visits_per_user", W(
    "SELECT p.userId, p.page, count(*) AS visits, lb.churn_label AS churn_lab FROM prepared p "
    "JOIN labels lb ON p.userId = lb.userId GROUP BY p.userId, p.page, lb.churn_label", "prepared", "labels"))
def q_page_visits_per_user(spark, sf_dir):
    return explore.page_visits_per_user(prepared(spark, sf_dir))


@register("mean_visits_by_page_label", W(
    "SELECT page, churn_lab, CAST(sum(visits) AS DOUBLE) / count(visits) AS mean_visits, count(*) AS n_users "
    "FROM (SELECT p.userId, p.page, count(*) AS visits, lb.churn_label AS churn_lab FROM prepared p "
    "JOIN labels lb ON p.userId = lb.userId GROUP BY p.userId, p.page, lb.churn_label) "
    "GROUP BY page, churn_lab", "prepared", "labels"))
def q_mean_visits_by_page_label(spark, sf_dir):
    return explore.mean_visits_by_page_label(explore.page_visits_per_user(prepared(spark, sf_dir)))


@register("page_pivot", W(
    "SELECT p.userId, lb.churn_label AS churn_lab, " + ", ".join(f"p.{c}" for c in PAGE_COLUMNS)
    + " FROM page_pivot p JOIN labels lb ON p.userId = lb.userId", "page_pivot", "labels"))
def q_page_pivot(spark, sf_dir):
    ev = prepared(spark, sf_dir).withColumn(
        "churn_lab", F.when(F.col("page") == "Cancellation Confirmation", 1).otherwise(0))
    return features.page_pivot(ev, label="churn_lab")


@register("rename_sanitize", W(
    "SELECT userId, " + ", ".join(PAGE_COLUMNS) + " FROM page_pivot", "page_pivot"))
def q_rename_sanitize(spark, sf_dir):
    # pivot with the raw page names (spaces), then one renaming projection
    visits = reliable_checkpoint(prepared(spark, sf_dir).groupBy("userId", "page").agg(F.count(F.lit(1)).alias("n")))
    raw = visits.groupBy("userId").pivot("page", list(features.pages_of(visits))).agg(F.sum("n")).na.fill(0)
    return sanitize_names(raw)


@register("items_per_user", W(
    "SELECT userId, CAST(sum(itemInSession) AS BIGINT) AS total_items, "
    "max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS churn_lab "
    "FROM prepared GROUP BY userId", "prepared"))
def q_items_per_user(spark, sf_dir):
    return explore.items_per_user(prepared(spark, sf_dir))


@register("first_value_per_user", W(
    "SELECT f.userId, f.userAgent, f.gender, f.state1 AS state, lb.churn_label FROM "
    + O.first_of("clean_events", ["userAgent", "gender", "state1"])
    + " f JOIN labels lb ON f.userId = lb.userId", "clean_events", "labels"))
def q_first_value_per_user(spark, sf_dir):
    from churnkit.functions.columns import first_values
    ev = clean_events(spark, sf_dir)
    return first_values(ev, "userId", ["userAgent", "gender", "state1"], with_label="churn_label") \
        .withColumnRenamed("state1", "state")


@register("avg_events_per_month", W(
    "SELECT userId, avg_count_session_per_month AS avg_session_month, churn_label AS churn_lab "
    "FROM monthly JOIN labels USING (userId)", "monthly", "labels"))
def q_avg_events_per_month(spark, sf_dir):
    return features.user_activity(prepared(spark, sf_dir), pages=()).select(
        "userId", F.col("avg_count_session_per_month").alias("avg_session_month"),
        F.col("churn_label").alias("churn_lab"))


@register("avg_events_per_day", W(
    "SELECT userId, avg_count_session_per_day AS avg_session_day, churn_label AS churn_lab "
    "FROM daily JOIN labels USING (userId)", "daily", "labels"))
def q_avg_events_per_day(spark, sf_dir):
    return features.user_activity(prepared(spark, sf_dir), pages=()).select(
        "userId", F.col("avg_count_session_per_day").alias("avg_session_day"),
        F.col("churn_label").alias("churn_lab"))


SUMMARY_METRICS = ("unique_artist_count", "total_session_length", "avg_session_length", "unique_song_count",
                   "total_items", "avg_count_session_per_month", "avg_count_session_per_day")


@register("metric_summary_by_label", W(
    "SELECT metric, churn_label, count(value) AS n, min(value) AS min_value, "
    "quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS median, "
    "quantile_disc(value, 0.75) AS q3, max(value) AS max_value FROM ("
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, churn_label, CAST({m} AS DOUBLE) AS value FROM features"
                         for m in SUMMARY_METRICS)
    + ") GROUP BY metric, churn_label", "features"))
def q_metric_summary_by_label(spark, sf_dir):
    # two passes over the user table (sketch bounds, then exact counts): checkpoint it once
    users = reliable_checkpoint(user_table(spark, sf_dir))
    return explore.metric_summary_by_label(users, SUMMARY_METRICS)


_VALUES_SQL = "vals AS (" + " UNION ALL ".join(
    f"SELECT userId, state, '{m}' AS metric, churn_label, CAST({m} AS DOUBLE) AS value FROM features"
    for m in SUMMARY_METRICS) + """),
boxes AS (
  SELECT metric, churn_label, count(value) AS n, min(value) AS min_value, quantile_disc(value, 0.25) AS q1,
         quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.75) AS q3, max(value) AS max_value
  FROM vals GROUP BY metric, churn_label),
fenced AS (
  SELECT v.*, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS within
  FROM vals v JOIN boxes b ON v.metric = b.metric AND v.churn_label = b.churn_label WHERE value IS NOT NULL)"""


def _metric_values(spark, sf_dir):
    users = reliable_checkpoint(user_table(spark, sf_dir))  # read by every pass
    return users, explore.metric_values(users, SUMMARY_METRICS, keep=["userId"])


@register("box_plots", W(
    "SELECT b.*, min(value) FILTER (within) AS lower_whisker, max(value) FILTER (within) AS upper_whisker, "
    "count(*) FILTER (NOT within) AS n_outliers FROM boxes b JOIN fenced f ON b.metric = f.metric "
    "AND b.churn_label = f.churn_label GROUP BY ALL", "features", extra=_VALUES_SQL))
def q_box_plots(spark, sf_dir):
    """A29 with whiskers, from sketches by state merged per label."""
    users, values = _metric_values(spark, sf_dir)
    by_state = boxplot.value_sketches(explore.metric_values(users, SUMMARY_METRICS, keep=["state"]),
                                      ["metric", "churn_label", "state"])
    group = ["metric", "churn_label"]
    box = reliable_checkpoint(boxplot.quartiles(values, group, boxplot.merge_sketches(by_state, group)))
    return boxplot.box_plot(values, box, group)


@register("box_plot_outliers", W(
    "SELECT userId, churn_label, metric, value FROM fenced WHERE NOT within", "features", extra=_VALUES_SQL))
def q_box_plot_outliers(spark, sf_dir):
    """The points that box plots draw one by one."""
    _, values = _metric_values(spark, sf_dir)
    group = ["metric", "churn_label"]
    return boxplot.outliers(values, reliable_checkpoint(boxplot.quartiles(values, group)), group)


# ---------------------------------------------------------------------------
# L / J: labelling, per-user tables, joins
# ---------------------------------------------------------------------------

@register("churned_user_events", W(
    "SELECT userId, event_id, page FROM prepared WHERE userId IN "
    "(SELECT userId FROM prepared WHERE page = 'Cancellation Confirmation')", "prepared"))
def q_churned_user_events(spark, sf_dir):
    return label.churned_user_events(prepared(spark, sf_dir)).select("userId", "event_id", "page")


@register("retained_user_events", W(
    "SELECT userId, event_id, page FROM prepared WHERE userId NOT IN "
    "(SELECT userId FROM prepared WHERE page = 'Cancellation Confirmation')", "prepared"))
def q_retained_user_events(spark, sf_dir):
    return label.retained_user_events(prepared(spark, sf_dir)).select("userId", "event_id", "page")


@register("user_totals", W(
    "SELECT t.userId, f.gender, t.unique_artist_count, f.state, t.total_session_length, t.avg_session_length, "
    "lb.churn_label, t.unique_song_count, t.total_items, t.avg_items FROM totals t "
    "JOIN firsts f ON t.userId = f.userId JOIN labels lb ON t.userId = lb.userId",
    "totals", "firsts", "labels"))
def q_user_totals(spark, sf_dir):
    return features.user_totals(prepared(spark, sf_dir))


@register("user_monthly_averages", W("SELECT * FROM monthly", "monthly"))
def q_user_monthly_averages(spark, sf_dir):
    return features.user_monthly_averages(prepared(spark, sf_dir))


@register("user_daily_averages", W("SELECT * FROM daily", "daily"))
def q_user_daily_averages(spark, sf_dir):
    return features.user_daily_averages(prepared(spark, sf_dir))


@register("join_user_aggregates", W("SELECT * FROM features", "features"))
def q_join_user_aggregates(spark, sf_dir):
    """J1 in the source's shape: four per-user tables (L4-L7) joined on
    userId. The tables are computed from one reliably checkpointed rollup
    (about one row per user, one scan of the event log); each would
    otherwise prune the shared aggregate differently, and the log would be
    scanned once per table."""
    grains, pages = features.grains_and_pages(prepared(spark, sf_dir))
    part = reliable_checkpoint(features.user_rollup(grains, pages))
    return join_user_aggregates(*features.user_tables(part, pages)).select(*FEATURE_COLUMNS)


@register("prepare_data", W("SELECT * FROM features", "features"))
def q_prepare_data(spark, sf_dir):
    """Raw log -> clean -> dates -> location -> label -> features."""
    return features.user_features(clean.prepare_events(events(spark, sf_dir)))
