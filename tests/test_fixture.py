"""The hand-made 12-row event log with edge cases; values worked out by hand."""

import datetime as dt

import pytest

from churnkit.operators import clean, features, label
from churnkit.schema import EVENT_SCHEMA


def ms(*args):
    return int(dt.datetime(*args, tzinfo=dt.timezone.utc).timestamp() * 1000)


LOC = "New York, NY-NJ-PA"
ROWS = [
    # event_id, userId, ts, page, length, artist, song, item, gender, location
    (1, "", ms(2018, 10, 1), "Home", None, None, None, 0, None, None),
    (2, None, ms(2018, 10, 1), "Home", None, None, None, 0, None, None),
    (3, "u1", ms(2018, 10, 1, 23, 59, 59) + 999, "NextSong", 10.5, "A", "s1", 0, "F", LOC),
    (4, "u1", ms(2018, 10, 2), "NextSong", 20.0, "A", "s2", 1, "F", LOC),
    (5, "u1", ms(2018, 10, 2, 0, 1), "Add to Playlist", None, None, None, 2, "F", LOC),
    (6, "u1", ms(2018, 11, 1), "Home", None, None, None, 0, "F", LOC),
    (7, "u1", ms(2018, 11, 2), "Cancellation Confirmation", None, None, None, 1, "F", LOC),
    (8, "u2", ms(2018, 10, 5, 12), "Home", None, None, None, 0, "M", "Nowhere"),
    (9, "u2", ms(2018, 10, 5, 12), "Help", None, None, None, 1, "M", "Nowhere"),
    (10, "u3", ms(2018, 10, 5, 12), "NextSong", 5.0, "B", "s3", 0, "F", "Reno, NV"),
    (11, "u3", ms(2019, 10, 5, 12), "NextSong", 7.0, "B", "s3", 0, "M", "Reno, NV"),
    (12, "u4", ms(2018, 12, 31, 23), "Cancel", None, None, None, 0, "M", None),
]


@pytest.fixture(scope="module")
def log(spark):
    names = [f.name for f in EVENT_SCHEMA.fields]
    full = []
    for (eid, uid, ts, page, length, artist, song, item, gender, loc) in ROWS:
        d = dict.fromkeys(names)
        d.update(event_id=eid, userId=uid, ts=ts, page=page, length=length, artist=artist, song=song,
                 itemInSession=item, gender=gender, location=loc, registration=ms(2018, 9, 1))
        full.append(tuple(d[n] for n in names))
    return spark.createDataFrame(full, EVENT_SCHEMA)


def test_missing_users_dropped(log):
    assert clean.filter_missing_user(log).count() == 10


def test_labels(log):
    got = {r.userId: r.churn_label for r in label.user_labels(clean.filter_missing_user(log)).collect()}
    assert got == {"u1": 1, "u2": 0, "u3": 0, "u4": 0}


def test_event_level_label(log):
    lab = label.label_events(clean.filter_missing_user(log))
    assert {r.churn_lab for r in lab.filter("userId = 'u1'").collect()} == {1}
    assert lab.filter("churn_lab = 1").count() == 5


def test_features(log):
    rows = {r.userId: r.asDict() for r in features.user_features(clean.prepare_events(log)).collect()}
    assert set(rows) == {"u1", "u2", "u3", "u4"}
    u1, u2, u3, u4 = (rows[k] for k in ("u1", "u2", "u3", "u4"))
    assert u1["total_session_length"] == 30.5 and u1["avg_session_length"] == 15.25
    assert u1["avg_session_length_per_month"] == 30.5
    assert u1["avg_count_session_per_month"] == 2.5
    assert u1["avg_session_length_per_day"] == 15.25
    assert u1["avg_count_session_per_day"] == 1.25
    assert (u1["unique_artist_count"], u1["unique_song_count"], u1["state"], u1["gender"]) == (1, 2, "NY", "F")
    assert u1["Add_to_Playlist"] == 1 and u1["Cancellation_Confirmation"] == 1 and u1["churn_label"] == 1
    assert u2["total_session_length"] is None and u2["avg_session_length_per_month"] is None
    assert u2["avg_count_session_per_month"] == 2 and u2["avg_count_session_per_day"] == 2
    assert (u2["unique_artist_count"], u2["unique_song_count"], u2["state"], u2["gender"]) == (0, 0, None, "M")
    assert u3["total_session_length"] == 12.0 and u3["avg_session_length"] == 6.0
    assert u3["avg_session_length_per_month"] == 12.0  # both Octobers merge (month has no year)
    assert u3["avg_count_session_per_month"] == 2 and u3["avg_session_length_per_day"] == 6.0
    assert u3["avg_count_session_per_day"] == 1 and u3["gender"] == "F" and u3["state"] == "NV"
    assert u4["Cancel"] == 1 and u4["churn_label"] == 0 and u4["state"] is None
    assert u4["avg_count_session_per_day"] == 1 and u4["avg_session_length_per_day"] is None


def test_first_tie_break_by_event_id(log):
    first = clean.dedup_by_user(clean.filter_missing_user(log).withColumnRenamed("page", "p"), ["p"])
    assert {r.userId: r.p for r in first.collect()}["u2"] == "Home"


def _direct_totals(ev):
    """L4 as plain aggregates over events (independent of the one-pass plan)."""
    from pyspark.sql import functions as F
    from churnkit.functions.columns import is_churn_event, total_length
    totals = ev.groupBy("userId").agg(
        F.count_distinct("artist").alias("unique_artist_count"),
        total_length().alias("total_session_length"),
        F.try_divide(total_length(), F.count("length")).alias("avg_session_length"),
        F.max(is_churn_event()).cast("int").alias("churn_label"),
        F.count_distinct("song").alias("unique_song_count"),
        F.sum("itemInSession").alias("total_items"),
        F.try_divide(F.sum("itemInSession").cast("double"), F.count("itemInSession")).alias("avg_items"))
    return totals.join(features.user_profile(ev), "userId").select(*features.TOTALS_COLUMNS)


def test_feature_chain_equals_aggregate_and_join(log):
    from churnkit.operators.joins import join_user_aggregates
    from churnkit.schema import FEATURE_COLUMNS
    ev = clean.prepare_events(log)
    naive = join_user_aggregates(_direct_totals(ev), features.user_monthly_averages(ev),
                                 features.user_daily_averages(ev), features.page_pivot(ev)).select(*FEATURE_COLUMNS)
    want = sorted(map(tuple, features.user_features(ev).collect()))
    assert sorted(map(tuple, naive.collect())) == want
    assert sorted(map(tuple, features.user_totals(ev).collect())) == sorted(map(tuple, _direct_totals(ev).collect()))


def test_per_user_tables_from_grains(log):
    """J1's inputs computed from the rollup rows equal the per-table
    aggregates computed from events."""
    ev = clean.prepare_events(log)
    found = features.pages_of(ev)
    totals, monthly, daily, pages = features.user_tables(features.user_rollup(features.event_grains(ev), found), found)
    for got, want in ((totals, _direct_totals(ev)), (monthly, features.user_monthly_averages(ev)),
                      (daily, features.user_daily_averages(ev)), (pages, features.page_pivot(ev))):
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_event_order_key_sorts_like_ts_then_id(spark):
    from churnkit.functions.columns import event_order
    lo, hi = -(2 ** 63), 2 ** 63 - 1
    rows = [(1, lo), (1, hi), (2, lo), (0, 5), (10 ** 17 - 1, hi), (-5, 0), (1, 0)]
    df = spark.createDataFrame(rows, "ts long, event_id long").withColumn("o", event_order(("ts", "event_id")))
    assert [(r.ts, r.event_id) for r in df.orderBy("o").collect()] == sorted(rows)


def test_first_values_without_an_event_id(log, spark):
    """The service's own log has no event id: ts, then itemInSession, then
    the values decide."""
    rows = [("u", 2, 0, "free"), ("u", 1, 5, "paid"), ("v", 1, 2, "free"), ("v", 1, 1, "paid"),
            ("w", 1, 1, "paid"), ("w", 1, 1, "free"), ("x", None, 0, "late"), ("x", 9, 0, "early")]
    df = spark.createDataFrame(rows, "userId string, ts long, itemInSession long, level string")
    got = {r.userId: r.level for r in clean.dedup_by_user(df, ["level"]).collect()}
    assert got == {"u": "paid", "v": "paid", "w": "free", "x": "early"}
    # the whole feature job, with the column absent and with null ids
    raw = clean.prepare_events(log.drop("event_id"))
    nulls = clean.prepare_events(log.selectExpr("* except (event_id)", "CAST(null AS bigint) AS event_id"))
    for events in (raw, nulls):
        rows = {r.userId: r for r in features.user_features(events).collect()}
        assert (rows["u1"].gender, rows["u1"].state, rows["u3"].gender) == ("F", "NY", "F")


def test_no_page_is_dropped(log):
    from pyspark.sql import functions as F
    ev = clean.prepare_events(log.withColumn("page", F.when(F.col("page") == "Home", "Register").otherwise(F.col("page"))))
    for table in (features.user_features(ev), features.page_pivot(ev)):
        counted = sum(sum(r[c] for c in ("Register", "Help", "NextSong", "Add_to_Playlist", "Cancel",
                                         "Cancellation_Confirmation")) for r in table.collect())
        assert counted == 10
    only = features.user_features(ev, pages=("Help",))
    assert "Register" not in only.columns and {r.userId: r.churn_label for r in only.collect()}["u1"] == 1


def test_too_many_pages_are_refused(spark):
    many = spark.range(features.MAX_PAGES + 1).selectExpr("concat('p', id) AS page")
    with pytest.raises(ValueError):
        features.pages_of(many)


def test_lengths_are_neither_rounded_nor_capped(spark):
    import math
    from churnkit.operators import explore
    rows = [("fine", 0.1234567891), ("fine", 1.0), ("huge", 1e13), ("huge", 2.5), ("nan", float("nan")), ("nan", 10.0),
            ("none", None), ("plain", 0.1), ("plain", 0.2)]
    df = spark.createDataFrame([(u, x, "NextSong") for u, x in rows], "userId string, length double, page string")
    got = {r.userId: (r.total_session_length, r.avg_session_length) for r in explore.listening_per_user(df).collect()}
    assert got["fine"] == (1.1234567891, 1.1234567891 / 2)
    assert got["huge"] == (1e13 + 2.5, (1e13 + 2.5) / 2)
    assert all(map(math.isnan, got["nan"])) and got["none"] == (None, None)
    assert got["plain"] == (0.3, 0.15)
