"""Landing, the feature store and the layout by user."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from churnkit.operators import clean, features, label
from churnkit.operators.incremental import FeatureStore
from churnkit.plans import registry
from churnkit.sources import landing, layout
from tests.conftest import SF001

DAY = 86_400_000


def lines_of(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part.json", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(folder)


def event(i, day, **more):
    return {"event_id": i, "ts": day * DAY + i, "userId": f"u{i % 3}", "page": "Home"} | more


def files_of(folder):
    return {f"{d}/{n}": (os.stat(f"{d}/{n}").st_mtime_ns, os.stat(f"{d}/{n}").st_ino)
            for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def files_read(df):
    """The number of files that a scan has opened (a metric of its plan)."""
    df = df.select("*")  # an execution of its own
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_landing_again_leaves_other_dates_alone(spark, tmp_path):
    target, bad = str(tmp_path / "events"), str(tmp_path / "bad")
    first = lines_of(tmp_path / "a", [event(i, i % 3) for i in range(30)])
    assert landing.land_events(spark, first, target, bad, "a").rows == 30
    before = files_of(target)
    again = lines_of(tmp_path / "b", [event(i, 1, page="Help") for i in range(4)])
    counts = landing.land_events(spark, again, target, bad, "b", days=[dt.date(1970, 1, 2)])
    after = files_of(target)
    for date in ("1970-01-01", "1970-01-03"):
        old = {k: v for k, v in before.items() if date in k}
        assert old and old == {k: v for k, v in after.items() if date in k}
    assert counts == landing.Landed(4, 4, 0, 0, 0)
    rows = landing.read_landed(spark, target).collect()
    assert sum(r.event_date == dt.date(1970, 1, 2) for r in rows) == 4 and len(rows) == 24
    one = landing.read_landed(spark, target, dt.date(1970, 1, 3), dt.date(1970, 1, 3))
    assert one.count() == 10 and files_read(one) == 1


def test_quarantine_is_per_batch(spark, tmp_path):
    target, bad = str(tmp_path / "events"), str(tmp_path / "bad")
    rows = [event(1, 0), '{"event_id": 2, "ts": ', event(3, 0, length="long"), "", "[1]", {"event_id": 4}, event(5, 8),
            {"event_id": None, "ts": 5, "userId": None}]
    path = lines_of(tmp_path / "a", rows)
    counts = landing.land_events(spark, path, target, bad, "a", days=[dt.date(1970, 1, 1)])
    assert counts == landing.Landed(lines=7, rows=2, unreadable=3, no_timestamp=1, other_day=1)
    found = {(r.reason, r.line) for r in landing.read_quarantine(spark, bad).collect()}
    assert (landing.UNREADABLE, '{"event_id": 2, "ts": ') in found and (landing.NO_TIMESTAMP, '{"event_id":4}') in found
    assert {json.loads(line)["event_id"] for reason, line in found if reason == landing.OTHER_DAY} == {5}
    landing.land_events(spark, lines_of(tmp_path / "b", ["x"]), target, bad, "b")
    assert landing.read_quarantine(spark, bad).count() == 6
    landing.land_events(spark, lines_of(tmp_path / "c", [event(1, 0)]), target, bad, "a")
    assert [r.batch for r in landing.read_quarantine(spark, bad).collect()] == ["b"]
    with pytest.raises(ValueError):
        landing.land_events(spark, path, target, bad, "../a")


def test_a_large_date_is_written_as_several_files(spark, tmp_path):
    rows = spark.range(60_000).select(F.to_json(F.struct(
        F.col("id").alias("event_id"), (F.when(F.col("id") < 50_000, 5).otherwise(6) * DAY).alias("ts"),
        F.md5(F.col("id").cast("string")).alias("userId"), F.sha2(F.col("id").cast("string"), 512).alias("song"))))
    rows.write.text(str(tmp_path / "lines"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        landing.land_events(spark, str(tmp_path / "lines"), str(tmp_path / "events"), str(tmp_path / "bad"), "a")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    found = files_of(tmp_path / "events")
    assert sum("1970-01-06" in f for f in found) > 2 and sum("1970-01-07" in f for f in found) <= 2


def test_models_still_run_after_landing(spark, tmp_path):
    """A session that observes cannot ship models that know it."""
    from pyspark.ml.feature import VectorAssembler
    from churnkit.operators import train
    path = lines_of(tmp_path / "a", [event(i, 0) for i in range(3)])
    landing.land_events(spark, path, str(tmp_path / "events"), str(tmp_path / "bad"), "a")
    rows = spark.createDataFrame([(float(i % 2), float(i % 3)) for i in range(30)], "label double, x double")
    rows = VectorAssembler(inputCols=["x"], outputCol="scaled_features").transform(rows)
    assert train.logistic_regression().fit(rows).transform(rows).count() == 30
    assert len(train.logistic_regression().fit(rows).transform(rows).select("prediction").collect()) == 30


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    log = registry.events(spark, SF001)
    log.select(F.to_json(F.struct(*log.columns))).write.text(f"{base}/lines")
    landing.land_events(spark, f"{base}/lines", f"{base}/events", f"{base}/bad", "a")
    return f"{base}/events"


def rows(df):
    return sorted(map(str, df.collect()))


def ranges_of(log):
    days = sorted(r[0] for r in log.select("event_date").distinct().collect())
    third = len(days) // 3
    return [(days[0], days[third]), (days[third] + dt.timedelta(1), days[2 * third]), (days[2 * third] + dt.timedelta(1), days[-1])]


def test_loads_equal_the_batch_table(spark, landed, tmp_path):
    log = landing.read_landed(spark, landed)
    ranges = ranges_of(log)
    store = FeatureStore(spark, str(tmp_path))
    assert store.features(pages=()).collect() == [] and store.compact() is None
    for i in (2, 0, 1):
        store.load(log, f"part-{i}", *ranges[i])
    whole = rows(features.user_features(clean.prepare_events(registry.events(spark, SF001))))
    assert rows(store.features()) == whole
    # a base, a load that replaces one it holds, and a new base
    store.compact()
    assert len(store.versions()) == 1 and rows(store.features()) == whole
    store.load(log.where("page <> 'NextSong'"), "part-1", *ranges[1])
    assert len(store.versions()) == 3  # the base is stale
    some = log.where(~F.col("event_date").between(*map(F.lit, ranges[1])) | (F.col("page") != "NextSong"))
    assert rows(store.features()) == rows(features.user_features(clean.prepare_events(some.drop("event_date"))))
    store.load(log, "part-1", *ranges[1])
    store.compact()
    assert len(store.versions()) == 1 and rows(store.features()) == whole
    with pytest.raises(ValueError, match="part-0"):
        store.load(log, "more", ranges[0][1], ranges[1][0])


def test_a_load_touches_its_dates_and_users_alone(spark, landed, tmp_path):
    log = landing.read_landed(spark, landed)
    ranges = ranges_of(log)
    store = FeatureStore(spark, str(tmp_path))
    store.load(log, "old", *ranges[0])
    old = files_of(tmp_path / "days")
    new = ranges[1][0]
    assert files_read(store.rows_of(log, new, new)) == sum(str(new) in f for f in files_of(landed)) > 0
    store.load(log, "new", new, new)
    assert old.items() <= files_of(tmp_path / "days").items()
    users = {r.userId for r in clean.filter_missing_user(log).where(F.col("event_date") == F.lit(new)).collect()}
    changed = store.features_of_load("new")
    assert {r.userId for r in changed.collect()} == users
    wanted = store.features().where(F.col("userId").isin(*users))
    assert rows(changed) == rows(wanted)
    assert not any("event_date=" in f for f in store.features().inputFiles())


def test_a_load_that_dies_leaves_no_trace(spark, landed, tmp_path, monkeypatch):
    log = landing.read_landed(spark, landed)
    ranges = ranges_of(log)
    store = FeatureStore(spark, str(tmp_path))
    store.load(log, "a", *ranges[0])
    before = rows(store.features())
    with monkeypatch.context() as m:
        m.setattr(FeatureStore, "_append", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.load(log, "b", *ranges[1])
    assert rows(store.features()) == before
    store.load(log, "b", *ranges[1])
    some = log.where(F.col("event_date") <= F.lit(ranges[1][1])).drop("event_date")
    assert rows(store.features()) == rows(features.user_features(clean.prepare_events(some)))
    ids = store.dictionary("song")
    assert ids.count() == ids.select("id").distinct().count() == ids.select("value").distinct().count()


# layout ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def hot_log(spark):
    """The test log in which one user has a third of all events."""
    log = clean.filter_missing_user(registry.events(spark, SF001))
    hot = log.groupBy("userId").count().orderBy(F.desc("count"), "userId").first()[0]
    return log.withColumn("userId", F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("userId"))), hot


def executed(df):
    """The final plan of a DataFrame that has been run, and the rows that
    its largest shuffle moved."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()

    def moved(node):
        out, leaves = [0], node.collectLeaves()
        for i in range(leaves.size()):
            if leaves.apply(i).nodeName().startswith("ShuffleQueryStage"):
                exchange = leaves.apply(i).plan()
                if exchange.nodeName() == "Exchange":
                    out += [exchange.metrics().apply("shuffleRecordsWritten").value(), *moved(exchange.child())]
        return out

    return plan.toString(), max(moved(plan))


def test_joins_on_the_layout_do_not_move_events(spark, hot_log, tmp_path):
    log, hot = hot_log
    laid = layout.lay_out(log, str(tmp_path / "layout"), buckets=8, heavy=40)
    assert rows(laid.events.drop(layout.PART).select(log.columns)) == rows(log)
    parts = {r.userId: r.parts for r in laid.parts.collect()}
    assert parts[hot] >= 8
    share = laid.events.groupBy(F.input_file_name()).count().agg(F.max("count") / F.sum("count")).first()[0]
    assert share < 0.25, share  # a third of the events are one user's
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        labelled = layout.label_laid_out(laid)
        plan, moved = executed(labelled)
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan, plan
        assert moved < log.count() / 4
        assert rows(labelled.select("event_id", "churn_lab")) == rows(label.label_events(log).select("event_id", "churn_lab"))
        for anti, plain in ((False, label.churned_user_events), (True, label.retained_user_events)):
            kept = layout.churned_events(laid, anti)
            assert executed(kept)[1] < log.count() / 4
            assert rows(kept.select(log.columns)) == rows(plain(log).select(log.columns))
        # the plain join moves the events
        assert executed(label.label_events(log))[1] >= log.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old["spark.sql.autoBroadcastJoinThreshold"])
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_layout_opens_in_another_session(spark, tmp_path):
    null = spark.createDataFrame([(i, "Cancellation Confirmation" if i < 3 else "Home", None if i % 2 else "u") for i in range(20)],
                                 "event_id long, page string, userId string")
    path = str(tmp_path / "layout")
    layout.lay_out(null, path, buckets=3, heavy=4)
    laid = layout.open_layout(spark.newSession(), path)
    assert laid.buckets == 3 and laid.events.count() == 20
    assert {(r.userId, r.parts) for r in laid.parts.collect()} == {(None, 3), ("u", 3)}
    found = layout.label_laid_out(laid).collect()
    assert sorted((r.event_id, r.churn_lab) for r in found) == [(i, 0 if i % 2 else 1) for i in range(20)]
