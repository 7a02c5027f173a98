"""Streaming activity over two micro-batches equals the batch aggregate."""

import tempfile

from pyspark.sql import functions as F

from churnkit.sources.adapter import event_log, event_log_from
from churnkit.streaming import activity
from tests.conftest import SF001


def test_two_batches_equal_batch(spark):
    src = tempfile.mkdtemp(prefix="churnkit-stream-src-")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    # two files: the second batch revisits users of the first
    events.filter(F.col("event_id") % 2 == 0).coalesce(1).write.parquet(f"{src}/a")
    events.filter(F.col("event_id") % 2 == 1).coalesce(1).write.parquet(f"{src}/b")
    raw = (spark.readStream.schema(activity.RAW_EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(src))
    stream = event_log_from(spark, SF001, raw)
    changelog = tempfile.mkdtemp(prefix="churnkit-stream-log-")
    ckpt = tempfile.mkdtemp(prefix="churnkit-stream-ckpt-")
    q = activity.start_activity_stream(stream, changelog, ckpt)
    q.awaitTermination()
    got = activity.latest_activity(spark, changelog)
    n_batches = spark.read.parquet(changelog).select("batch_id").distinct().count()
    assert n_batches == 2
    want = activity._finish(activity.activity_aggregate(event_log(spark, SF001)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_a_folder_and_a_file_are_read_alike(spark):
    src = tempfile.mkdtemp(prefix="churnkit-stream-src-")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.repartition(3).write.parquet(f"{src}/events.parquet")
    want = sorted(map(tuple, activity._finish(activity.activity_aggregate(event_log(spark, SF001))).collect()))
    for folder in (SF001, src):
        raw = activity.read_events_stream(spark, f"{folder}/events.parquet")
        log, ckpt = (tempfile.mkdtemp(prefix="churnkit-stream-") for _ in range(2))
        activity.start_activity_stream(event_log_from(spark, SF001, raw), log, ckpt).awaitTermination()
        assert spark.conf.get(activity.STATE_STORE_CONF, None) is None
        assert sorted(map(tuple, activity.latest_activity(spark, log).collect())) == want
    assert any(r[-1] for r in want)  # visits to a page that is not named
