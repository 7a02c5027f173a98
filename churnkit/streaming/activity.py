"""Per-user activity kept up to date as events arrive (Structured Streaming).

The stream is cleaned like the batch log (P5, dates) and aggregated per
user in the state store (update mode): event and song counts, exact
length sum, item sum, churn flag, page counts, first / last event time.
Every micro-batch appends the users it changed, tagged with the batch id,
to a Parquet changelog (``foreachBatch``; idempotent per batch id, so a
retried batch overwrites its own folder). ``latest_activity`` reads the
current value per user. The query's checkpoint and the changelog live in
the shared checkpoint folder, so a restarted driver or a lost executor
resumes from the last committed batch.

Distinct counts and the day / month averages need the whole history per
user (or unbounded state) and stay in the batch job.

The state holds one row per user ever seen, so it grows with the user
base. Unless the session names a state store, the RocksDB provider keeps
it in native memory and on local disk with incremental checkpoints,
instead of the default provider's executor heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from churnkit.functions.columns import exact_length, is_churn_event, length_sum, other_length
from churnkit.operators.clean import filter_missing_user
from churnkit.schema import PAGES, page_column

def activity_columns(pages=PAGES) -> tuple[str, ...]:
    return ("userId", "n_events", "n_songs", "total_session_length", "total_items", "churn_label", "first_ts",
            "last_ts", *(page_column(p) for p in pages), "other_pages")


# Schema of the test ``events`` table when read as a stream.
RAW_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The ``events`` table as a file stream: a folder of part files, or one
    file (found through the session's own file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    reader = spark.readStream.schema(RAW_EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    if folder:
        return reader.parquet(path)
    return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())


def activity_aggregate(events: DataFrame, key: str = "userId", pages=PAGES) -> DataFrame:
    """Per-user running aggregates (all mergeable, so they fit the state
    store). A stream cannot look for its pages first: visits to pages that
    are not named count as ``other_pages``."""
    counts = [F.count_if(F.col("page") == p).alias(page_column(p)) for p in pages]
    counts.append(F.count_if(F.col("page").isNotNull() & ~F.col("page").isin(*pages)).alias("other_pages"))
    return filter_missing_user(events).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("length").alias("n_songs"),
        F.sum(exact_length()).alias("len_sum"),
        F.sum(other_length()).alias("len_other"),
        F.sum("itemInSession").alias("total_items"),
        F.max(is_churn_event()).cast("int").alias("churn_label"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        *counts,
    )


def _finish(df: DataFrame, pages=PAGES) -> DataFrame:
    total = length_sum(F.col("len_sum"), F.col("len_other"))
    return df.withColumn("total_session_length", total).select(*activity_columns(pages))


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_activity_stream(events_stream: DataFrame, changelog: str, checkpoint: str,
                          available_now: bool = True, pages=PAGES):
    """Start the streaming query; returns the ``StreamingQuery``. The state
    store is named for this query alone: a query takes the setting when it
    starts, and the session's own is put back."""
    spark = events_stream.sparkSession
    agg = activity_aggregate(events_stream, pages=pages)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (_finish(batch, pages).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{changelog}/batch_id={batch_id}"))

    writer = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    named = spark.conf.get(STATE_STORE_CONF, None)
    spark.conf.set(STATE_STORE_CONF, named or ROCKSDB_PROVIDER)
    try:
        return writer.start()
    finally:
        if named is None:
            spark.conf.unset(STATE_STORE_CONF)


def latest_activity(spark: SparkSession, changelog: str, pages=PAGES) -> DataFrame:
    """Current activity per user: the row of the newest batch that changed it.
    Per user the changelog holds at most one row per batch."""
    log = spark.read.option("basePath", changelog).parquet(f"{changelog}/batch_id=*")
    cols = [c for c in activity_columns(pages) if c != "userId"]
    latest = log.groupBy("userId").agg(F.max_by(F.struct(*cols), "batch_id").alias("_v"))
    return latest.select("userId", *[F.col(f"_v.{c}").alias(c) for c in cols])
