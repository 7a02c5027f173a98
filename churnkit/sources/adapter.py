"""Build the music-service event log from the TPC-H-style test tables.

``events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation JOIN region``
mapped column by column onto the event-log schema (see README, "Test data").
The same mapping is written as SQL in ``churnkit.plans.oracle`` for the
DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pyspark.sql import types as T

from churnkit.functions.dates import epoch_ms_to_date
from churnkit.sources.io import read_small_table, read_table

# ---------------------------------------------------------------------------
# Fixed values of the mapping
# ---------------------------------------------------------------------------
# Every 37th event has no user (empty-string userId).
GUEST_EVERY = 37
# Events are spread over consecutive 31-day shifts: ts + (event_id % 3) * 31 days.
SHIFT_MS = 2_678_400_000
SHIFTS = 3
# Registration: 2023-01-01 plus (custkey % 365) days, in epoch milliseconds.
REGISTRATION_BASE_MS = 1_672_531_200_000
MS_PER_DAY = 86_400_000
# An "error" event with value above this is the cancellation confirmation.
CANCEL_VALUE = 200
# Customers whose key is divisible by this have a location without ", ".
PLAIN_LOCATION_EVERY = 29
# Account balance above which the level is "paid".
PAID_BALANCE = 4500
# Distinct artists.
ARTISTS = 20
# Customers whose key is divisible by this never play a song.
NO_PLAYS_EVERY = 31
# Page by event type and event_id modulo the number of pages. "Register" is
# none of the declared pages.
PAGES_BY_TYPE = {
    "click": ("Thumbs Up", "Thumbs Down", "Add to Playlist", "Roll Advert"),
    "purchase": ("Add Friend", "Upgrade", "Submit Upgrade"),
    "signup": ("Register", "Home", "Logout", "Help", "About"),
}
EXTRA_PAGES = ("Register",)
# Row bound under which nation / region are broadcast (they hold 25 and 5).
DIMENSION_ROWS = 1000


def epoch_millis(ts_type: T.DataType, col: str = "ts"):
    """Epoch milliseconds of the source timestamp, read as UTC wall-clock.
    A ``timestamp_ntz`` column is measured from the NTZ epoch, so the value
    never depends on the session time zone."""
    if isinstance(ts_type, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                F.col(col))
    return F.unix_millis(F.col(col).cast("timestamp"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log (``EVENT_SCHEMA`` columns) derived from the test tables."""
    return event_log_from(spark, sf_dir, read_table(spark, sf_dir, "events"))


def event_log_from(spark: SparkSession, sf_dir: str, e: DataFrame) -> DataFrame:
    """Same mapping for a given ``events`` DataFrame (batch or streaming;
    a stream joins the static customer / nation / region tables)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_small_table(spark, sf_dir, "nation", DIMENSION_ROWS)
    r = read_small_table(spark, sf_dir, "region", DIMENSION_ROWS)

    # events x customer: both grow with the data, so at scale this is a
    # shuffle join on the user key (AQE splits a hot user's partition); the
    # planner broadcasts customer only while its file-size estimate is under
    # the threshold. nation and region are fixed-size dimensions, broadcast
    # after a row-count check (a hint, so they stay broadcast even where a
    # cluster turns size-based broadcasting off): whatever the settings,
    # only the customer join can move event-sized data. (Joining the
    # dimensions first would not help: without statistics a join's size
    # estimate is the product of its inputs, so the chain would never be
    # broadcast and the events side would be.)
    j = (e.join(c, e.user_id == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))

    k = F.get_json_object("props", "$.k").cast("bigint")
    etype = F.col("event_type")
    guest = (F.col("event_id") % GUEST_EVERY) == 0
    cancel = (etype == "error") & (F.col("value") > CANCEL_VALUE)
    view = (etype == "view") & ((F.col("c_custkey") % NO_PLAYS_EVERY) != 0)
    page = F.when(cancel, "Cancellation Confirmation").when(etype == "error", "Error").when(view, "NextSong")
    for kind, pages in PAGES_BY_TYPE.items():
        nth = F.get(F.array(*map(F.lit, pages)), (F.col("event_id") % len(pages)).cast("int"))
        page = page.when(etype == kind, nth)
    page = page.otherwise("Home")
    ts_ms = epoch_millis(e.schema["ts"].dataType) + (F.col("event_id") % SHIFTS) * F.lit(SHIFT_MS)
    location = F.when((F.col("c_custkey") % PLAIN_LOCATION_EVERY) == 0, F.col("n_name")).otherwise(
        F.concat(F.col("n_name"), F.lit(", "), F.substring("r_name", 1, 2), F.lit("-"),
                 F.substring("n_name", 1, 2)))
    status = (F.when(guest, F.lit(None).cast("bigint"))
              .when(cancel | (etype != "error"), F.lit(200).cast("bigint"))
              .otherwise(F.lit(404).cast("bigint")))

    return j.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.when(view, F.concat(F.lit("artist_"), (k % ARTISTS).cast("string"))).alias("artist"),
        F.when(guest, "Guest").when(cancel, "Cancelled").otherwise("Logged In").alias("auth"),
        F.col("c_name").alias("firstName"),
        F.when((F.col("c_custkey") % 2) == 0, "F").otherwise("M").alias("gender"),
        k.alias("itemInSession"),
        F.col("n_name").alias("lastName"),
        F.when(view, F.col("value")).alias("length"),
        F.when(F.col("c_acctbal") > PAID_BALANCE, "paid").otherwise("free").alias("level"),
        location.alias("location"),
        F.when(etype.isin("view", "signup"), "GET").otherwise("PUT").alias("method"),
        page.alias("page"),
        (F.lit(REGISTRATION_BASE_MS) + (F.col("c_custkey") % 365) * F.lit(MS_PER_DAY)).alias("registration"),
        (F.col("user_id") * 100 + F.dayofmonth(epoch_ms_to_date(epoch_millis(e.schema["ts"].dataType))))
        .cast("bigint").alias("sessionId"),
        F.when(view, F.concat(F.lit("song_"), k.cast("string"))).alias("song"),
        status.alias("status"),
        ts_ms.alias("ts"),
        F.col("c_mktsegment").alias("userAgent"),
        F.when(guest, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("userId"),
    )
