"""Schemas and fixed vocabularies of the event log and the user feature table."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source workflow's for identical results)
# ---------------------------------------------------------------------------

# Page whose presence marks a user as churned.
CHURN_PAGE = "Cancellation Confirmation"

# The 19 page names of the event log, in alphabetical order (the order a
# pivot over them produces).
PAGES = (
    "About",
    "Add Friend",
    "Add to Playlist",
    "Cancel",
    "Cancellation Confirmation",
    "Downgrade",
    "Error",
    "Help",
    "Home",
    "Logout",
    "NextSong",
    "Roll Advert",
    "Save Settings",
    "Settings",
    "Submit Downgrade",
    "Submit Upgrade",
    "Thumbs Down",
    "Thumbs Up",
    "Upgrade",
)

# Page-count columns that restate the label; they stay in the feature table
# but never enter a model's input vector.
LEAKY_PAGES = ("Cancel", "Cancellation Confirmation")

# Columns the feature job does not use.
UNUSED_EVENT_COLUMNS = (
    "firstName", "lastName", "method", "auth", "level", "sessionId", "status", "userAgent",
)

# Model inputs: 12 measures, then the non-leaky page counts, then one-hots.
MEASURE_COLUMNS = (
    "unique_artist_count",
    "total_session_length",
    "avg_session_length",
    "unique_song_count",
    "total_items",
    "avg_items",
    "avg_session_length_per_month",
    "avg_items_per_month",
    "avg_count_session_per_month",
    "avg_session_length_per_day",
    "avg_items_per_day",
    "avg_count_session_per_day",
)
CATEGORICAL_COLUMNS = ("state", "gender")

# Hyper-parameter grid of the logistic-regression tuning run.
LR_GRID = {
    "regParam": (0.01, 0.1, 0.5),
    "elasticNetParam": (0.0, 0.5, 1.0),
    "maxIter": (10, 20, 30),
}

# Split fractions (train / validation / test) of the user table.
SPLIT_PERCENT = (70, 15, 15)

# Song lengths that fit are summed as decimals of this scale: sums become
# exact and independent of partitioning and task order.
LENGTH_DECIMAL = T.DecimalType(18, 6)


def page_column(page: str) -> str:
    """Column name of a page count: spaces become underscores."""
    return page.replace(" ", "_")


PAGE_COLUMNS = tuple(page_column(p) for p in PAGES)
MODEL_PAGE_COLUMNS = tuple(
    page_column(p) for p in PAGES if p not in LEAKY_PAGES
)

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("artist", T.StringType(), True),
    T.StructField("auth", T.StringType(), True),
    T.StructField("firstName", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("itemInSession", T.LongType(), True),
    T.StructField("lastName", T.StringType(), True),
    T.StructField("length", T.DoubleType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("method", T.StringType(), True),
    T.StructField("page", T.StringType(), True),
    T.StructField("registration", T.LongType(), True),
    T.StructField("sessionId", T.LongType(), True),
    T.StructField("song", T.StringType(), True),
    T.StructField("status", T.LongType(), True),
    T.StructField("ts", T.LongType(), True),
    T.StructField("userAgent", T.StringType(), True),
    T.StructField("userId", T.StringType(), True),
])

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("unique_artist_count", T.LongType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("total_session_length", T.DoubleType(), True),
        T.StructField("avg_session_length", T.DoubleType(), True),
        T.StructField("churn_label", T.IntegerType(), True),
        T.StructField("unique_song_count", T.LongType(), True),
        T.StructField("total_items", T.LongType(), True),
        T.StructField("avg_items", T.DoubleType(), True),
        T.StructField("avg_session_length_per_month", T.DoubleType(), True),
        T.StructField("avg_items_per_month", T.DoubleType(), True),
        T.StructField("avg_count_session_per_month", T.DoubleType(), True),
        T.StructField("avg_session_length_per_day", T.DoubleType(), True),
        T.StructField("avg_items_per_day", T.DoubleType(), True),
        T.StructField("avg_count_session_per_day", T.DoubleType(), True),
    ]
    + [T.StructField(c, T.LongType(), True) for c in PAGE_COLUMNS]
)

FEATURE_COLUMNS = tuple(f.name for f in FEATURE_SCHEMA.fields)


def feature_columns(pages=PAGES) -> tuple[str, ...]:
    """The feature table's columns with the counts of the given pages."""
    fixed = FEATURE_COLUMNS[:len(FEATURE_COLUMNS) - len(PAGES)]
    return (*fixed, *(page_column(p) for p in pages))


# The event log as the music service writes it: without an event id.
LOG_SCHEMA = T.StructType([f for f in EVENT_SCHEMA.fields if f.name != "event_id"])
