"""User feature table.

Flagship plan (``user_features``), one scan of the event log:

1. GROUPING SETS over the cleaned events: (user, day), (user, artist),
   (user, song), (user, gender, state, page). One Expand (four copies of
   an event, six small aggregate functions each), then a hash aggregate
   that combines map-side, then ONE exchange of raw-derived rows. A user
   owning a large share of all events is spread over its days / artists /
   songs and reduced before the shuffle.
2. Hash aggregate of those grains per (user, gender, state): day rows give
   sums, counts, non-null day counts and 12-bit month masks (``bit_or``);
   artist / song rows give the distinct counts; profile rows (gender,
   state, page) the page counts (the churn label is "marker page count
   > 0") and the earliest event order of each (gender, state) (the
   minimum over its pages). Map-side combined again, so a hot user
   reaches the exchange as one row per task.
3. Per user: add up (about two rows per user) and pick gender / state of
   the earliest event.

Averages over months / days divide the exact total by the number of groups
whose sum is non-null, which equals ``avg`` over per-group sums; months
are counted with ``bit_count`` of the mask (the month number has no year,
1-12). Song lengths are summed as decimals, so results do not depend on
partitioning.

``user_totals``, ``user_monthly_averages``, ``user_daily_averages`` and
``page_pivot`` are the per-table aggregates of the source workflow (L4-L7),
one scan each. ``user_tables`` computes the same four from step 2's rows,
so that J1 (``join_user_aggregates``) can join four separately computed
tables while the event log is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from churnkit.functions.columns import (
    event_order, exact_length, first_values, length_sum, other_length)
from churnkit.schema import CHURN_PAGE, PAGES, feature_columns, page_column
from churnkit.session import reliable_checkpoint

_CHURN_COLUMN = page_column(CHURN_PAGE)
# Pages beyond which a pivot is refused (a column each).
MAX_PAGES = 500
_GRAIN_COLS = ("ts_todate", "artist", "song", "gender", "state1", "page")
_SETS = {"day": ("ts_todate",), "artist": ("artist",), "song": ("song",),
         "profile": ("gender", "state1", "page")}


def _ratio(num, den):
    """num / den as double; null when den is 0 or num is null."""
    return F.try_divide(num.cast("double"), den)


def _gid(present) -> int:
    """``grouping_id()`` of a grouping set over (key, *_GRAIN_COLS)."""
    n = len(_GRAIN_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_GRAIN_COLS) if c not in present)


GID = {name: _gid(cols) for name, cols in _SETS.items()}


def pages_of(events: DataFrame) -> tuple[str, ...]:
    """The declared pages and, after them in alphabetical order, whatever
    other pages the rows hold: no visit is left out of a pivot. One
    aggregate over the page column (of events, or better of counts already
    reduced); more than ``MAX_PAGES`` are refused."""
    found = (events.select("page").where(F.col("page").isNotNull() & ~F.col("page").isin(*PAGES))
             .distinct().limit(MAX_PAGES + 1).collect())
    if len(found) > MAX_PAGES:
        raise ValueError(f"more than {MAX_PAGES} pages; name the ones to count")
    return (*PAGES, *sorted(r["page"] for r in found))


def _page_counts(pages):
    return [F.count_if(F.col("page") == p).alias(page_column(p)) for p in pages]


def event_grains(prepared: DataFrame, key: str = "userId") -> DataFrame:
    """Step 1: the four per-user grains in one pass (GROUPING SETS)."""
    sets = [[key, *cols] for cols in _SETS.values()]
    return (prepared.withColumn("_order", event_order(prepared.columns))
            .groupingSets(sets, key, *_GRAIN_COLS)
            .agg(F.grouping_id().alias("_gid"),
                 F.sum(exact_length()).alias("len_sum"),
                 F.sum(other_length()).alias("len_other"),
                 F.count("length").alias("len_cnt"),
                 F.sum("itemInSession").alias("items_sum"),
                 F.count("itemInSession").alias("items_cnt"),
                 F.count(F.lit(1)).alias("n_events"),
                 F.min("_order").alias("first_order")))


def _month_bit(cond: Column) -> Column:
    return F.when(cond, F.expr("shiftleft(1, month(ts_todate))"))


_DAY_SUMS = ("len_sum", "len_other", "len_cnt", "items_sum", "items_cnt", "n_events")
_MASKS = ("months", "months_len", "months_items")
_COUNTS = ("n_days", "n_days_len", "n_days_items", "unique_artist_count", "unique_song_count")


def user_rollup(grains: DataFrame, pages, key: str = "userId") -> DataFrame:
    """Step 2: per (user, gender, state); only the grain rows that carry a
    measure contribute to it. The marker page is always counted."""
    pages = dict.fromkeys((*pages, CHURN_PAGE))
    gid = F.col("_gid")
    day, profile = gid == GID["day"], gid == GID["profile"]
    has_len, has_items = F.col("len_cnt") > 0, F.col("items_sum").isNotNull()
    return grains.groupBy(key, "gender", "state1").agg(
        *[F.sum(F.when(day, F.col(c))).alias(c) for c in _DAY_SUMS],
        *[F.sum(F.when(profile & (F.col("page") == p), F.col("n_events"))).alias(page_column(p)) for p in pages],
        F.count_if(day).alias("n_days"),
        F.count_if(day & has_len).alias("n_days_len"),
        F.count_if(day & has_items).alias("n_days_items"),
        F.bit_or(_month_bit(day)).alias("months"),
        F.bit_or(_month_bit(day & has_len)).alias("months_len"),
        F.bit_or(_month_bit(day & has_items)).alias("months_items"),
        F.count_if((gid == GID["artist"]) & F.col("artist").isNotNull()).alias("unique_artist_count"),
        F.count_if((gid == GID["song"]) & F.col("song").isNotNull()).alias("unique_song_count"),
        F.min(F.when(profile, F.col("first_order"))).alias("first_order"),
    )


def user_features(prepared: DataFrame, key: str = "userId", pages=None) -> DataFrame:
    """The one-row-per-user feature table. ``pages`` names the page
    counts; by default all pages that occur (see ``grains_and_pages``)."""
    grains, pages = grains_and_pages(prepared, key, pages)
    return features_from_rollup(user_rollup(grains, pages, key), pages, key)


def grains_and_pages(prepared: DataFrame, key: str = "userId", pages=None) -> tuple[DataFrame, tuple[str, ...]]:
    """Step 1 and the pages to count. Without named pages the grains are
    checkpointed and the pages found in them: the events are read once."""
    grains = event_grains(prepared, key)
    if pages is not None:
        return grains, tuple(pages)
    grains = reliable_checkpoint(grains)
    return grains, pages_of(grains.where(F.col("_gid") == GID["profile"]))


def features_from_rollup(part: DataFrame, pages, key: str = "userId") -> DataFrame:
    """Step 3 of the flagship over the rows of ``user_rollup``."""
    columns = [page_column(p) for p in pages]
    first = F.when(F.col("first_order").isNotNull(), F.struct("first_order", "gender", "state1"))
    user = part.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in _DAY_SUMS + _COUNTS],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in dict.fromkeys((*columns, _CHURN_COLUMN))],
        *[F.bit_or(c).alias(c) for c in _MASKS],
        F.min(first).alias("first_ev"),
    )
    length = length_sum(F.col("len_sum"), F.col("len_other"))
    n_months = {m: F.bit_count(F.col(m)) for m in _MASKS}
    out = user.select(
        key,
        F.col("first_ev.gender").alias("gender"),
        F.col("unique_artist_count"),
        F.col("first_ev.state1").alias("state"),
        length.alias("total_session_length"),
        _ratio(length, F.col("len_cnt")).alias("avg_session_length"),
        (F.col(_CHURN_COLUMN) > 0).cast("int").alias("churn_label"),
        F.col("unique_song_count"),
        F.col("items_sum").alias("total_items"),
        _ratio(F.col("items_sum"), F.col("items_cnt")).alias("avg_items"),
        _ratio(length, n_months["months_len"]).alias("avg_session_length_per_month"),
        _ratio(F.col("items_sum"), n_months["months_items"]).alias("avg_items_per_month"),
        _ratio(F.col("n_events"), n_months["months"]).alias("avg_count_session_per_month"),
        _ratio(length, F.col("n_days_len")).alias("avg_session_length_per_day"),
        _ratio(F.col("items_sum"), F.col("n_days_items")).alias("avg_items_per_day"),
        _ratio(F.col("n_events"), F.col("n_days")).alias("avg_count_session_per_day"),
        *[F.col(c) for c in columns],
    )
    return out.select(*feature_columns(pages))


def user_activity(prepared: DataFrame, key: str = "userId", pages=None) -> DataFrame:
    """Measures, label and page counts from the one-pass plan."""
    return user_features(prepared, key, pages).drop("gender", "state", "unique_artist_count", "unique_song_count")


# -- the per-table aggregates of the source workflow (L4-L7, J1) --------------

TOTALS_COLUMNS = ("userId", "gender", "unique_artist_count", "state", "total_session_length",
                  "avg_session_length", "churn_label", "unique_song_count", "total_items", "avg_items")


def user_profile(prepared: DataFrame, key: str = "userId") -> DataFrame:
    """Gender and (first) state of each user's earliest event."""
    return first_values(prepared, key, ["gender", "state1"]).withColumnRenamed("state1", "state")


def user_totals(prepared: DataFrame, key: str = "userId") -> DataFrame:
    """L4: first gender / state, label, distinct counts, length and item
    totals: the totals columns of the one-pass plan (one scan; the planner
    drops the aggregates these columns do not use)."""
    return user_features(prepared, key, pages=()).select(*TOTALS_COLUMNS)


def user_tables(part: DataFrame, pages, key: str = "userId") -> tuple[DataFrame, ...]:
    """L4, L5, L6, L7 as four per-user tables over the rows of
    ``user_rollup`` (one per user and gender / state, the input of J1): its
    day sums, month masks, day counts and page counts are all that the four
    need."""
    columns = [page_column(p) for p in pages]
    length = length_sum(F.sum("len_sum"), F.sum("len_other"))
    months = {m: F.bit_count(F.bit_or(m)) for m in _MASKS}
    totals = features_from_rollup(part, pages, key).select(*TOTALS_COLUMNS)
    monthly = part.groupBy(key).agg(
        _ratio(length, months["months_len"]).alias("avg_session_length_per_month"),
        _ratio(F.sum("items_sum"), months["months_items"]).alias("avg_items_per_month"),
        _ratio(F.sum("n_events"), months["months"]).alias("avg_count_session_per_month"))
    daily = part.groupBy(key).agg(
        _ratio(length, F.sum("n_days_len")).alias("avg_session_length_per_day"),
        _ratio(F.sum("items_sum"), F.sum("n_days_items")).alias("avg_items_per_day"),
        _ratio(F.sum("n_events"), F.sum("n_days")).alias("avg_count_session_per_day"))
    visits = part.groupBy(key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    return totals, monthly, daily, visits


def _two_level(prepared: DataFrame, key: str, group: str, suffix: str) -> DataFrame:
    per = prepared.groupBy(key, group).agg(
        F.sum(exact_length()).alias("l"), F.sum(other_length()).alias("o"), F.count("length").alias("c"),
        F.sum("itemInSession").alias("i"), F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg(
        _ratio(length_sum(F.sum("l"), F.sum("o")), F.count_if(F.col("c") > 0)).alias(f"avg_session_length_per_{suffix}"),
        _ratio(F.sum("i"), F.count("i")).alias(f"avg_items_per_{suffix}"),
        _ratio(F.sum("n"), F.count(F.lit(1))).alias(f"avg_count_session_per_{suffix}"),
    )


def user_monthly_averages(prepared: DataFrame, key: str = "userId") -> DataFrame:
    """Averages over a user's months of monthly length, items and events."""
    return _two_level(prepared, key, "month", "month")


def user_daily_averages(prepared: DataFrame, key: str = "userId") -> DataFrame:
    """Averages over a user's active days."""
    return _two_level(prepared, key, "ts_todate", "day")


def page_pivot(prepared: DataFrame, key: str = "userId", label: str | None = None, pages=None) -> DataFrame:
    """Page visit counts as columns, one row per user.

    The counts are conditional counts inside one map-side-combined
    aggregate. ``pages`` fixes the schema; by default the declared pages and
    whatever others occur: visits are then counted per user and page first,
    once, and both the pages and the columns come from these counts.
    ``label`` adds the user's churn flag."""
    flag = [F.max(label).cast("int").alias(label)] if label else []
    if pages is None:
        visits = reliable_checkpoint(prepared.groupBy(key, "page").agg(F.count(F.lit(1)).alias("n"), *flag))
        pages = pages_of(visits)
        aggs = [F.coalesce(F.sum(F.when(F.col("page") == p, F.col("n"))), F.lit(0)).alias(page_column(p)) for p in pages]
        return visits.groupBy(key).agg(*flag, *aggs)
    return prepared.groupBy(key).agg(*flag, *_page_counts(tuple(pages)))
