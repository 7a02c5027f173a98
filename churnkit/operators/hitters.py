"""The most played artists without shuffling every user's artists.

A top ten over the whole catalogue needs the exact plays of a few artists,
but the plain query shuffles a row for every user and artist. Here:

1. Each task keeps a Misra-Gries summary of its rows: at most ``capacity``
   counters; when there are more, the counters beyond are paid off by
   lowering all by the same amount. A value's counter is too low by at most
   what its task has paid off. Summed over tasks this brackets every value's
   count: low <= count <= low + paid, and a value in no summary occurs at
   most ``paid`` times.
2. The values with the largest counters are counted exactly, by label,
   reading the events of these alone.
3. The result is proven if no other value's upper bound reaches the k-th
   exact count (a tie would be decided by the value's name, so it does not
   count as proof). Else more candidates are taken, and where the summaries
   cannot tell them apart, the plain aggregate runs: the answer is exact in
   every case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from churnkit.operators import clean, explore
from churnkit.operators.label import churned_users
from churnkit.session import reliable_checkpoint

CAPACITY = 10_000
FIRST_CANDIDATES = 4
MORE_CANDIDATES = 8


class Summary:
    """A Misra-Gries summary of one task's values (null is a value)."""

    def __init__(self, capacity: int):
        self.capacity, self.counts, self.paid = capacity, {}, 0

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(values)
        for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
            self.counts[value] = self.counts.get(value, 0) + n
        if len(self.counts) > self.capacity:
            sizes = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            off = int(np.partition(sizes, len(sizes) - self.capacity - 1)[len(sizes) - self.capacity - 1])
            self.paid += off
            self.counts = {v: n - off for v, n in self.counts.items() if n > off}


def bounds(values: DataFrame, col: str, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(value, low) of the values that some task has kept, and ``paid``: a
    value's count lies between low (0 if it was not kept) and low + paid."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Summary(capacity)
        for batch in batches:
            own.add(batch.column(0))
        yield pa.RecordBatch.from_arrays([
            pa.array([*own.counts, None], pa.string()), pa.array([*own.counts.values(), own.paid], pa.int64()),
            pa.array([*[True] * len(own.counts), False], pa.bool_())], names=["value", "n", "kept"])

    rows = reliable_checkpoint(values.select(F.col(col).cast("string")).mapInArrow(
        summarise, "value string, n long, kept boolean"))
    paid = rows.where(~F.col("kept")).agg(F.sum("n")).first()[0] or 0
    return rows.where("kept").groupBy("value").agg(F.sum("n").alias("low")), int(paid)


def top_artists(events: DataFrame, k: int = 10, capacity: int = CAPACITY, key: str = "userId") -> DataFrame:
    """(artist, churn_lab, plays): the ``k`` groups with most plays, as
    ``explore.artist_plays_by_label`` counts them."""
    order = (F.desc("plays"), F.asc_nulls_first("artist"), F.asc("churn_lab"))
    low, paid = bounds(events, "artist", capacity)
    low = reliable_checkpoint(low)
    known, wanted = low.count(), FIRST_CANDIDATES * k
    while True:
        ranked = low.orderBy(F.desc("low"), F.asc_nulls_first("value"))
        # one more than is counted: the largest that is not
        head = ranked.limit(min(wanted, capacity) + 1).collect()
        chosen, rest = head[:min(wanted, capacity)], head[min(wanted, capacity):]
        names = events.sparkSession.createDataFrame([(r["value"],) for r in chosen], "_artist string")
        few = events.join(F.broadcast(names), events["artist"].eqNullSafe(names["_artist"]), "left_semi")
        plays = explore.artist_plays_by_label(few, key, churned_users(events, key))
        top = reliable_checkpoint(clean.top_n(plays, k, *order))
        found = top.collect()  # k rows
        unseen = (rest[0]["low"] if rest else 0) + paid
        if not unseen or (len(found) == k and unseen < min(r["plays"] for r in found)):
            return top
        if wanted >= min(known, capacity):  # the summaries cannot settle it
            return clean.top_n(explore.artist_plays_by_label(events, key), k, *order)
        wanted *= MORE_CANDIDATES
