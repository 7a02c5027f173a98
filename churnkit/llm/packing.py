"""Best-fit packing into sequences of several permitted lengths.

Documents are measured in words, cut into pieces no longer than the
longest permitted length, and dealt into shards of about ``SHARD_PIECES``
pieces by a hash of doc_id, words, piece and, of documents that agree in
the first two, the ordinal: a doc_id that is null or repeated fills no
shard more than others do. Every shard is packed on its own:

* pieces are placed in order of falling length, each into the open bin
  whose remaining room is least but sufficient, whatever the bin's size;
* where no open bin has room, a new one is opened. All permitted lengths
  are weighed together: for each that can hold the piece, the bin is
  filled on trial from the pieces still waiting (largest that fits first),
  and the length of least cost per packed word is opened (ties: the
  longest). The cost of a bin is its length plus ``overhead``;
* at the end each bin is downsized to the shortest permitted length that
  holds its contents.

Only lengths travel to the packing tasks. A shard's size doesn't grow with
the input, so neither does its memory; the number of bins exceeds that of
one packing of everything by a part of a bin per shard and size.

Defined results: a null or empty text has no words and is one piece of
length zero, which goes into the fullest open bin (a bin of the shortest
length if there is none); a null doc_id is packed like any other; rows
that repeat a doc_id are pieces of their own; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.session import reliable_checkpoint

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
SHARD_PIECES = 4000
COPIES = 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str):
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("long")


class _Waiting:
    """The lengths still to be placed, as counts by distinct length."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.values, self.counts = values.tolist(), counts.tolist()

    def take(self, length: int) -> None:
        i = bisect_left(self.values, length)
        self.counts[i] -= 1
        if not self.counts[i]:
            del self.values[i], self.counts[i]

    def trial(self, room: int) -> int:
        """What a bin of ``room`` would hold, largest that fits first."""
        left = room
        i = bisect_left(self.values, left + 1) - 1
        while i >= 0 and left > 0 and self.values[i] > 0:
            n = min(self.counts[i], left // self.values[i])
            left -= n * self.values[i]
            i = min(i - 1, bisect_left(self.values, left + 1) - 1)
        return room - left


def best_fit(lengths: Sequence[int], permitted: Sequence[int] = LENGTHS,
             overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Pack pieces: (bin of each piece, place in its bin, size of each
    bin). Pieces of one length are placed in the order given."""
    sizes = sorted(set(permitted))
    if not sizes or sizes[0] <= 0:
        raise ValueError("permitted lengths must be positive")
    arr = np.asarray(lengths, dtype=np.int64)
    if len(arr) and arr.max() > sizes[-1]:
        raise ValueError("a piece is longer than the longest permitted length")
    waiting = _Waiting(arr)
    bins, place = [0] * len(arr), [0] * len(arr)
    used: list[int] = []
    members: list[int] = []
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in np.argsort(-arr, kind="stable").tolist():
        length = int(arr[i])
        at = bisect_left(open_bins, (length, -1))
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            able = [s for s in sizes if s >= length]
            room = min(able, key=lambda s: ((s + overhead) / max(waiting.trial(s), 1), -s)) if length else able[0]
            b = len(used)
            used.append(0)
            members.append(0)
        waiting.take(length)
        bins[i], place[i] = b, members[b]
        used[b] += length
        members[b] += 1
        insort(open_bins, (room - length, b))
    return bins, place, [sizes[bisect_left(sizes, u)] for u in used]


def numbered(equal: DataFrame) -> DataFrame:
    """The rows (doc_id, words) that ``equal`` (doc_id, words, n) counts,
    told apart by ``copy`` (0, 1, ...), whatever the partitioning. They are
    made a block at a time, so no task gets all equal rows."""
    blocks = equal.select("doc_id", "words", "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("first"))
    return blocks.repartition("doc_id", "words", "first").select("doc_id", "words", F.explode(F.sequence(
        F.col("first"), F.least(F.col("n"), F.col("first") + COPIES) - 1)).alias("copy"))


def pack(docs: DataFrame, permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece (0, 1,
    ... within its document), start (words before it), length, bin_id,
    place (position within the bin), bin_length (the bin's final size) and
    bin_used (its words)."""
    longest = max(permitted)
    # three numbers a document, kept: the texts are read once, for the number of pieces and for the pieces
    equal = reliable_checkpoint(docs.select(F.col("doc_id").cast("long"), word_count("text").alias("words"))
                                .groupBy("doc_id", "words").agg(F.count(F.lit(1)).alias("n")))
    last = F.greatest(F.ceil(F.col("words") / longest) - 1, F.lit(0))
    total = equal.agg(F.sum(F.col("n") * (last + 1)).cast("long")).first()[0] or 0
    pieces = numbered(equal).select("doc_id", "words", "copy", F.explode(F.sequence(
        F.lit(0), last.cast("int"))).alias("piece"))
    pieces = pieces.select(
        "doc_id", "words", "copy", "piece", (F.col("piece").cast("long") * longest).alias("start"),
        F.least(F.col("words") - F.col("piece").cast("long") * longest, F.lit(longest)).cast("long").alias("length"))
    shards = max(1, -(-total // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "words", "copy", "piece"), F.lit(shards)).cast("long"))
    dealt = dealt.drop("words", "copy")

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("length", "ascending")])
        lengths = group.column("length").to_numpy()
        bins, place, sizes = best_fit(lengths, permitted, overhead)
        at = np.asarray(bins, dtype=np.int64)
        used = np.bincount(at, weights=lengths, minlength=len(sizes)).astype(np.int64)
        shard = group.column("shard").to_numpy()
        return pa.table({
            **{c: group.column(c) for c in ("doc_id", "piece", "start", "length")},
            "bin_id": pa.array(shard * (1 << 32) + at), "place": pa.array(place, pa.int64()),
            "bin_length": pa.array(np.asarray(sizes, dtype=np.int64)[at]), "bin_used": pa.array(used[at])})

    return dealt.groupBy("shard").applyInArrow(
        fill, "doc_id long, piece int, start long, length long, bin_id long, place long, "
              "bin_length long, bin_used long")
