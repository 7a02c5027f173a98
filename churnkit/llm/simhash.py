"""SimHash near-dedup by a segment-popcount embedding.

A document's fingerprint has a bit set where over half of its shingles'
hashes have it. Equal fingerprints form a class before anything is
joined, so copies cost one row. A fingerprint is embedded as the bit
counts of its sixteen 4-bit segments: the Manhattan distance of two such
vectors never exceeds the number of differing bits. The segments are
dealt into ``k // 2 + 1`` groups, so two fingerprints within ``k`` bits
lie within Manhattan distance 1 in one group at least. Each group is a
grid whose cell is the vector of bit counts; a fingerprint is at home in
its own cell and visits the cells one count above it, and only home pairs
and home-visitor pairs of a cell whose total bit counts differ by at most
``k`` are compared exactly. Links leave a task as a spanning forest, at
most one row per fingerprint, and become components by contraction.

Defined results: a null or empty text has fingerprint zero and links like
any other; a null doc_id takes part, but never names a component that has
another document; rows that repeat a doc_id are separate rows and link by their
texts alone; other columns are ignored (``keep_one`` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, components, fresh, slices
from churnkit.session import reliable_checkpoint

SEGMENTS, SEGMENT_BITS = 16, 4
SLICE_BYTES = 16 << 20
PAIRS = 1 << 21
ROWS = 1 << 19


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text; zero if it has no words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    count, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, 1 << 15):
        digest = b"".join([xxhash.xxh64_digest(joined[a:b], seed)
                           for a, b in zip(starts[i:i + (1 << 15)].tolist(), ends[i:i + (1 << 15)].tolist())])
        bits = np.unpackbits(np.frombuffer(digest, np.uint8)).reshape(-1, 64)
        count += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, hash_a, hash_b, fp): two hashes of the text (a null differs
    from an empty one) and the fingerprint as a signed long."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            fp = [fingerprint(t, shingle) for t in byte_texts(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp, pa.int64())],
                                             names=["doc_id", "hash_a", "hash_b", "fp"])
    return docs.select(*row_key("doc_id", "hash_a", "hash_b"), "text").mapInArrow(
        emit, "doc_id long, hash_a long, hash_b long, fp long")


def row_key(*names: str) -> list:
    """A row's doc_id and two hashes of its text, under these names."""
    columns = F.col("doc_id").cast("long"), F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))
    return [c.alias(n) for c, n in zip(columns, names)]


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """(n, 16): the set bits of each 4-bit segment, high bits first."""
    shifts = np.arange(SEGMENTS - 1, -1, -1, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    return np.bitwise_count((fp.view(np.uint64)[:, None] >> shifts) & np.uint64(15)).astype(np.int64)


def grid_rows(fp: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, visitor, index of fp): every home cell and every visited one."""
    counts, base = segment_counts(fp), SEGMENT_BITS + 1
    n_groups = k // 2 + 1
    cells, visits, index = [], [], []
    every = np.arange(len(fp))
    for g, segs in enumerate(np.array_split(np.arange(SEGMENTS), n_groups)):
        weight = base ** np.arange(len(segs), dtype=np.int64)
        home = counts[:, segs] @ weight
        offset = g << 48
        cells.append(home + offset)
        visits.append(np.zeros(len(fp), np.int8))
        index.append(every)
        for j in range(len(segs) if k else 0):
            can = counts[:, segs[j]] < SEGMENT_BITS
            cells.append(home[can] + weight[j] + offset)
            visits.append(np.ones(int(can.sum()), np.int8))
            index.append(every[can])
    return np.concatenate(cells), np.concatenate(visits), np.concatenate(index)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges as stars: (node, least node)."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if (rx == ry).all():
            break
        low, high = np.minimum(rx, ry), np.maximum(rx, ry)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def cell_links(cell: np.ndarray, visitor: np.ndarray, fp: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as a spanning forest) among the rows of whole cells."""
    total = np.bitwise_count(fp.view(np.uint64)).astype(np.int64)
    rank = np.unique(cell, return_inverse=True)[1].astype(np.int64)
    code = (rank << 8) + (visitor.astype(np.int64) << 7) + total  # total <= 64
    order = np.argsort(code, kind="stable")
    code, fp, visitor = code[order], fp[order], visitor[order]
    home = np.flatnonzero(visitor == 0)
    c = code[home]
    same = np.searchsorted(code, c + k, side="right")
    # a window of totals stays within its cell and side: totals end at 64 + k < 127
    low = np.searchsorted(code, np.maximum((c & 127) - k, 0) + (c >> 7 << 7) + 128)
    high = np.searchsorted(code, c + k + 128, side="right")
    out_a, out_b = np.empty(0, np.int64), np.empty(0, np.int64)
    for first, last in ((home + 1, same), (low, high)):
        width = np.maximum(last - first, 0)
        done = np.cumsum(width)
        at = 0
        while at < len(home):
            base = done[at - 1] if at else 0
            to = max(int(np.searchsorted(done, base + PAIRS, side="right")), at + 1)
            for s in range(0, int(width[at]) if to == at + 1 else 1, PAIRS):  # one long window is cut
                if to == at + 1:
                    j = np.arange(first[at] + s, min(first[at] + s + PAIRS, last[at]))
                    i = np.full(len(j), home[at])
                else:
                    w = width[at:to]
                    i = np.repeat(home[at:to], w)
                    j = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[at:to], w)
                hit = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= k
                hit &= fp[i] != fp[j]
                if hit.any():
                    out_a, out_b = forest(np.concatenate([out_a, fp[i[hit]]]), np.concatenate([out_b, fp[j[hit]]]))
            at = to
    return out_a, out_b


def links(classes: DataFrame, k: int = 2) -> DataFrame:
    """(a, b): a spanning forest of the pairs of distinct fingerprints
    ``classes.fp`` within ``k`` bits (several forests, one per task)."""
    if not 0 <= k <= 31:
        raise ValueError("k must be between 0 and 31")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            cell, visitor, index = grid_rows(fp, k)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(visitor), pa.array(fp[index])],
                                             names=["cell", "visitor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        forests: list[np.ndarray] = [np.empty((2, 0), np.int64)]

        def work(rows: np.ndarray) -> None:
            a, b = cell_links(rows[0], rows[1], rows[2], k)
            forests.append(np.stack([a, b]))

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            held.append(rows)
            size += rows.shape[1]
            if size >= ROWS:
                whole = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last cell may go on
                if cut:
                    work(whole[:, :cut])
                held, size = [whole[:, cut:]], whole.shape[1] - cut
        if size:
            work(np.concatenate(held, axis=1))
        found = np.concatenate(forests, axis=1)
        a, b = forest(found[0], found[1])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    rows = classes.select("fp").mapInArrow(deal, "cell long, visitor byte, fp long")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def _rooted(classes: DataFrame, k: int) -> DataFrame:
    """``classes`` with ``root``, one fingerprint of their component."""
    linked = components(links(classes, k), "a", "b")
    return classes.join(linked, classes.fp == linked.node, "left").select(
        *classes.columns, F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, k: int = 2) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``:
    ``component_id`` is the smallest doc_id reachable by links of at most
    ``k`` differing bits."""
    prints = reliable_checkpoint(fingerprints(docs, shingle).select("doc_id", "fp"))
    classes = reliable_checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = _rooted(classes, k)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, k: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does:
    the one of least doc_id (a null comes last), of rows that repeat it the
    one of least text hash. Of rows equal in doc_id and text any one stays."""
    # the key names a row up to equal texts, which share a component
    key = fresh(docs.columns, "row_id", "hash_a", "hash_b")
    least = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash_a", "hash_b")
    classes = reliable_checkpoint(fingerprints(docs, shingle).groupBy("fp").agg(F.min(least).alias("least")))
    stay = _rooted(classes, k).groupBy("root").agg(F.min("least").alias("m")).select(
        *(F.col(f"m.{c}").alias(f"stay_{c}") for c in ("doc_id", "hash_a", "hash_b")))
    one = docs.select("*", *row_key(*key)).dropDuplicates(key)
    return one.join(stay, one[key[0]].eqNullSafe(stay.stay_doc_id) & (one[key[1]] == stay.stay_hash_a)
                    & (one[key[2]] == stay.stay_hash_b), "left_semi").select(*docs.columns)
