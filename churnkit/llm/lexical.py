"""Ranked lexical search with hashed max-sketches.

Every document is ranked for every item of a query set by a sum of
weighted term impacts. A term is a maximal run of ASCII letters, digits
and characters beyond ASCII; only A-Z are lower-cased. With N documents
that hold a term, L terms in all, n terms in the document, df documents
that hold the term and tf its occurrences in the document:

* weight    w = floor(1000 ln((2 N + 2) / (2 df + 1)))
* length    m = 50 + (50 n N) div L
* impact    (10^9 tf) div (1000 tf + 20 m)
* score     sum of w * impact over the item's terms, once each

A first pass over the texts counts N, L and the df of the items' terms. The
second scores:

* *sketch*: the impacts of all the document's terms fold into ``WIDTH``
  coordinates chosen by a hash of the term; a coordinate keeps the largest.
* *bound*: an item's terms look up their coordinates. The weighted sum,
  for a slice of documents and all items one matrix product, is never below
  the score, as each coordinate is at least the term's own impact.
* *exact rescoring*: an item's documents are scored in order of falling
  bound, a chunk at a time, until the bound is below the score of the k-th
  best so far (equal bounds are still scored: ties go to the least doc_id).

A task keeps k documents for each item, so k rows an item and task are
shuffled for the last ranking. Items are taken in blocks of about
``BLOCK`` (chosen by a hash of item_id), each with its own two passes, so
that what a task holds of the query set is bounded; nothing of the
documents reaches the driver but N, L and the block's df.

Defined results: a null or empty text has no terms and is never returned; a
null doc_id is ranked like any other and comes after others of its score;
rows that repeat a doc_id are documents of their own; rows that share an
item_id (null too) are one item that has the terms of all; an item without
terms, or an empty table, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, slices

WIDTH = 2048
TOP = 50
BLOCK = 512
CHUNK = 128
SLICE_BYTES = 8 << 20
SLICE_ROWS = 4096
#: N and L among the counts by term
N_DOCS, N_TERMS = -1, -2
SCHEMA = "item_id long, rank int, doc_id long, score long"


def _letters() -> bytes:
    """Each byte's letter: ASCII letters in lower case, digits and bytes of
    longer characters as they are, all others a blank."""
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(out)


LETTERS = _letters()


def terms(text: str | None) -> list[str]:
    """The terms of a text, in order."""
    return (text or "").encode().translate(LETTERS).decode().split(" ") if text else []


class Counted:
    """The terms of a slice of texts: distinct ``words``, the number of
    terms ``n`` of each document, and for each distinct term of a document
    its row ``doc``, its word ``code`` and its occurrences ``tf``."""

    def __init__(self, texts: list[bytes]):
        clean = pa.array([t.translate(LETTERS).strip() for t in texts], pa.large_binary()).cast(pa.large_string())
        split = pc.ascii_split_whitespace(clean)
        coded = split.flatten().dictionary_encode()
        self.words: list[str] = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        some = pc.binary_length(clean).to_numpy(zero_copy_only=False) > 0  # an empty text is split into one empty word
        doc = np.repeat(np.arange(len(texts)), sizes)
        keep = np.repeat(some, sizes)
        self.n = np.where(some, sizes, 0)
        keys, self.tf = np.unique(doc[keep] * max(len(self.words), 1) + codes[keep], return_counts=True)
        self.doc, self.code = keys // max(len(self.words), 1), keys % max(len(self.words), 1)

    def of(self, vocabulary: dict[str, int]) -> np.ndarray:
        """The place of each distinct word in ``vocabulary``, -1 if none."""
        get = vocabulary.get
        return np.fromiter((get(w, -1) for w in self.words), np.int64, len(self.words))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def statistics(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term of ``vocabulary``, over all ``docs``."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs_with, total = np.zeros(size, np.int64), 0, 0
        for batch in _cut(batches):
            seen = Counted(byte_texts(batch.column(0)))
            at = seen.of(vocabulary)[seen.code] if len(seen.code) else seen.code
            df += np.bincount(at[at >= 0], minlength=size)
            docs_with += int((seen.n > 0).sum())
            total += int(seen.n.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.array([N_DOCS, N_TERMS, *held.tolist()], pa.int64()),
            pa.array([docs_with, total, *df[held].tolist()], pa.int64())], names=["term", "n"])

    # at most one row for each term of the block and two more
    counts = dict(docs.select("text").mapInArrow(count, "term long, n long")
                  .groupBy("term").agg(F.sum("n")).toArrow().to_pandas().itertuples(index=False, name=None))
    df = np.zeros(size, np.int64)
    for term, n in counts.items():
        if term >= 0:
            df[term] = n
    return int(counts.get(N_DOCS, 0)), int(counts.get(N_TERMS, 0)), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The k best documents of one item: score falling, then doc_id rising
    (a null one last)."""

    def __init__(self, k: int):
        self.k, self.threshold = k, 1
        self.score, self.doc, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.threshold
        if not good.any():
            return
        score, doc, null = (np.concatenate([old, new[good]]) for old, new in
                            ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        if len(order) == self.k:
            self.threshold = int(self.score[-1])


def _rank_task(items: list[tuple], vocabulary: dict[str, int], weight: np.ndarray, n_docs: int, n_terms: int,
               k: int, width: int):
    """The function of one scoring task: ``items`` are (item_id, places of
    its terms in the vocabulary)."""
    words = list(vocabulary)
    at = np.array([zlib.crc32(w.encode()) % width for w in words], np.int64)
    columns, back = np.unique(at, return_inverse=True)
    lookup = np.zeros((len(columns), len(items)))  # doubles hold these sums exactly (below 2^53)
    for j, (_, places) in enumerate(items):
        np.add.at(lookup[:, j], back[places], weight[places])
    size = len(words)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for batch in _cut(batches):
            seen = Counted(byte_texts(batch.column(1)))
            if not len(seen.code):
                continue
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc_id = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            m = 50 + (50 * seen.n * n_docs) // n_terms
            impact = (1_000_000_000 * seen.tf) // (1000 * seen.tf + 20 * m[seen.doc])
            place = np.fromiter((zlib.crc32(w.encode()) % width for w in seen.words), np.int64, len(seen.words))
            sketch = np.zeros((len(seen.n), width), np.int64)
            np.maximum.at(sketch, (seen.doc, place[seen.code]), impact)
            bound = sketch[:, columns].astype(np.float64) @ lookup
            of = seen.of(vocabulary)[seen.code]
            mine = of >= 0
            key, value = seen.doc[mine] * size + of[mine], impact[mine]
            order = np.argsort(key)
            key, value = np.append(key[order], np.int64(-1)), np.append(value[order], 0)
            for j, (_, places) in enumerate(items):
                rows = np.flatnonzero(bound[:, j] >= best[j].threshold)
                rows = rows[np.argsort(-bound[rows, j], kind="stable")]
                for first in range(0, len(rows), CHUNK):
                    chunk = rows[first:first + CHUNK]
                    if bound[chunk[0], j] < best[j].threshold:
                        break
                    wanted = chunk[:, None] * size + places[None, :]
                    found = np.searchsorted(key[:-1], wanted)
                    score = np.where(key[found] == wanted, value[found] * weight[places][None, :], 0).sum(axis=1)
                    best[j].add(score, doc_id[chunk], null[chunk])
        held = [(item, b) for (item, _), b in zip(items, best) if len(b.score)]
        if held:
            yield pa.RecordBatch.from_arrays([
                pa.array([item for item, b in held for _ in b.score], pa.int64()),
                pa.array(np.concatenate([b.doc for _, b in held]), mask=np.concatenate([b.null for _, b in held])),
                pa.array(np.concatenate([b.score for _, b in held]))], names=["item_id", "doc_id", "score"])

    return task


def _search_block(docs: DataFrame, block: DataFrame, k: int, width: int) -> DataFrame | None:
    """The k best documents of each item of a bounded ``block``."""
    held: dict[int | None, set[str]] = {}
    for item, text in block.collect():
        held.setdefault(item, set()).update(w for w in terms(text) if w)
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*held.values())))} if held else {}
    if not vocabulary:
        return None
    n_docs, n_terms, df = statistics(docs, vocabulary)
    if not n_terms:
        return None
    items = [(item, np.array(sorted(vocabulary[w] for w in words), np.int64)) for item, words in held.items() if words]
    task = _rank_task(items, vocabulary, weights(n_docs, df), n_docs, n_terms, k, width)
    return docs.mapInArrow(task, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """The ``k`` documents of ``docs`` (doc_id, text) that score highest for
    each row of ``items`` (item_id, text): item_id, rank (1, 2, ...),
    doc_id, score."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = items.select(F.col("item_id").cast("long"), "text")
    blocks = -(-items.count() // block)
    found = None
    for b in range(blocks):
        part = _search_block(docs, items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k, width)
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
