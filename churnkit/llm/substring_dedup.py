"""Substring dedup by prefix-partitioned suffix trees over words.

Every word of a document starts a suffix; only a tree node at depth
``window`` words or more is a repeat, so a suffix is represented by its
first ``window`` words. The suffixes are split by variable-length
prefixes: a prefix runs from the suffix's start to the end of its *lead
phrase*, the ``LEAD``-word phrase of least hash that ends within the
window, so it is ``LEAD`` to ``window`` words long and equal suffixes have
equal prefixes. Consecutive suffixes mostly share their lead phrase, so
they travel as one branch: phrase hash, document, start and one
fingerprint a suffix. Branches go to memory-sized groups by phrase; where
a phrase is crowded (found in a bounded sample) its prefixes are extended
to the whole window, which splits the group further.

A task builds the subtrees of its group in sorted form: suffixes sorted
by (phrase, window fingerprint), equal neighbours being the leaves under
one node of depth ``window``. The earliest leaf stays, all others are
repeats; runs of repeated windows of a document are its maximal repeats.
Before the shuffle a batch settles the repeats it holds itself, so a
passage shared by a third of all documents costs one suffix a batch.

Windows are equal if their phrase hash (64 bits) and their fingerprint
(48 bits) are; for a given phrase, two different windows collide with
probability 2^-48.

Defined results: a null or empty text has no words; a null doc_id comes
after every other; rows that repeat both doc_id and text are one document
listed again (same result in each), rows that repeat a doc_id with
another text come in the order of a 128-bit hash of the text; fewer than
``window`` words are never removed on their own account; other columns
pass through (columns named ``n_words``, ``n_removed`` or ``kept_words``
are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from churnkit.llm.common import U64, byte_texts, fresh, mix, others_of, slices

NO_ID = 2 ** 63 - 1
LEAD = 8
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 2 ** 64)
BATCH_BYTES = 6 << 20
GROUP_CHARS = 10 << 20
SAMPLE_DOCS = 4000
CROWDED = 20


class Words:
    """Word -> 64-bit hash, through small ids so that a batch is one
    table look-up; forgets everything when it grows too large."""

    LIMIT = 1 << 19

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.hashes = np.empty(1 << 12, np.uint64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > self.LIMIT:
            self.ids = {}
        ids = self.ids
        new = [w for w in set(words) if w not in ids]
        at = len(ids)
        ids.update(zip(new, range(at, at + len(new))))
        while len(self.hashes) < len(ids):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        if new:
            self.hashes[at:at + len(new)] = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in new]), ">u8")
        return self.hashes[np.fromiter(map(ids.__getitem__, words), np.int64, len(words))]


class Powers:
    """BASE^i and its inverse modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            step = np.full(size, BASE, U64)
            step[0] = 1
            back = np.full(size, INVERSE, U64)
            back[0] = 1
            self.up, self.down = np.multiply.accumulate(step), np.multiply.accumulate(back)
        return self.up[:n], self.down[:n]


def rolling(hashes: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Hash of every ``length`` consecutive words, by content alone."""
    n = len(hashes)
    up, down = powers.upto(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix((total[length:] - total[:n + 1 - length]) * down[:n + 1 - length])


def least_phrase(phrases: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive phrases the position of the least
    (the leftmost of equals), by doubling minima."""
    x = (phrases & U64(0xFFFFFFFF00000000)) | np.arange(len(phrases), dtype=U64)
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < width:
        x = np.minimum(x[:len(x) - (width - size)], x[width - size:])
    return (x & U64(0xFFFFFFFF)).astype(np.int64)


def suffixes(docs: list[tuple[int, int, np.ndarray]], window: int, powers: Powers):
    """Of documents in their order: for every window its document's index,
    start, phrase hash, phrase position and hash."""
    lengths = np.array([len(h) for *_, h in docs], np.int64)
    words = np.concatenate([h for *_, h in docs]) if docs else np.empty(0, U64)
    if len(words) < window:
        return None
    whole = rolling(words, window, powers)
    phrase = rolling(words, LEAD, powers)
    lead = least_phrase(phrase, window - LEAD + 1)
    doc = np.repeat(np.arange(len(docs)), lengths)
    inside = doc[:len(whole)] == doc[window - 1:]  # windows within one document
    at = np.flatnonzero(inside)
    if not len(at):
        return None
    first = np.cumsum(lengths) - lengths
    return doc[at], at - first[doc[at]], phrase[lead[at]], lead[at], whole[at]


def pack(rows: dict[str, np.ndarray]) -> bytes:
    """Arrays as one compressed blob; the lengths go in front."""
    parts = [np.ascontiguousarray(a).tobytes() for a in rows.values()]
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(blob: bytes, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    ends = np.cumsum(sizes) + 8 * len(kinds)
    return {k: np.frombuffer(raw[e - s:e], kind) for (k, kind), s, e in zip(kinds.items(), sizes, ends)}


#: a row's place among the documents: its doc_id, then two hashes of its text
ROW = ("doc", "tie", "tie2")
#: a branch: document (ROW), start, windows, settled
#: within its batch or not; only open ones have a phrase and, in print,
#: 3 x 16 bits of each window's hash
KINDS = {"doc": "<i8", "tie": "<i8", "tie2": "<i8", "start": "<i4", "size": "<u4", "settled": "u1", "phrase": "<u8",
         "print": "<u2"}


def branches(docs, window: int, powers: Powers, crowded: np.ndarray, groups: int):
    """(group, blob) of a batch of documents in their order."""
    got = suffixes(docs, window, powers)
    if got is None:
        return
    doc, start, phrase, lead, whole = got
    order = np.argsort(whole, kind="stable")
    same = np.zeros(len(whole), bool)
    same[order[1:]] = whole[order[1:]] == whole[order[:-1]]  # not the first of the batch
    packed = crowded[np.minimum(np.searchsorted(crowded, phrase), len(crowded) - 1)] == phrase if len(crowded) \
        else np.zeros(len(phrase), bool)
    group = ((phrase ^ np.where(packed, whole, U64(0))) * U64(BASE) >> U64(33)).astype(np.int64) % groups
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1) | (same[1:] != same[:-1])
    new[1:] |= ~same[1:] & ((lead[1:] != lead[:-1]) | (group[1:] != group[:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(doc)))
    rows = {c: np.array([d[i] for d in docs], np.int64) for i, c in enumerate(ROW)}
    # runs settled here need no group: those of a batch go along with one
    # that the batch, not the passage, decides
    own = int(mix(rows["doc"].view(U64)[:1] ^ rows["tie"].view(U64)[:1] + U64(len(docs)))[0] >> U64(33)) % groups
    to = np.where(same[first], own, group[first])
    by_group = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[by_group])) + 1
    for part in np.split(by_group, cuts):
        f, s = first[part], size[part]
        settled = same[f]
        live, n = f[~settled], s[~settled]
        each = np.repeat(live - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        prints = whole[each].astype("<u8").view("<u2").reshape(-1, 4)[:, 1:]
        yield int(to[part[0]]), pack({
            **{c: v[doc[f]] for c, v in rows.items()}, "start": start[f].astype(np.int32),
            "size": s.astype(np.uint32), "settled": settled.astype(np.uint8),
            "phrase": phrase[live], "print": prints.ravel()})


def repeats_of_group(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """(doc, tie, tie2, start, windows) of the runs of windows in the group
    that start earlier elsewhere."""
    parts = [unpack(b, KINDS) for b in blobs]
    whole = {k: np.concatenate([p[k] for p in parts]) for k in KINDS}
    del parts
    settled = whole["settled"].astype(bool)
    done = [whole[k][settled] for k in (*ROW, "start", "size")]
    live = {k: whole[k][~settled] for k in (*ROW, "start", "size")}
    size = live["size"].astype(np.int64)
    begin = np.cumsum(size) - size
    order = np.lexsort((live["start"], live["tie2"], live["tie"], live["doc"]))  # the documents' order
    live = {k: v[order] for k, v in live.items()}
    size = size[order]
    base = np.cumsum(size) - size
    other = np.zeros(len(order), np.int32)
    for c in ROW:
        other[1:] |= live[c][1:] != live[c][:-1]
    row = np.cumsum(other, dtype=np.int32)  # the rows of the group, numbered
    branch = np.repeat(np.arange(len(order), dtype=np.int32), size)
    step = (np.arange(len(branch)) - base[branch]).astype(np.int32)
    p = whole["print"].reshape(-1, 3)[begin[order][branch] + step].astype(U64)
    fingerprint = (p[:, 0] << U64(32)) | (p[:, 1] << U64(16)) | p[:, 2]
    phrase = whole["phrase"][order][branch]
    del p, whole
    key = mix(phrase + fingerprint * U64(BASE))
    leaves = np.argsort(key, kind="stable")
    del key
    same = (phrase[leaves[1:]] == phrase[leaves[:-1]]) & (fingerprint[leaves[1:]] == fingerprint[leaves[:-1]])
    del phrase, fingerprint
    node = np.concatenate([[0], np.cumsum(~same)])[:len(leaves)]  # leaves under one deep node
    own, start = row[branch], live["start"][branch] + step
    later = np.zeros(len(branch), bool)
    if len(leaves):
        head = leaves[np.searchsorted(node, np.arange(node[-1] + 1))][node]
        later[leaves] = (own[leaves] != own[head]) | (start[leaves] != start[head])
    at = np.flatnonzero(later)
    new = np.ones(len(at), bool)
    new[1:] = (own[at[1:]] != own[at[:-1]]) | (start[at[1:]] != start[at[:-1]] + 1)
    first = np.flatnonzero(new)
    of = branch[at[first]]
    runs = [*(live[c][of] for c in ROW), start[at[first]], np.diff(np.append(first, len(at)))]
    return tuple(np.concatenate([a.astype(np.int64), b.astype(np.int64)]) for a, b in zip(runs, done))


def _hash(seed: int):
    return F.xxhash64(F.lit(seed), F.coalesce(F.col("text"), F.lit("")))


def _key():
    """The columns of ``ROW``: rows that agree in them are repeats of one
    row (128 bits of a text's hash, among rows of one doc_id or of none)."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), _hash(1), _hash(2)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, tie, tie2, text): the order of the documents, and their texts."""
    return docs.select(*(c.alias(n) for c, n in zip(_key(), ROW)), "text")


def _documents(batches: Iterator[pa.RecordBatch], words: Words):
    """Batches of (doc, tie, tie2, word hashes) in the documents' order, each
    once a batch."""
    for batch in slices(batches, "text", BATCH_BYTES):
        doc, tie, tie2 = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3))
        texts = byte_texts(batch.column(3))
        order = np.lexsort((tie2, tie, doc))
        out, last = [], None
        for i in order.tolist():
            if last != (key := (int(doc[i]), int(tie[i]), int(tie2[i]))):
                out.append((*key, words(texts[i].split())))
            last = key
        yield out


def crowded_phrases(docs: DataFrame, window: int, n_docs: int) -> np.ndarray:
    """Phrase hashes that lead in ``CROWDED`` or more of a sample of about
    ``SAMPLE_DOCS`` documents, sorted. The list is bounded by the sample
    and only decides how finely a phrase's suffixes are split."""
    every = max(1, n_docs // SAMPLE_DOCS)

    def emit(batches):
        words, powers = Words(), Powers()
        for docs_ in _documents(batches, words):
            got = suffixes(docs_, window, powers)
            if got is not None:
                pairs = np.unique(np.stack([got[2].view(np.int64), got[0]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[0]))], names=["phrase"])

    sample = _keyed(docs).where(F.pmod(F.xxhash64("doc", "tie"), F.lit(every)) == 0)
    got = (sample.mapInArrow(emit, "phrase long").groupBy("phrase").count()
           .where(F.col("count") >= CROWDED).select("phrase").toArrow())
    return np.sort(np.asarray(got.column("phrase").to_numpy(), dtype=np.int64).view(np.uint64))


def repeat_runs(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc, tie, tie2, start, windows): runs of windows of a document whose
    words also start earlier; each window in one run."""
    if window < LEAD:
        raise ValueError(f"window must be at least {LEAD}")
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    crowded = crowded_phrases(docs, window, size["n"])
    groups = max(8, -(-(size["chars"] or 0) // GROUP_CHARS))

    def split(batches):
        words, powers = Words(), Powers()
        for docs_ in _documents(batches, words):
            rows = list(branches(docs_, window, powers, crowded, groups))
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows], pa.int32()),
                                              pa.array([b for _, b in rows], pa.binary())], names=["part", "blob"])

    def build(group: pa.Table) -> pa.Table:
        found = repeats_of_group(group.column("blob").to_pylist())
        return pa.table([pa.array(x) for x in found], names=[*ROW, "start", "windows"])

    parts = _keyed(docs).mapInArrow(split, "part int, blob binary")
    return parts.groupBy("part").applyInArrow(build, "doc long, tie long, tie2 long, start long, windows long")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``docs`` (doc_id, text, any others) with every word covered by a
    repeated window taken out: every input column, ``text`` replaced by
    the kept words joined by one space where something was removed, plus
    ``n_words``, ``n_removed`` and ``kept_words`` (the kept words joined by
    one space, as bytes)."""
    runs = repeat_runs(docs, window)
    *row, found = fresh(docs.columns, "doc_key", "tie_key", "tie2_key", "spans")
    spans = runs.groupBy(*(F.col(c).alias(n) for c, n in zip(ROW, row))).agg(
        F.collect_list(F.struct("start", "windows")).alias(found))
    others = others_of(docs, "text", "n_words", "n_removed", "kept_words")

    def shrink(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text", BATCH_BYTES):
            at = batch.schema.get_field_index("text")
            col = batch.column(at)
            packed = [None if null else press.compress(t) for t, null in zip(byte_texts(col), col.is_null().to_pylist())]
            arrays = [pa.array(packed, pa.binary()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    def cut(batches):
        for batch in slices(batches, "text", BATCH_BYTES // 3):
            at = {n: i for i, n in enumerate(batch.schema.names)}
            grow = zstandard.ZstdDecompressor()
            spans_col = batch.column(at[found])
            offsets = spans_col.offsets.to_numpy() if len(spans_col) else np.zeros(1, np.int64)
            starts = spans_col.values.field("start").to_numpy()
            counts = spans_col.values.field("windows").to_numpy()
            texts, n_words, n_gone, kept_words = [], [], [], []
            for i, packed in enumerate(batch.column(at["text"]).to_pylist()):
                text = b"" if packed is None else grow.decompress(packed)
                words = text.split()
                s, e = offsets[i], offsets[i + 1]
                kept = words
                if e > s:
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, starts[s:e], 1)
                    np.add.at(depth, starts[s:e] + counts[s:e] + window - 1, -1)
                    stay = np.cumsum(depth[:-1]) == 0
                    kept = [w for w, k in zip(words, stay.tolist()) if k]
                joined = b" ".join(kept)
                kept_words.append(joined)
                texts.append(None if packed is None else text if len(kept) == len(words) else joined)
                n_words.append(len(words))
                n_gone.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(at[c]) for c in others]
                + [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
                   pa.array(n_gone, pa.int64()), pa.array(kept_words, pa.binary())],
                names=[*others, "text", "n_words", "n_removed", "kept_words"])

    keyed = docs.select(*(c.alias(n) for c, n in zip(_key(), row)), *others, "text")
    small = StructType([StructField(f.name, BinaryType() if f.name == "text" else f.dataType) for f in keyed.schema])
    joined = keyed.mapInArrow(shrink, small).join(spans, row, "left").select(*others, "text", found)
    out = StructType([*(StructField(c, docs.schema[c].dataType) for c in others), docs.schema["text"],
                      StructField("n_words", LongType()), StructField("n_removed", LongType()),
                      StructField("kept_words", BinaryType())])
    return joined.mapInArrow(cut, out)
