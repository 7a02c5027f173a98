"""Packing by minimum bin slack.

Documents are token sequences, closed by an end token, that are packed
into windows of ``capacity`` tokens:

* A document longer than a window is cut at multiples of the capacity, so
  its full windows waste nothing; what is left of it (or a shorter
  document) stays whole.
* The pieces are dealt into shards of about ``SHARD_PIECES``. A shard is a
  multiset of lengths. The longest piece left opens a window; among all
  multisets of the other lengths the one is taken that leaves the least
  slack: a dynamic program over subset sums, whose states are the bits of
  one integer, adds the lengths from the longest down (a length that occurs
  c times in binary portions of c) and ends as soon as the capacity itself
  is reached. Going back through the states gives how often each length is
  used. The same window is closed as often as the counts allow.
* Pieces of one length are interchangeable and taken in order.

The texts are encoded once, in the tasks that read them, by the tokenizers
library: a task keeps the ids of the words it has met, and new words go to
the library many at a time. Only pieces (five numbers) are checkpointed,
counted and shuffled. Equal pieces (a document repeated row by row) are
counted and made again in blocks, so that they are dealt like others: a
shard's size and memory don't grow with the input.

Defined results: a null or empty text is the end token alone; a null doc_id
is packed like any other; rows that repeat a doc_id are documents of their
own; the special tokens' strings in a text are their ids, as in the
library; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.bpe import SPACE
from churnkit.llm.common import slices
from churnkit.session import reliable_checkpoint

CAPACITY = 2048
END_TOKEN = 1
TOKENIZER = "word_bpe_49k.json"
SHARD_PIECES = 4000
COPIES = 1000
SLICE_BYTES = 8 << 20
WORDS_KEPT = 1_200_000
WORDS_AT_ONCE = 1000
PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
CLOSING = ".,!?;:"


def tokenizer_path(name: str) -> str:
    """A file name of the public tokenizers, or a path, on this machine."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds:
    """Token ids of texts, word by word.

    The tokenizer cuts at white space before anything else, so a text's ids
    are its words' one after the other. New words are joined by a special
    token, whose id tells them apart in the library's answer. ASCII words
    are lower-cased first and closing marks after a letter encoded on their
    own (the tokenizer does both), so that fewer words are new.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.mark, self.mark_id = next((t.content, i) for i, t in self.library.get_added_tokens_decoder().items())
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}  # places of parts: words without case and closing marks
        self.part_ids, self.part_ends = _Grown(), _Grown(np.int64)
        self.part_ends.add(np.zeros(1, np.int64))
        self.words: dict[str, int] = {}
        self.ids, self.ends = _Grown(), _Grown(np.int64)
        self.ends.add(np.zeros(1, np.int64))

    @staticmethod
    def parts(word: str) -> tuple[str, str]:
        """A word's parts; the second may be empty."""
        if "<|" in word:
            return word, ""
        if word.isascii():
            word = word.lower()
        if word[-1:] not in CLOSING:
            return word, ""
        core = word.rstrip(CLOSING)
        return (core, word[len(core):]) if core[-1:].isalpha() else (word, "")

    def _ask(self, parts: list[str]) -> None:
        """Encode new parts. Those with a special token's sign are encoded
        alone, the others joined by one."""
        plain = [p for p in parts if "<|" not in p]
        asked = [plain[at:at + WORDS_AT_ONCE] for at in range(0, len(plain), WORDS_AT_ONCE)]
        for some in [*asked, *([p] for p in parts if "<|" in p)]:
            ids = np.array(self.library.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids, "<u4")
            inside = ids != self.mark_id if len(some) > 1 else np.ones(len(ids), bool)
            cuts = np.flatnonzero(~inside)
            if len(cuts) != len(some) - 1:
                raise ValueError("a word holds the id of the mark between words")
            ends = np.append(cuts - np.arange(len(cuts)), int(inside.sum()))
            self.part_ends.add(len(self.part_ids) + ends)
            self.part_ids.add(ids[inside])
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some))))

    def learn(self, new: list[str]) -> None:
        split = [self.parts(w) for w in new]
        self._ask([p for p in dict.fromkeys(x for s in split for x in s) if p not in self.known])
        get = self.known.__getitem__
        at = np.fromiter((get(x) for s in split for x in s), np.int64, 2 * len(split))
        ids, total = _gathered(self.part_ids.all(), self.part_ends.all(), at)
        self.ends.add(len(self.ids) + total[1::2])
        self.ids.add(ids)
        self.words.update(zip(new, range(len(self.words), len(self.words) + len(new))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (nulls are empty) one after the other,
        and the place where each text's end."""
        if len(self.words) > WORDS_KEPT:
            self.reset()
        texts = pc.fill_null(texts, "")
        if pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py():
            split = pa.array([[w for w in SPACE.split(t) if w] for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = self.words
        self.learn([w for w in words if w not in known])  # the empty word, beside blanks, has no ids
        place = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        ids, total = _gathered(self.ids.all(), self.ends.all(), at)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        return ids, np.concatenate([[0], total])[np.cumsum(counts)]


class _Grown:
    """An array with room to grow."""

    def __init__(self, dtype="<u4"):
        self.room, self.size = np.empty(1 << 16, dtype), 0

    def __len__(self) -> int:
        return self.size

    def add(self, values: np.ndarray) -> None:
        while len(self.room) < self.size + len(values):
            self.room = np.concatenate([self.room, np.empty_like(self.room)])
        self.room[self.size:self.size + len(values)] = values
        self.size += len(values)

    def all(self) -> np.ndarray:
        return self.room[:self.size]


def _gathered(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``at`` of ``flat``, one after the other, and where each ends
    there; row i of ``flat`` is [ends[i], ends[i + 1])."""
    first = ends[at]
    size = ends[at + 1] - first
    total = np.cumsum(size)
    n = int(total[-1]) if len(total) else 0
    return flat[np.arange(n) + np.repeat(first - total + size, size)], total


_LOADED: dict[str, WordIds] = {}


def load(name: str) -> WordIds:
    """The tokenizer of a file, one in each Python process."""
    path = tokenizer_path(name)
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def cut(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_token: int = END_TOKEN,
        with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, start, length,
    ids_crc32 (of the piece's ids as little-endian unsigned 32-bit
    integers), doc_tokens, and with ``with_ids`` the ids themselves."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, ends = words.encode(batch.column(1))
            doc, start, length, crc, tokens, lists = [], [], [], [], [], []
            first = 0
            for row, (doc_id, end) in enumerate(zip(batch.column(0).to_pylist(), ends.tolist())):
                own = np.append(ids[first:end], np.uint32(end_token)).astype("<u4")
                first = end
                for at in range(0, len(own), capacity):
                    piece = own[at:at + capacity]
                    doc.append(doc_id)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    tokens.append(len(own))
                    if with_ids:
                        lists.append(piece.astype(np.int64))
            columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, tokens)]
            names = list(PIECE)
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"{c} long" for c in PIECE) + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def least_slack(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of the available ``lengths`` (rising, each ``counts``
    times) whose sum comes closest to ``room`` without passing it, as
    (length, times)."""
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    sums = 1  # bit s: the sum s can be reached
    steps = []
    at = bisect_left(lengths, room + 1) - 1
    while at >= 0 and not sums & goal:
        length = lengths[at]
        steps.append((length, sums))
        left, portion = min(counts[length], room // length), 1
        while left:
            take = min(portion, left)
            sums |= sums << take * length & mask
            left -= take
            portion *= 2
        at -= 1
    total = sums.bit_length() - 1
    out = []
    for length, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            out.append((length, times))
    return out


def windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Pack ``counts`` (length -> pieces): each window as (length, times),
    and how many windows of that kind in a row."""
    counts = {n: c for n, c in counts.items() if c}
    lengths = sorted(counts)
    if lengths and (lengths[0] <= 0 or lengths[-1] > capacity):
        raise ValueError("lengths must be positive and no longer than a window")
    while lengths:
        first = lengths[-1]
        counts[first] -= 1
        kind = least_slack(lengths, counts, capacity - first)
        counts[first] += 1
        held = {first: 1}
        for length, times in kind:
            held[length] = held.get(length, 0) + times
        repeat = min(counts[length] // times for length, times in held.items())
        for length, times in held.items():
            counts[length] -= repeat * times
            if not counts[length]:
                del counts[length], lengths[bisect_left(lengths, length)]
        yield sorted(held.items(), reverse=True), repeat


def padded(used: int, capacity: int = CAPACITY) -> int:
    """The length of a sequence with padding: none at a power of two."""
    return used if used & (used - 1) == 0 else capacity


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of the given lengths (those of one length are taken in
    order): window, offset in it, and the windows' used lengths."""
    order = np.argsort(lengths, kind="stable")
    values, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
    next_of = dict(zip(values.tolist(), first.tolist()))
    window, offset, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for kind, repeat in windows(dict(zip(values.tolist(), n.tolist())), capacity):
        for _ in range(repeat):
            at = 0
            for length, times in kind:
                for _ in range(times):
                    piece = order[next_of[length]]
                    next_of[length] += 1
                    window[piece], offset[piece] = len(used), at
                    at += length
            used.append(at)
    return window, offset, np.array(used, np.int64)


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``copy`` (0, 1, ...) among equal ones, whatever the
    partitioning: equal pieces are counted and made again in blocks."""
    equal = pieces.groupBy(*PIECE).agg(F.count(F.lit(1)).alias("n"))
    blocks = equal.select(*PIECE, "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("first"))
    return blocks.repartition(*PIECE, "first").select(*PIECE, F.explode(F.sequence(
        F.col("first"), F.least(F.col("n"), F.col("first") + COPIES) - 1)).alias("copy"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_token: int = END_TOKEN,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): the columns of
    ``cut``, sequence_id, offset (within the sequence), sequence_used and
    sequence_length (with padding)."""
    pieces = reliable_checkpoint(cut(docs, tokenizer, capacity, end_token))
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = numbered(pieces).withColumn("shard", F.pmod(F.xxhash64(*PIECE, "copy"), F.lit(shards)).cast("long"))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in (*PIECE, "copy")])
        window, offset, used = place(group.column("length").to_numpy(), capacity)
        shard = group.column("shard").to_numpy()
        return pa.table({
            **{c: group.column(c) for c in PIECE},
            "sequence_id": pa.array(shard * (1 << 32) + window), "offset": pa.array(offset),
            "sequence_used": pa.array(used[window]),
            "sequence_length": pa.array(np.array([padded(u, capacity) for u in used.tolist()], np.int64)[window])})

    schema = ", ".join(f"{c} long" for c in (*PIECE, "sequence_id", "offset", "sequence_used", "sequence_length"))
    return dealt.groupBy("shard").applyInArrow(fill, schema)
