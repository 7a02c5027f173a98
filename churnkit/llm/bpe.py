"""BPE encoding and decoding: speculate and verify.

Text is cut at white space; a word's tokens don't depend on its
neighbours, so each distinct word of a batch is encoded once and the
documents' ids are gathered from the words' in one numpy step.

New words are encoded by speculation. A greedy longest match proposes
tokens. A proposal is the exact result if and only if each token is the
exact result of its own text and each two adjacent tokens are the exact
result of theirs (they are *compatible*): whatever merge could cross a
boundary would already cross it with these two alone. All adjacent pairs
of all new words are looked up together in a sorted table of known pairs,
and pairs not seen before are tested by merging their two texts exactly.
Only words with a failing pair are merged exactly, rank by rank.

The vocabulary is read from a tokenizer file (JSON with a BPE model, an
end-of-word suffix and the normalisers NFC, white space, lower case); its
path is a parameter and has to exist on every executor.

Defined results: a null or empty text has no tokens; the special tokens'
strings in a text are their ids; repeated rows get equal results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import slices

SLICE_BYTES = 4 << 20
WORDS_KEPT = 600_000
PAIRS_KEPT = 4_000_000
LONG = 48
#: Unicode white space (str.split() takes U+001C to U+001F besides)
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = regex.compile(f"[{BLANKS}]+")
CONTROL = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()


class Tokenizer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError("a plain BPE model is needed")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        v = self.vocab
        self.ranks = {(v[a], v[b]): (r, v[a + b]) for r, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*v.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for s, i in [*v.items(), *self.special.items()]:
            self.tokens[i] = s
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", BLANKS))  # it stands within brackets
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.longest = max(len(s) - (len(self.suffix) if s.endswith(self.suffix) else 0) for s in v)
        self.sound = np.ones(size, bool)  # the exact result of the token's own text is itself
        for s, i in v.items():
            self.sound[i] = self.merge(self.symbols_of(i)) == [i]
        self.words: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.words = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.ends = [0]
        self.pair_keys = np.empty(0, np.int64)
        self.pair_good = np.empty(0, bool)

    # exact merging -------------------------------------------------------
    def symbols(self, piece: str) -> list[int]:
        """A pre-token's symbols: its letters, the last with the suffix."""
        v = self.vocab
        return [*(v[c] for c in piece[:-1]), v[piece[-1] + self.suffix]]

    def symbols_of(self, token: int) -> list[int]:
        s = self.tokens[token]
        if self.suffix and s.endswith(self.suffix) and s != self.suffix:
            return self.symbols(s[:-len(self.suffix)])
        return [self.vocab[c] for c in s] if all(c in self.vocab for c in s) else [token]

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge the pair of least rank (the leftmost of equals) until no
        pair can be merged."""
        out, ranks = list(symbols), self.ranks
        if len(out) > LONG:
            return self._merge_long(out)
        while len(out) > 1:
            best = None
            for i in range(len(out) - 1):
                found = ranks.get((out[i], out[i + 1]))
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], i, found[1])
            if best is None:
                break
            _, i, joined = best
            out[i:i + 2] = [joined]
        return out

    def _merge_long(self, out: list) -> list[int]:
        """The same for a long piece: a heap of pairs over a linked list."""
        n, ranks = len(out), self.ranks
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(found[0], i, out[i], out[i + 1]) for i in range(n - 1) if (found := ranks.get((out[i], out[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if out[i] != a or j < 0 or out[j] != b:
                continue  # one of the two has been merged meanwhile
            out[i], out[j], after[i] = ranks[a, b][1], None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (found := ranks.get((out[x], out[y]))):
                    heapq.heappush(heap, (found[0], x, out[x], out[y]))
        return [t for t in out if t is not None]

    # speculation ---------------------------------------------------------
    def propose(self, piece: str) -> list[int]:
        """Greedy longest match; the last token carries the suffix."""
        v, n, at, out = self.vocab, len(piece), 0, []
        whole = v.get(piece + self.suffix)
        if whole is not None:
            return [whole]
        while at < n:
            rest = n - at
            if rest <= self.longest:
                token = v.get(piece[at:] + self.suffix)
                if token is not None:
                    out.append(token)
                    break
            for size in range(min(rest - 1, self.longest), 0, -1):
                token = v.get(piece[at:at + size])
                if token is not None:
                    break
            out.append(token)
            at += size
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Is each pair of adjacent tokens the exact result of its text?"""
        keys = left.astype(np.int64) * len(self.tokens) + right
        unique, back = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_keys, unique), max(len(self.pair_keys) - 1, 0))
        known = self.pair_keys[at] == unique if len(self.pair_keys) else np.zeros(len(unique), bool)
        new = unique[~known]
        if len(new):
            size = len(self.tokens)
            good = np.array([self.merge(self.symbols_of(a) + self.symbols_of(b)) == [a, b]
                             for a, b in ((int(k) // size, int(k) % size) for k in new)], bool)
            keys_all = np.concatenate([self.pair_keys, new])
            order = np.argsort(keys_all)
            self.pair_good = np.concatenate([self.pair_good, good])[order]
            self.pair_keys = keys_all[order]
            at = np.searchsorted(self.pair_keys, unique)
        return self.pair_good[at][back]

    def pieces(self, word: str) -> list[str | int]:
        """A word's pre-tokens as letters, special tokens as ids."""
        parts = self.special_pattern.split(word) if self.special_pattern and "<" in word else [word]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                text = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
                for m in self.pattern.findall(text.lower()):
                    out.append(m if m.isascii() and m.isprintable() else
                               "".join([LETTERS[b] for b in m.encode("utf-8", "surrogatepass")]))
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words not seen yet."""
        new = [w for w in words if w not in self.words]
        split = [self.pieces(w) for w in new]
        todo = list({p for s in split for p in s if isinstance(p, str)})
        guess = [self.propose(p) for p in todo]
        sizes = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter((t for g in guess for t in g), np.int64, int(sizes.sum()))
        good = np.ones(len(todo), bool)
        if len(flat):
            owner = np.repeat(np.arange(len(todo)), sizes)
            good[owner[~self.sound[flat]]] = False
            inside = owner[1:] == owner[:-1]
            fails = ~self.compatible(flat[:-1][inside], flat[1:][inside])
            good[owner[1:][inside][fails]] = False
        done = {p: g if ok else self.merge(self.symbols(p)) for p, g, ok in zip(todo, guess, good.tolist())}
        ids: list[int] = []
        base = self.ends[-1]
        at = len(self.words)
        for w, s in zip(new, split):
            for p in s:
                if isinstance(p, str):
                    ids += done[p]
                else:
                    ids.append(p)
            self.words[w] = at
            at += 1
            self.ends.append(base + len(ids))
        while len(self.flat) < self.ends[-1]:
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[base:self.ends[-1]] = ids

    def split(self, text: str) -> list[str]:
        return [w for w in SPACE.split(text) if w] if CONTROL.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        if len(self.words) > WORDS_KEPT or len(self.pair_keys) > PAIRS_KEPT:
            self.reset()
        words = [self.split(t) for t in texts]
        self.learn(set().union(*words))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        get = self.words.__getitem__
        at = np.fromiter((k for w in words for k in map(get, w)), np.int64, int(counts.sum()))
        ends = np.asarray(self.ends, np.int64)
        size = ends[at + 1] - ends[at]
        total = np.cumsum(size)
        index = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(ends[at] - (total - size), size)
        ids = self.flat[index]
        cuts = np.concatenate([[0], total])[np.cumsum(counts)]
        return np.split(ids, cuts[:-1]) if len(texts) else []

    def decode(self, ids) -> str:
        """The tokens' strings joined by a space: the file names no
        decoder."""
        return " ".join(map(self.tokens.__getitem__, np.asarray(ids).tolist()))


_LOADED: dict[tuple[str, float], Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, one in each Python process."""
    key = (path, os.path.getmtime(path))
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(path)
    return _LOADED[key]


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens,
    ids_sha256 (of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (of the ids decoded again, UTF-8), and with ``with_ids``
    the ids themselves."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = tokenizer.encode(texts)
            out = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                   pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                   pa.array([hashlib.sha256(tokenizer.decode(x).encode("utf-8", "surrogatepass")).hexdigest()
                             for x in ids], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                out.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        emit, schema + (", ids array<long>" if with_ids else ""))
