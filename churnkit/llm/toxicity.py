"""Toxicity by a subsequence string kernel, Nyström landmarks and an SVM.

*Kernel.* Two words are compared by the letter triples they share as
subsequences: the tightest occurrence of a triple, of up to ``SPAN``
letters, counts with ``DECAY`` to the power of the letters skipped, so
inserted and missing letters weaken a match without breaking it, and a long
word that repeats a syllable gains nothing by it. Marks between letters are left
out beforehand, a few digits and marks stand for letters (``LOOKALIKE``),
and single letters in a row are read as one word.

*Landmarks.* Strings (words and their first letters) that the labelled
training documents use far more often when toxic, greedily chosen so that
no landmark resembles an earlier one, and some common words of clean
documents. A word is described by its kernel value against every landmark
over the landmark's own; a sentence by the largest values among its words.
How far a match may be weakened differs by landmark: each has a floor, the
value that the words of all but a share ``CHANCE`` of the clean training
documents stay under (whole occurrences apart). Values up to the floor are
chance and count nothing; from there to the whole landmark they are stretched
to ``TRACE`` to 1.
The landmarks' kernel matrix to the power -1/2 (Nyström) maps that to the
feature space of a linear SVM.

*Training.* The labels are given for documents: the SVM is fitted on
sentences, every sentence of a clean document being negative and, of each
toxic document, the highest-scoring one and those that hold a toxic
landmark nearly whole being positive, in ``ROUNDS`` turns. Few labelled insults are
spoiled, so spoiled forms of the toxic landmarks (letters inserted or left
out) that still pass a floor join the positive sentences, and the toxic
documents behind the curve, with the weight ``SPOILED`` together, each landmark by
how much oftener toxic documents hold it whole than clean ones. A
logistic curve over a document's highest sentence gives its score.

The model is fitted on a bounded sample of whole texts (``PER_CLASS``
documents of each class, fewer where they pass ``MAX_BYTES``); every text is
scored whole.

Defined results: a null or empty text has one empty sentence, and so the
score of text without any trace; a null doc_id is scored and counts as not held out;
repeated rows get equal scores; without training rows of both classes
every score is the share of toxic training rows (0 if there are none);
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, in_train, labelled_sample, sigmoid, slices

SPAN, DECAY = 7, 0.8
CLASSES = 32
#: distances of the second letter from the first and of the third from it
GAPS = sorted(((a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)), key=sum)
TRACE, WHOLE, ALIKE = 0.5, 0.9, 0.6
CHANCE, FLOORS, LEVELS = 0.0003, (0.15, 0.9), 400
SPOILED, VARIANTS = 0.25, 24
RATIO = 4  # a toxic landmark's share of toxic texts over its share of clean ones, at least
PER_CLASS, MAX_BYTES = 3000, 16 << 20
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 56, 16
ROUNDS = 4
THRESHOLD = 0.3
SLICE_BYTES = 8 << 20
CACHE = 1 << 19
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i"}

_SENTENCE = re.compile(rb"(?<=[.!?])[ \t]+|\n+")
_SPACED = re.compile(rb"(?<![^\s])(?:[A-Za-z][ .\-_*]){2,}[A-Za-z](?![^\s.,;:!?])")


def _class_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[ord("a"):ord("z") + 1] = np.arange(1, 27)
    for mark, letter in LOOKALIKE.items():
        t[ord(mark)] = ord(letter) - 96
    t[0x80:0xC0] = 27 + np.arange(0x40) % 5  # the second byte tells accented letters apart
    return t


TABLE = _class_table()


def letters(word: bytes) -> bytes:
    """A word as letter classes; marks at its ends stand for nothing."""
    w = word.strip(b"!?.,;:()[]{}\"'*#$%&@|-_0123456789")
    return bytes(c for c in TABLE[np.frombuffer(w, np.uint8)].tolist() if c)


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The letter classes of all words in a row, and each one's word."""
    stripped = [w.strip(b"!?.,;:()[]{}\"'*#$%&@|-_0123456789") for w in words]
    codes = TABLE[np.frombuffer(b"".join(stripped), np.uint8)]
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, stripped), np.int64, len(words)))
    keep = codes > 0
    return codes[keep].astype(np.int64), owner[keep]


def triples(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(triple code, word) of every subsequence of three letters of a word
    within SPAN, with its weight, one gap pattern at a time, the heaviest
    first."""
    for first, second in GAPS:
        reach = first + second
        if len(codes) <= reach:
            continue
        n = len(codes) - reach
        inside = owner[:n] == owner[reach:]
        code = (codes[:n] * CLASSES + codes[first:first + n]) * CLASSES + codes[reach:]
        yield code[inside], owner[:n][inside], DECAY ** (reach - 2)


class Landmarks:
    """Kernel values of words against fixed strings of letter classes."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        codes = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(strings)), [len(s) for s in strings])
        found = list(triples(codes, owner))
        all_codes = np.concatenate([c for c, _, _ in found]) if found else np.empty(0, np.int64)
        ids = np.unique(all_codes)
        self.slot = np.full(CLASSES ** 3, -1, np.int32)
        self.slot[ids] = np.arange(len(ids))
        self.weights = np.zeros((len(ids), len(strings)), np.float32)
        for code, own, weight in found:
            np.maximum.at(self.weights, (self.slot[code], own), weight)
        self.gram = self.weights.T.astype(float) @ self.weights.astype(float)
        self.scaled = (self.weights / np.maximum(np.diag(self.gram), 1e-9)).astype(np.float32)
        self.floors = np.full(len(strings), TRACE, np.float32)

    def learn_floors(self, texts: list[bytes]) -> None:
        """The floors by clean ``texts``: per landmark the least value that
        at most CHANCE of the texts, counted once a word, pass."""
        held = Counter(w for t in texts for w in set(t.lower().split()))
        words = list(held)
        met = np.zeros((len(self.strings), LEVELS + 1))
        for i in range(0, len(words), 1 << 13):
            part = words[i:i + (1 << 13)]
            x = self.values(part)
            word, mark = np.nonzero(x > 0)
            value = x[word, mark]
            short = value < WHOLE + 0.05
            times = np.array([held[w] for w in part])[word[short]]
            np.add.at(met, (mark[short], (value[short] * LEVELS).astype(np.int64)), times)
        beyond = np.cumsum(met[:, ::-1], axis=1)[:, ::-1]  # met at this level or a higher one
        level = (beyond > CHANCE * len(texts)).sum(axis=1)
        self.floors = np.clip(level / LEVELS, *FLOORS).astype(np.float32)

    def calibrated(self, words: list[bytes]) -> np.ndarray:
        """The values, those up to the floor as 0, the rest from TRACE on."""
        return self._calibrated(self.values(words))

    def _calibrated(self, x: np.ndarray) -> np.ndarray:
        return np.where(x > self.floors, TRACE + (1 - TRACE) * (x - self.floors) / (1 - self.floors), 0)

    def values(self, words: list[bytes]) -> np.ndarray:
        """(words, landmarks): kernel over the landmark's own value."""
        return self._values(*_flat(words), len(words))

    def _values(self, codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.strings)), np.float32)
        rows, slots, weights = [], [], []
        for code, own, weight in triples(codes, owner):
            slot = self.slot[code]
            hit = slot >= 0
            rows.append(own[hit])
            slots.append(slot[hit])
            weights.append(np.full(int(hit.sum()), weight, np.float32))
        if rows:
            row, slot, weight = np.concatenate(rows), np.concatenate(slots), np.concatenate(weights)
            key = row * len(self.weights) + slot
            order = np.argsort(key, kind="stable")  # heaviest first among equals
            order = order[np.r_[True, key[order][1:] != key[order][:-1]]] if len(order) else order
            row, slot, weight = row[order], slot[order], weight[order]
            for i in range(0, len(row), 1 << 17):
                r = row[i:i + (1 << 17)]
                part = self.scaled[slot[i:i + (1 << 17)]] * weight[i:i + (1 << 17), None]
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                out[r[first]] += np.add.reduceat(part, first, axis=0)
        return out

    def spoiled(self, n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Spoiled forms of the first ``n`` landmarks that still pass a floor
        (VARIANTS tries each): calibrated values, and the landmark. One to
        three letters are inserted, or one is left out."""
        rng = np.random.default_rng(seed)
        words, mark = [], []
        for k, string in enumerate(self.strings[:n]):
            for v in range(VARIANTS):
                codes = list(string)
                if v % 4:
                    for at in sorted(rng.integers(1, max(len(codes), 2), v % 4).tolist(), reverse=True):
                        codes.insert(at, int(rng.integers(1, 27)))
                elif len(codes) > 4:
                    del codes[int(rng.integers(1, len(codes) - 1))]
                words.append(codes)
                mark.append(k)
        codes = np.array([c for w in words for c in w], np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        x = self._calibrated(self._values(codes, owner, len(words)))
        hit = x.any(axis=1)
        return x[hit], np.array(mark, np.int64)[hit]


def sentences(text: bytes) -> list[bytes]:
    return _SENTENCE.split(text)


def sentence_words(sentence: bytes) -> list[bytes]:
    """Lower-cased words, and each row of single letters as one more."""
    words = sentence.lower().split()
    return words + [re.sub(rb"[^a-z]", b"", m.lower()) for m in _SPACED.findall(sentence)]


class Traces:
    """Per word its calibrated kernel values if one passes its floor, through
    a cache."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks, self.ids = landmarks, {}
        self.rows: list[np.ndarray] = []

    def learn(self, words: set[bytes]) -> None:
        if len(self.ids) > CACHE:
            self.ids, self.rows = {}, []
        new = [w for w in words if w not in self.ids]
        for i in range(0, len(new), 1 << 14):
            part = new[i:i + (1 << 14)]
            x = self.landmarks.calibrated(part)
            hit = x.any(axis=1)
            base = len(self.rows)
            at = np.where(hit, base + np.cumsum(hit) - 1, -1).tolist()
            self.ids.update(zip(part, at))
            self.rows.extend(x[hit])

    def documents(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each text the vectors of its sentences with a trace, after
        one zero row if it has a sentence without."""
        out, m = [], len(self.landmarks.strings)
        words = [t.lower().split() for t in texts]
        spaced = [[re.sub(rb"[^a-z]", b"", x.lower()) for x in _SPACED.findall(t)] for t in texts]
        self.learn(set().union(*words, *spaced))
        get = self.ids.__getitem__
        for text, own, extra in zip(texts, words, spaced):
            if max(map(get, own), default=-1) < 0 and max(map(get, extra), default=-1) < 0:
                out.append(np.zeros((1, m), np.float32))
                continue
            vectors, blank = [], False
            for s in sentences(text):
                hits = [k for k in map(get, (w for w in sentence_words(s) if w in self.ids)) if k >= 0]
                if hits:
                    vectors.append(np.max([self.rows[k] for k in hits], axis=0))
                else:
                    blank = True
            if blank or not vectors:
                vectors.insert(0, np.zeros(m, np.float32))
            out.append(np.array(vectors, np.float32))
        return out


def _triple_weights(string: bytes) -> dict[int, float]:
    """The triples of one string of letter classes, with their weights."""
    codes = np.frombuffer(string, np.uint8).astype(np.int64)
    out: dict[int, float] = {}
    for code, _, weight in triples(codes, np.zeros(len(codes), np.int64)):
        for t in code.tolist():
            out.setdefault(t, weight)
    return out


def choose_landmarks(texts: list[bytes], y: np.ndarray) -> list[bytes]:
    """Strings over-represented in toxic texts (log-likelihood ratio),
    unlike one another, then common clean words."""
    counts = (Counter(), Counter())
    ids: dict[bytes, int] = {}
    met: tuple[list, list] = ([], [])  # of every text its contexts' hashes and words
    for text, label in zip(texts, y.tolist()):
        words = text.lower().split()
        around = set(zip([b"", *words], words, [*words[1:], b""]))
        met[label].append((np.fromiter(map(hash, around), np.int64, len(around)),
                           np.fromiter((ids.setdefault(w, len(ids)) for _, w, _ in around), np.int32, len(around))))
    strings = []
    for c in map(letters, ids):
        strings.append({c[:12], *(c[:n] for n in (4, 5, 6) if n < len(c))} if len(c) >= 4 else ())
    for label in (0, 1):
        if not met[label]:
            continue
        # a word between the same neighbours is a copy, not evidence: its first text counts
        first = np.sort(np.unique(np.concatenate([h for h, _ in met[label]]), return_index=True)[1])
        word = np.concatenate([w for _, w in met[label]])[first]
        ends = np.searchsorted(first, np.cumsum([len(w) for _, w in met[label]]))
        for own in np.split(word, ends[:-1]):
            counts[label].update(set().union(*(strings[k] for k in set(own.tolist()))))
    del met, ids, strings
    n1, n0 = max(int(y.sum()), 1), max(int((1 - y).sum()), 1)

    def surprise(s: bytes) -> float:
        a, b = counts[1][s], counts[0][s]
        p, p1, p0 = (a + b) / (n1 + n0), a / n1, b / n0
        if p1 <= RATIO * p0 or a < 4:
            return 0.0
        ll = lambda k, n, q: k * np.log(max(q, 1e-12)) + (n - k) * np.log(max(1 - q, 1e-12))
        return float(ll(a, n1, p1) + ll(b, n0, p0) - ll(a, n1, p) - ll(b, n0, p)) * (p1 - p0) / max(p1, 1e-12)

    ranked = sorted(((surprise(s), len(s), s) for s in counts[1]), reverse=True)
    extended: dict[bytes, list[bytes]] = {}
    for x in counts[1]:
        for n in range(4, len(x)):
            extended.setdefault(x[:n], []).append(x)
    chosen: list[bytes] = []
    weights: list[tuple[dict[int, float], float]] = []
    for value, _, s in ranked[:4000]:
        if value < 12 or len(chosen) >= TOXIC_LANDMARKS:
            break
        # the longest string that is met about as often says more
        s = max((x for x in extended.get(s, ()) if counts[1][x] >= 0.8 * counts[1][s]), key=len, default=s)
        own = _triple_weights(s)
        norm = sum(x * x for x in own.values())
        if norm and all(sum(x * other.get(t, 0.0) for t, x in own.items()) < ALIKE * min(norm, size)
                        for other, size in weights):
            chosen.append(s)
            weights.append((own, norm))
    common = [s for s, _ in counts[0].most_common(400) if len(s) >= 5 and surprise(s) == 0]
    return chosen + common[:CLEAN_LANDMARKS]


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 40):
    """Linear SVM (squared hinge, primal, Newton steps on the rows within
    the margin): (w, b)."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    sign, weight = 2.0 * y - 1, weight / weight.sum()
    reg = np.full(x1.shape[1], ridge)
    reg[-1] = 1e-8

    def loss(w):
        return float(weight @ np.maximum(0, 1 - sign * (x1 @ w)) ** 2 + 0.5 * reg @ (w * w))

    w = np.zeros(x1.shape[1])
    now = loss(w)
    for _ in range(steps):
        slack = 1 - sign * (x1 @ w)
        on = slack > 0
        a = x1[on]
        grad = -2 * a.T @ (weight[on] * slack[on] * sign[on]) + reg * w
        hess = 2 * (a * weight[on, None]).T @ a + np.diag(reg)
        step, size = np.linalg.solve(hess, grad), 1.0
        while (new := loss(w - size * step)) > now and size > 1e-4:
            size /= 2
        if now - new < 1e-9 * max(now, 1e-12):
            break
        w, now = w - size * step, new
    return w[:-1], w[-1]


def fit_curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve over one value, by Newton steps with a small ridge."""
    a = np.zeros(2)
    x = np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(50):
        p = sigmoid(x @ a)
        grad = x.T @ (p - y) + 1e-2 * a
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        a = a - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return float(a[0]), float(a[1])


class Model:
    """Landmarks, the SVM over their values, and the score's curve."""

    def __init__(self, texts: list[str], y: np.ndarray, prior: float | None = None):
        self.share = float(y.mean()) if len(y) else 0.0
        self.ready = 0 < y.sum() < len(y)
        if not self.ready:
            return
        raw = [t.encode() for t in texts]
        self.landmarks = Landmarks(choose_landmarks(raw, y))
        self.landmarks.learn_floors([t for t, label in zip(raw, y) if not label])
        traces = Traces(self.landmarks)
        bags = [b for i in range(0, len(raw), 200) for b in traces.documents(raw[i:i + 200])]
        n_toxic = max(len(self.landmarks.strings) - CLEAN_LANDMARKS, 1)
        held_clean, held_toxic = (sum((b[:, :n_toxic] >= WHOLE).any(axis=0) for b, t in zip(bags, y) if t == label)
                                  / (y == label).sum() for label in (0, 1))
        scale = np.sqrt(np.maximum(np.diag(self.landmarks.gram), 1e-9))
        values, vectors = np.linalg.eigh(self.landmarks.gram / scale / scale[:, None])
        self.root = (vectors / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
        # sentences repeat: one row with its weight for each distinct vector
        raw_clean, times = np.unique(np.vstack([b for b, t in zip(bags, y) if not t]), axis=0, return_counts=True)
        clean = raw_clean @ self.root
        toxic = [b @ self.root for b, t in zip(bags, y) if t and b.any()]
        # only a share of the sample's documents is toxic in the corpus
        weight_of = np.where(y == 1, (prior or self.share) / max(self.share, 1e-9),
                             (1 - (prior or self.share)) / max(1 - self.share, 1e-9))
        # positive sentences: in each toxic document the highest-scoring one
        # (at first the nearest to the toxic landmarks) and every one that
        # holds a toxic landmark nearly whole
        holds = [(b[:, :n_toxic] >= WHOLE).any(axis=1) for b, t in zip(bags, y) if t and b.any()]
        spoiled, mark = self.landmarks.spoiled(n_toxic)
        trust = np.maximum(held_toxic - held_clean, 0)[mark] / np.maximum(np.bincount(mark, minlength=n_toxic), 1)[mark]
        trust = SPOILED * trust / max(trust.sum(), 1e-9)
        w, b = np.linalg.solve(self.root, (np.arange(len(self.root)) < n_toxic).astype(float)), 0.0
        share = prior or self.share
        for _ in range(ROUNDS):
            if not toxic:
                break
            witness = np.vstack([m[h | (np.arange(len(m)) == np.argmax(m @ w))] for m, h in zip(toxic, holds)])
            x = np.vstack([clean, witness, spoiled @ self.root])
            t = np.r_[np.zeros(len(clean)), np.ones(len(witness) + len(spoiled))]
            # weighed as documents are in the corpus: a clean sentence for its document, a witness for its own
            w, b = fit_svm(x, t, np.r_[times * ((1 - share) / (y == 0).sum()),
                                       np.full(len(witness), share / len(witness)), trust * share])
        self.weights = self.root @ w
        self.bias = float(b)
        z = np.array([self._highest(v) for v in bags])
        keep = np.repeat(np.arange(len(y)), np.maximum(np.rint(weight_of * 4), 1).astype(int))
        more = np.repeat(spoiled @ self.weights + self.bias, np.rint(trust * y[keep].sum()).astype(int))
        self.curve = fit_curve(np.r_[z[keep], more], np.r_[y[keep], np.ones(len(more))])

    def _highest(self, vectors: np.ndarray) -> float:
        return float((vectors @ self.weights).max()) + self.bias

    def scores(self, texts: list[bytes], traces: Traces | None = None) -> np.ndarray:
        if not self.ready:
            return np.full(len(texts), self.share)
        traces = traces or Traces(self.landmarks)
        z = np.array([self._highest(v) for v in traces.documents(texts)])
        return sigmoid(self.curve[0] * z + self.curve[1])


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on the labelled rows whose CRC-32 remainder by 4 is not 2."""
    train = in_train(4, 2)
    texts, y = labelled_sample(documents, labels, "toxic", train, per_class, max_bytes)
    prior = labels.where(train("doc_id")).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return Model(texts, y, prior)


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        traces = Traces(model.landmarks) if model.ready else None
        for batch in slices(batches, "text", SLICE_BYTES):
            s = model.scores(byte_texts(batch.column(1)), traces)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.astype(float))], names=["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(~in_train(4, 2)("doc_id"), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, whose score is below the
    threshold."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        traces = Traces(model.landmarks) if model.ready else None
        for batch in slices(batches, "text", SLICE_BYTES):
            s = model.scores(byte_texts(batch.column(batch.schema.get_field_index("text"))), traces)
            yield batch.filter(pa.array(s < threshold))

    return documents.mapInArrow(emit, documents.schema)
