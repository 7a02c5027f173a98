"""Quality classifier: a convolutional network over bytes, in numpy.

A text is read as bytes, each embedded by fixed traits (letter case,
digit, blank, marks, high bytes, and three spread coordinates that tell
letters apart). Learned filters look at ``WIDTH`` bytes every ``STRIDE``
bytes. The text is covered whole by chunks of ``CHUNK`` bytes overlapping
by one block of ``BLOCK`` bytes; each chunk keeps its largest response per
filter, and the document keeps the largest, mean and least of its chunks'
responses, which one logistic layer turns into a probability. Filters and
layer are trained together by back-propagation (only the largest response
of a chunk carries gradient), then the probability is calibrated to the
labels' share.

The fit takes a bounded sample of whole texts (``PER_CLASS`` documents of
each class, fewer where they pass ``MAX_BYTES``); every text is scored
whole.

Defined results: a null or empty text is one block of zero bytes; a null
doc_id is scored and counts as not held out; repeated rows get equal scores
(to 0.00001: scores are rounded);
without training rows of both classes every score is the share of good
training rows (0 if there are none); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, in_train, labelled_sample, sigmoid, slices
from churnkit.llm.toxicity import fit_curve

WIDTH, STRIDE = 8, 4
BLOCK, CHUNK = 64, 512
HOP = CHUNK - BLOCK
FILTERS = 24
PER_CLASS, MAX_BYTES = 1500, 8 << 20
FIT_CHUNKS, PART_BLOCKS = 512, 1 << 13
EPOCHS, BATCH, RATE = 6, 48, 4e-3
THRESHOLD = 0.3
SLICE_BYTES = 4 << 20
DIM = 8


def _embedding() -> np.ndarray:
    e = np.zeros((256, DIM), np.float32)
    b = np.arange(256)
    lower, upper = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90)
    e[:, 0] = lower | (b >= 128)
    e[:, 1] = upper
    e[:, 2] = (b >= 48) & (b <= 57)
    e[:, 3] = np.isin(b, (32, 9, 10, 13))
    e[:, 4] = np.isin(b, [ord(c) for c in ".,;:?!'\"-()"])
    other = (b > 32) & (b < 127) & ~lower & ~upper & ~(e[:, 2] > 0) & ~(e[:, 4] > 0)
    e[other, 4], e[other, 5] = 0.5, 1
    letter = lower | upper | (b >= 128)
    e[letter, 6] = np.cos(2.399963 * (b[letter] & 31))
    e[letter, 7] = np.sin(2.399963 * (b[letter] & 31))
    return e


EMBEDDING = _embedding()
PER_BLOCK = BLOCK // STRIDE


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each followed by at least a window's half of
    zeros up to a whole number of blocks; and the blocks of each."""
    blocks = np.array([-(-(len(t) + STRIDE) // BLOCK) if t else 1 for t in texts], np.int64)
    raw = b"".join([t.ljust(int(n) * BLOCK, b"\0") for t, n in zip(texts, blocks)])
    return np.frombuffer(raw, np.uint8), blocks


def _chunks(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last block (exclusive) of every chunk, and its text."""
    hop, size = HOP // BLOCK, CHUNK // BLOCK
    counts = np.maximum(1, -(-(blocks - (size - hop)) // hop))
    owner = np.repeat(np.arange(len(blocks)), counts)
    first = np.cumsum(blocks) - blocks
    nth = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    start = first[owner] + nth * hop
    return start, np.minimum(start + size, (first + blocks)[owner]), owner


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.35, (WIDTH * DIM, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.layer = rng.normal(0, 0.05, 3 * FILTERS)
        self.offset = 0.0
        self.curve = (1.0, 0.0)

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(chunks, filters) largest responses, and each chunk's text."""
        raw, blocks = _padded(texts)
        half, total = STRIDE * DIM, len(raw) // BLOCK
        raw = np.concatenate([raw, np.zeros(STRIDE, np.uint8)])
        ends = np.zeros(total * PER_BLOCK, bool)
        ends[np.cumsum(blocks) * PER_BLOCK - 1] = True
        best = np.empty((total, FILTERS), np.float32)
        for i in range(0, total, PART_BLOCKS):
            j = min(i + PART_BLOCKS, total)
            x = EMBEDDING[raw[i * BLOCK:j * BLOCK + STRIDE]].reshape(-1, half)
            response = x[:-1] @ self.filters[:half] + x[1:] @ self.filters[half:]
            # the last position of a text (zeros alone) would look into the next
            response[ends[i * PER_BLOCK:j * PER_BLOCK]] = -1e9
            best[i:j] = response.reshape(-1, PER_BLOCK, FILTERS).max(axis=1)
        best = np.vstack([best, np.zeros((1, FILTERS), np.float32)])
        start, end, owner = _chunks(blocks)
        pairs = np.stack([start, end], axis=1).ravel()
        return np.maximum(np.maximum.reduceat(best, pairs, axis=0)[::2] + self.bias, 0), owner

    @staticmethod
    def combined(chunk: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        first = np.searchsorted(owner, np.arange(n))
        count = np.bincount(owner, minlength=n)[:, None]
        return np.hstack([np.maximum.reduceat(chunk, first, axis=0), np.add.reduceat(chunk, first, axis=0) / count,
                          np.minimum.reduceat(chunk, first, axis=0)])

    def logits(self, texts: list[bytes]) -> np.ndarray:
        chunk, owner = self.pooled(texts)
        return self.combined(chunk, owner, len(texts)) @ self.layer + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return np.round(sigmoid(self.curve[0] * self.logits(texts) + self.curve[1]), 5) if texts else np.empty(0)

    def train(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        state = [[np.zeros_like(p, dtype=float), np.zeros_like(p, dtype=float)]
                 for p in (self.filters, self.bias, self.layer, np.zeros(1))]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                ids = order[i:i + BATCH]
                grads = self._gradients([texts[k] for k in ids], y[ids])
                step += 1
                rate = RATE * (0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 0.05)
                for k, (g, (m, v)) in enumerate(zip(grads, state)):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    change = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
                    if k == 0:
                        self.filters -= change.astype(np.float32)
                    elif k == 1:
                        self.bias -= change.astype(np.float32)
                    elif k == 2:
                        self.layer -= change
                    else:
                        self.offset -= float(change[0])

    def _gradients(self, texts: list[bytes], y: np.ndarray):
        raw, blocks = _padded(texts)
        raw = np.concatenate([raw, np.zeros(CHUNK + WIDTH, np.uint8)])
        start, end, owner = _chunks(blocks)
        n, m = len(texts), len(start)
        positions, half = CHUNK // STRIDE, STRIDE * DIM
        inside = (end - start) * PER_BLOCK - np.isin(end, np.cumsum(blocks))
        arg, top = np.empty((m, FILTERS), np.int64), np.empty((m, FILTERS), np.float32)
        for i in range(0, m, FIT_CHUNKS):  # a long text's chunks, a part at a time
            part = slice(i, i + FIT_CHUNKS)
            at = start[part, None] * BLOCK + np.arange(CHUNK + STRIDE)
            x = EMBEDDING[raw[at]].reshape(len(at), positions + 1, half)
            response = x[:, :-1] @ self.filters[:half] + x[:, 1:] @ self.filters[half:]
            response[np.arange(positions)[None, :] >= inside[part, None]] = -1e9
            arg[part] = response.argmax(axis=1)
            top[part] = np.take_along_axis(response, arg[part][:, None, :], axis=1)[:, 0] + self.bias
        chunk = np.maximum(top, 0)
        features = self.combined(chunk, owner, n)
        delta = (sigmoid(features @ self.layer + self.offset) - y) / n
        g_layer = features.T @ delta + 1e-4 * self.layer
        hi, mean, lo = (delta[:, None] * self.layer[k * FILTERS:(k + 1) * FILTERS] for k in range(3))
        first, count = np.searchsorted(owner, np.arange(n)), np.bincount(owner, minlength=n)[:, None]
        f_hi, f_lo = features[:, :FILTERS], features[:, 2 * FILTERS:]
        is_hi, is_lo = chunk == f_hi[owner], chunk == f_lo[owner]
        share = lambda hit: hit / np.maximum(np.add.reduceat(hit.astype(float), first, axis=0), 1)[owner]
        g = hi[owner] * share(is_hi) + (mean / count)[owner] + lo[owner] * share(is_lo)
        g = (g * (top > 0)).astype(np.float32)
        where = start[:, None] * BLOCK + arg * STRIDE  # (chunks, filters) byte positions
        g_filters = 1e-5 * self.filters
        for i in range(0, m, FIT_CHUNKS):
            part = slice(i, i + FIT_CHUNKS)
            windows = EMBEDDING[raw[where[part, :, None] + np.arange(WIDTH)]].reshape(-1, FILTERS, WIDTH * DIM)
            g_filters = g_filters + np.einsum("mf,mfd->df", g[part], windows)
        return g_filters, g.sum(axis=0), g_layer, np.array([delta.sum()])


class Model:
    """A trained network, or the labels' share where nothing can be learnt."""

    def __init__(self, texts: list[str], y: np.ndarray, prior: float | None = None):
        self.share = float(y.mean()) if len(y) else 0.0
        self.ready = 0 < y.sum() < len(y)
        if not self.ready:
            return
        prior = self.share if prior is None else prior
        raw = [t.encode() for t in texts]
        self.network = Network()
        self.network.train(raw, y)
        z = np.concatenate([self.network.logits(raw[i:i + 256]) for i in range(0, len(raw), 256)])
        weight = np.where(y == 1, prior / self.share, (1 - prior) / (1 - self.share))
        keep = np.repeat(np.arange(len(y)), np.maximum(np.rint(weight * 4), 1).astype(int))
        self.network.curve = fit_curve(z[keep], y[keep])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.network.scores(texts) if self.ready else np.full(len(texts), self.share)


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on the labelled rows whose CRC-32 remainder by 5 is not 0."""
    train = in_train(5, 0)
    texts, y = labelled_sample(documents, labels, "quality", train, per_class, max_bytes)
    prior = labels.where(train("doc_id")).agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return Model(texts, y, prior)


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            s = model.scores(byte_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.astype(float))], names=["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(~in_train(5, 0)("doc_id"), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))
