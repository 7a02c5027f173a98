"""Embedding near-dedup by an epsilon grid order join.

Vectors of one label link if their cosine reaches the threshold, that is
if their unit vectors lie within ``eps = sqrt(2 - 2 * threshold)``. Equal
vectors form a class first. The classes are rotated onto the principal
directions of all vectors and sorted by label and by the grid cells (of
width eps) of the leading ``GRID`` directions: the epsilon grid order. The
sequence is cut into blocks of at most ``BLOCK`` vectors; two blocks are
joined unless their boxes in the leading ``BOX`` directions are provably
farther apart than eps, and inside a pair of blocks the two intervals are
halved and skipped in the same way until ``LEAF`` vectors are left, whose
cosines are computed in double precision from the unrotated vectors.

A pair of blocks returns, per class, the number of vectors linked, and
the links themselves as a spanning forest: nothing grows with the number
of pairs. Components are found by contraction.

Defined results: a vector that is null, zero, empty or holds a null or
non-finite component, or whose label is null, links with nothing; vectors
of different lengths don't link; rows that repeat a vec_id are vectors of
their own; a null vec_id takes part but never names a component that has
another vector; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import components
from churnkit.llm.simhash import forest
from churnkit.session import reliable_checkpoint

GRID, BOX = 4, 8
BLOCK, LEAF = 1024, 256
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps tiny and huge vectors in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v): the vectors that can link, as the bytes of
    their doubles."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, blobs = [], [], []
            for i, (v, label) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if label is None or not v or None in v:
                    continue
                a = np.asarray(v, np.float64)
                if np.isfinite(a).all() and a.any():
                    rows.append(i)
                    dims.append(len(a))
                    blobs.append((a + 0.0).tobytes())  # -0.0 and 0.0 are equal
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at),
                                              pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())],
                                             names=["vec_id", "label", "dim", "v"])
    return vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string")).mapInArrow(
        emit, "vec_id long, label string, dim int, v binary")


def principal_directions(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the directions of falling variance, as columns.
    A task sends the sums of its products, one row per entry."""
    def emit(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column(0).to_numpy())
            blobs = batch.column(1).to_pylist()
            for d in np.unique(dims).tolist():
                x = _unit(np.stack([np.frombuffer(blobs[i]) for i in np.flatnonzero(dims == d)]))
                x = np.hstack([x, np.ones((len(x), 1))])
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size)), pa.array(s.ravel())],
                names=["dim", "entry", "total"])

    rows = (classes.select("dim", "v").mapInArrow(emit, "dim int, entry long, total double")
            .groupBy("dim", "entry").agg(F.sum("total").alias("total")).toArrow())
    dim, entry, total = (rows.column(i).to_numpy() for i in range(3))
    out = {}
    for d in np.unique(dim).tolist():
        s = np.zeros((d + 1) ** 2)
        s[entry[dim == d]] = total[dim == d]
        s = s.reshape(d + 1, d + 1)
        mean = s[:d, d] / s[d, d]
        values, directions = np.linalg.eigh(s[:d, :d] / s[d, d] - np.outer(mean, mean))
        out[d] = directions[:, np.argsort(-values)]
    return out


def _boxes_apart(a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(gap @ gap) > (eps + SLACK) ** 2


def join_intervals(x, y, px, py, sizes_x, sizes_y, same: bool, threshold: float, eps: float):
    """Links of two intervals: (links of each x, links of each y, pairs as
    a spanning forest of positions, y's after x's; x's alone if ``same``)."""
    count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def go(a0, a1, b0, b1):
        if same and b1 <= a0:
            return
        if _boxes_apart(px[a0:a1], py[b0:b1], eps):
            return
        if a1 - a0 > LEAF or b1 - b0 > LEAF:
            am, bm = (a0 + a1) // 2, (b0 + b1) // 2
            for s, t in ((a0, am), (am, a1)) if a1 - a0 > LEAF else ((a0, a1),):
                for u, v in ((b0, bm), (bm, b1)) if b1 - b0 > LEAF else ((b0, b1),):
                    go(s, t, u, v)
            return
        hit = x[a0:a1] @ y[b0:b1].T >= threshold
        if same:
            hit &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
        if hit.any():
            count_x[a0:a1] += hit @ sizes_y[b0:b1]
            (count_x if same else count_y)[b0:b1] += hit.T @ sizes_x[a0:a1]
            i, j = np.nonzero(hit)
            f = forest(i + a0, j + b0 + (0 if same else len(x)))
            found_a.append(f[0])
            found_b.append(f[1])

    go(0, len(x), 0, len(y))
    a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
    return count_x, count_y, a, b


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, parts: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of
    ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    members = reliable_checkpoint(usable(vectors).withColumn("class", F.xxhash64("label", "v")))
    classes = reliable_checkpoint(members.groupBy("label", "dim", "v").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("class").alias("class")))
    axes = principal_directions(classes)
    grid = [f"g{k}" for k in range(GRID)]

    def place(batches):
        for batch in batches:
            dims, blobs = np.asarray(batch.column(1).to_numpy()), batch.column(2).to_pylist()
            cells = np.zeros((batch.num_rows, GRID), np.int64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                y = _unit(np.stack([np.frombuffer(blobs[i]) for i in at])) @ axes[d][:, :GRID]
                cells[at[:, None], np.arange(y.shape[1])] = np.floor(y / max(eps, 1e-6))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), *(pa.array(c) for c in cells.T)],
                                             names=["label", "dim", "v", "n", "class", *grid])

    def cut(batches):
        """Blocks of a sorted partition: members and box in one row."""
        part, k = TaskContext.get().partitionId(), 0
        held, key = [], None

        def block():
            d = key[1]
            x = np.stack([np.frombuffer(r[0]) for r in held])
            y = _unit(x) @ axes[d]
            box = np.zeros((2, BOX))
            m = min(BOX, d)
            box[0, :m], box[1, :m] = y[:, :m].min(axis=0), y[:, :m].max(axis=0)
            return pa.RecordBatch.from_pylist([{
                "block": (part << 32) + k, "label": key[0], "dim": d, "vs": x.tobytes(),
                "ns": np.array([r[1] for r in held], np.int64).tobytes(),
                "cs": np.array([r[2] for r in held], np.int64).tobytes(),
                "low": box[0].tolist(), "high": box[1].tolist()}], schema=out)

        for batch in batches:
            for label, d, v, n, c in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and ((label, d) != key or len(held) == BLOCK):
                    yield block()
                    held, k = [], k + 1
                key = (label, d)
                held.append((v, n, c))
        if held:
            yield block()

    out = pa.schema([("block", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vs", pa.binary()),
                     ("ns", pa.binary()), ("cs", pa.binary()), ("low", pa.list_(pa.float64())),
                     ("high", pa.list_(pa.float64()))])
    placed = classes.select("label", "dim", "v", "n", "class").mapInArrow(
        place, "label string, dim int, v binary, n long, class long, " + ", ".join(f"{g} long" for g in grid))
    keys = ["label", "dim", *grid, "class"]
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = reliable_checkpoint(placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        cut, "block long, label string, dim int, vs binary, ns binary, cs binary, low array<double>, "
             "high array<double>"))

    # which blocks can meet: boxes (a few numbers a block) joined on label
    # and on the cells of the first direction that they touch
    box = blocks.select("block", "label", "dim", "low", "high")
    cell = lambda c: F.floor(c / max(eps, 1e-6))
    mine = box.select("*", F.explode(F.sequence(cell(F.col("low")[0]), cell(F.col("high")[0]))).alias("cell"))
    reach = box.select(*[F.col(c).alias(f"{c}_b") for c in box.columns], F.explode(F.sequence(
        cell(F.col("low")[0] - eps - SLACK), cell(F.col("high")[0] + eps + SLACK))).alias("cell_b"))
    gap = sum((F.greatest(F.lit(0.0), F.col("low")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high")[i])
               * F.greatest(F.lit(0.0), F.col("low")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high")[i])
               for i in range(BOX)), F.lit(0.0))
    meet = (mine.join(reach, (F.col("label") == F.col("label_b")) & (F.col("dim") == F.col("dim_b"))
                      & (F.col("cell") == F.col("cell_b")) & (F.col("block") <= F.col("block_b")))
            .where(gap <= (eps + SLACK) ** 2).select("block", "block_b").distinct())
    data = blocks.select("block", "dim", "vs", "ns", "cs")
    pairs = (meet.join(data, "block").join(
        data.select(*[F.col(c).alias(f"{c}_b") for c in data.columns]), "block_b")
        .select("block", "block_b", "dim", "vs", "ns", "cs", "vs_b", "ns_b", "cs_b"))

    def compare(batches):
        for batch in batches:
            for a, b, d, vs, ns, cs, vt, nt, ct in zip(*(batch.column(i).to_pylist() for i in range(9))):
                x, y = _unit(np.frombuffer(vs).reshape(-1, d)), _unit(np.frombuffer(vt).reshape(-1, d))
                sx, sy = np.frombuffer(ns, np.int64), np.frombuffer(nt, np.int64)
                ids = np.frombuffer(cs, np.int64) if a == b else \
                    np.concatenate([np.frombuffer(cs, np.int64), np.frombuffer(ct, np.int64)])
                cx, cy, i, j = join_intervals(x, y, x @ axes[d], y @ axes[d], sx, sy, a == b, threshold, eps)
                counts = cx if a == b else np.concatenate([cx, cy])
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[some], ids[i]])),
                     pa.array(np.concatenate([ids[some], ids[j]])),
                     pa.array(np.concatenate([counts[some], np.zeros(len(i), np.int64)]))], names=["a", "b", "n"])

    found = reliable_checkpoint(pairs.mapInArrow(compare, "a long, b long, n long"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("n = 0"), "a", "b")
    rooted = (classes.select("class", "least", "n").join(counts, "class", "left")
              .join(roots.withColumnRenamed("node", "class"), "class", "left")
              .select("class", "least", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                      F.coalesce("component", "class").alias("root")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("class", "n_links", "component_id")
    linked = members.join(named, "class").select("vec_id", "n_links", "component_id")
    rest = reliable_checkpoint(_unusable(vectors))
    return linked.unionByName(rest).select("vec_id", "n_links", "component_id",
                                           F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _unusable(vectors: DataFrame) -> DataFrame:
    def bad(v):
        v = v.cast("double")
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    ok = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad)
          & F.exists("embedding", lambda v: v.cast("double") != 0))
    return vectors.where(~F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"))
