"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnkit.session import reliable_checkpoint, table_path

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, a null as an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts pass ``max_bytes`` together (one
    text alone may be longer), so that a task's memory follows the bytes."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        size = np.frombuffer(_binary_lengths(col), dtype=np.int64)
        total = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(int(np.searchsorted(total, base + max_bytes, side="right")), start + 1)
            yield batch.slice(start, end - start)
            start = end


def _binary_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return np.ascontiguousarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply): every input bit reaches
    every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _folded(edges: DataFrame) -> DataFrame:
    """(u, r): every node of a few ``edges`` (a, b) with one node of its
    component, by one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from churnkit.llm.simhash import forest  # which imports this module
        held = pa.Table.from_batches(list(batches))
        nodes = pa.chunked_array([*held.column(0).chunks, *held.column(1).chunks]).combine_chunks().dictionary_encode()
        ends = nodes.indices.to_numpy().astype(np.int64)
        root = np.arange(len(nodes.dictionary))
        other, least = forest(ends[:held.num_rows], ends[held.num_rows:])
        root[other] = least
        yield pa.RecordBatch.from_arrays([nodes.dictionary, nodes.dictionary.take(pa.array(root))], names=["u", "r"])

    return edges.select("a", "b").coalesce(1).mapInArrow(fold, f"u {kind}, r {kind}")


def components(edges: DataFrame, a: str, b: str, few: int = 0) -> DataFrame:
    """Connected components of undirected ``edges``: (node, component) for
    every node with an edge to another node, ``component`` being the
    smallest node reachable, the node included.

    Contraction: in each round every node joins the neighbour (or itself)
    of least priority, and the edges are rewritten between the merged nodes.
    The priority is first the node itself, which folds the stars around a
    least node (as spanning forests are) at once, then a random one, which
    shortens any shape, long chains too, by a constant factor. Each round is
    checkpointed. As soon as at most ``few`` edges are left, one task folds
    them at once: the last rounds have many stages and hardly any rows.
    """
    e = reliable_checkpoint(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                            .where("a <> b").distinct())
    picks: list[DataFrame] = []
    while not e.isEmpty():
        turn = len(picks)
        if few and e.count() <= few:
            picks.append(reliable_checkpoint(_folded(e)))
            break

        def prio(c, turn=turn):
            chance = F.xxhash64(F.col(c), F.lit(turn)) if turn else F.lit(0).cast("long")
            return F.struct(chance.alias("p"), F.col(c).alias("i"))

        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        pick = reliable_checkpoint(both.groupBy("u").agg(F.min(prio("v")).alias("m"))
                                   .select("u", F.least(prio("u"), F.col("m"))["i"].alias("r")))
        left = e.join(pick, e.a == pick.u).select(F.col("r").alias("a"), "b")
        e = reliable_checkpoint(left.join(pick, left.b == pick.u).select("a", F.col("r").alias("b"))
                                .where("a <> b").distinct())
        picks.append(pick)
    if not picks:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    mapping = picks[0].select(F.col("u").alias("node"), F.col("r").alias("root"))
    for pick in picks[1:]:
        mapping = mapping.join(pick, mapping.root == pick.u, "left").select(
            "node", F.coalesce("r", "root").alias("root"))
    mapping = reliable_checkpoint(mapping)
    least = mapping.groupBy("root").agg(F.min("node").alias("component"))
    return mapping.join(least, "root").select("node", "component")


def in_train(remainder_of: int, held_out: int) -> Callable[[str], object]:
    """Column: may the labels of this row be learnt from? Its doc_id's
    CRC-32 (of the decimal text) modulo ``remainder_of`` is not
    ``held_out``; a null doc_id is never learnt from."""
    return lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % remainder_of != held_out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, train, per_class: int,
                    max_bytes: int) -> tuple[list[str], np.ndarray]:
    """A bounded sample of labelled training texts, whole, with their labels,
    on the driver: of each class the rows of least hash among those that
    ``train(doc_id)`` admits (so the choice doesn't depend on partitioning),
    at most ``per_class`` of them and only until their texts pass
    ``max_bytes`` together: fewer rows, never shorter texts. Of the rows of
    a repeated doc_id the least text stands for all."""
    picked = None
    for value in (0, 1):
        rows = (labels.where((F.col(label) == value) & train("doc_id")).select(F.col("doc_id").alias("id"))
                .distinct().orderBy(F.xxhash64("id"), "id").limit(per_class)
                .select("id", F.lit(value).alias("y")))
        picked = rows if picked is None else picked.union(rows)
    # at most 2 * per_class rows of two numbers: a proven bound
    rows = reliable_checkpoint(
        documents.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("t"))
        .join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("t").alias("t")))
    size = F.octet_length("t").cast("long")
    in_turn = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    fits = (rows.select("id", "y", size.alias("n")).withColumn("before", F.sum("n").over(in_turn) - F.col("n"))
            .where(F.col("before") < max_bytes).select("id", "y"))
    got = rows.join(F.broadcast(fits), ["id", "y"]).orderBy("id", "y").select("t", "y").toArrow()
    texts, y = got.column("t").to_pylist(), np.array(got.column("y").to_pylist(), dtype=np.int64)
    del got
    pa.default_memory_pool().release_unused()
    return texts, y


def with_text(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns of ``documents`` after ``text`` has changed: ``n_chars``
    follows it."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*columns)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Column names for internal use that none of ``columns`` has
    (whatever the case of its letters)."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def others_of(docs: DataFrame, *replaced: str) -> list[str]:
    """The columns of ``docs`` besides those that an operator replaces."""
    gone = {r.lower() for r in replaced}
    return [c for c in docs.columns if c.lower() not in gone]
