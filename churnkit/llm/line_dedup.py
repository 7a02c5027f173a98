"""Line dedup: levelled sorted runs of line hashes.

Documents arrive in batches. A batch's lines become a sorted *run*: one
row per line key with the number of documents holding it and the largest
doc_id among them. The runs form levels: a batch first marks its keys by
a merge join with each of the runs already there (keys seen before / keys
that are new), and is added as its own run at level 0; when a level has
``fanout`` runs they are merged into one run of the next level, so the
runs, and with them the joins of a batch, grow with the logarithm of the
batches. The runs are partitions of one Parquet table in the shared
checkpoint folder, bucketed and sorted by key: a run is joined as it lies,
without an exchange or a sort, runs are merged bucket by bucket without an
exchange, a lost executor costs a re-read, and no batch reads an earlier
one again.

The line keys of all documents are written once, in a folder for each
batch. Batches are ranges of falling doc_id, as many as the texts have
``BATCH_BYTES``, at least ``LEAST_BATCHES`` and at most ``MOST_BATCHES``.

After the last batch the runs are merged once more: keys of at least
``min_chars`` code points found in ``min_docs`` or more documents lose
all their lines except in the holder (the largest doc_id).

Defined results: a null or empty text is one empty line; a null doc_id
counts as a document below every other (it never holds a line another
document has); rows that repeat a doc_id are one document in the counts
and each keeps the lines that doc_id holds; other columns pass through
(columns named ``n_lines`` or ``n_dropped`` are replaced).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, discard, fresh, others_of, slices
from churnkit.session import reliable_checkpoint, scratch_path

BLANK = b" \t\n\x0b\x0c\r"
NO_ID = -(2 ** 63)
SLICE_BYTES = 16 << 20
BATCH_BYTES = 256 << 30
LEAST_BATCHES, MOST_BATCHES = 4, 256


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key, None if the key is too short."""
    key = line.strip(BLANK).lower()  # bytes.lower changes A-Z only
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _as_longs(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)


def batch_bounds(docs: DataFrame, batches: int | None = None) -> list[int]:
    """Rising doc_ids (fewer than ``MOST_BATCHES``) that divide the batches;
    a batch ends with the first id above its bound."""
    shares = F.array(*(F.lit(k / MOST_BATCHES) for k in range(1, MOST_BATCHES)))
    seen = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"),
                    F.percentile_approx(F.col("doc_id").cast("long"), shares).alias("cuts")).first()
    wanted = batches or min(MOST_BATCHES, max(LEAST_BATCHES, -(-(seen["bytes"] or 0) // BATCH_BYTES)))
    cuts = seen["cuts"] or []
    return sorted({cuts[k * MOST_BATCHES // wanted - 1] for k in range(1, wanted)}) if cuts else []


def line_rows(docs: DataFrame, min_chars: int, bounds: list[int]) -> DataFrame:
    """(h1, h2, doc, th, batch): each key once per document row, null doc_id
    as the smallest long; ``th`` is a hash of the row's text, ``batch`` the
    number of the batch in which the document arrives."""
    edges = np.array(bounds, np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, hashes, keys = [], [], []
            for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     byte_texts(batch.column(2))):
                own = {k for k in (line_key(x, min_chars) for x in text.split(b"\n")) if k}
                keys += own
                ids += [NO_ID if doc is None else doc] * len(own)
                hashes += [th] * len(own)
            h = _as_longs(keys)
            docs_ = np.array(ids, np.int64)
            turn = (len(edges) - np.searchsorted(edges, docs_, side="left")).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(docs_), pa.array(hashes, pa.int64()), pa.array(turn)],
                names=["h1", "h2", "doc", "th", "batch"])
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").mapInArrow(
        emit, ROWS)


def written_rows(rows: DataFrame, path: str) -> DataFrame:
    """``line_rows`` written with a folder for each batch (rebalanced, so a
    batch is a few files of even size however the documents lie)."""
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    return rows.sparkSession.read.schema(ROWS).parquet(path)


ROWS = "h1 long, h2 long, doc long, th long, batch int"


@contextmanager
def _runs_lie_sorted(spark: SparkSession) -> Iterator[None]:
    """Inside, a bucket of one file counts as sorted, as the runs are."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Levelled sorted runs of (h1, h2, n, holder)."""

    SCHEMA = "h1 long, h2 long, n long, holder long"

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[int]] = [[]]  # numbers of the runs
        self.folder, self.name = scratch_path(spark, "line-runs"), f"line_runs_{uuid.uuid4().hex[:16]}"
        self.written = 0
        # as many buckets as a shuffle has partitions, so that a batch meets the runs after its own exchange
        conf = spark.conf
        self.buckets = int(conf.get("spark.sql.shuffle.partitions"))
        if conf.get("spark.sql.adaptive.enabled") == "true" \
                and conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
            self.buckets = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                               or self.buckets)

    def _write(self, rows: DataFrame) -> int:
        """Add a run to the table, bucketed and sorted by key."""
        (rows.withColumn("run", F.lit(self.written)).write.mode("append").format("parquet").partitionBy("run")
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", self.folder).saveAsTable(self.name))
        self.written += 1
        return self.written - 1

    def _read(self, *runs: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("run").isin(*runs)).drop("run")

    def _merge(self, runs: list[int]) -> DataFrame:
        """Runs as one: counts added, the holder (set in one run) kept. One
        scan reads a bucket of all runs in one task."""
        return self._read(*runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))

    def live(self) -> list[int]:
        return [r for level in self.levels for r in level]

    def merged(self) -> DataFrame:
        return self._merge(self.live()) if self.live() else self.spark.createDataFrame([], self.SCHEMA)

    def marked(self, batch: DataFrame) -> DataFrame:
        """The run of the (h1, h2, doc) rows of a batch: keys that no run
        holds are new and get their holder here, the others only add to the
        count (a key has its holder in one run, so no join adds rows)."""
        run = batch.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("holder"))
        for seen in self.live():
            known = self._read(seen).where("holder is not null").select("h1", "h2", F.lit(True).alias("seen")).hint("merge")
            run = run.join(known, ["h1", "h2"], "left").select(
                "h1", "h2", "n", F.when(F.col("seen").isNull(), F.col("holder")).alias("holder"))
        return run

    def add(self, batch: DataFrame) -> None:
        """Add the rows of new documents, whose doc_ids lie below those of
        every earlier batch."""
        with _runs_lie_sorted(self.spark):
            self.levels[0].append(self._write(self.marked(batch)))
            at = 0
            while len(self.levels[at]) >= self.fanout:
                full, self.levels[at] = self.levels[at], []
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(self._write(self._merge(full)))
                at += 1

    def close(self) -> None:
        """Remove the runs' table and files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.folder)


def common_lines(rows: DataFrame, batches: int, min_docs: int, fanout: int) -> DataFrame:
    """(h1, h2, holder) of the keys found in ``min_docs`` documents or
    more, checkpointed; ``rows`` as ``line_rows`` gives them arrive batch
    by batch."""
    runs = LineRuns(rows.sparkSession, fanout)
    for k in range(batches):
        runs.add(rows.where(F.col("batch") == k))
    common = reliable_checkpoint(runs.merged().where(F.col("n") >= min_docs).select("h1", "h2", "holder"))
    runs.close()
    return common


def drop_lists(rows: DataFrame, common: DataFrame, key: str, text_key: str, gone: str) -> DataFrame:
    """(key, text_key, gone): the line keys that the rows of a doc_id and
    text lose, each once."""
    return (rows.join(common, ["h1", "h2"]).where("doc <> holder")
            .groupBy(F.col("doc").alias(key), F.col("th").alias(text_key))
            .agg(F.collect_set(F.struct("h1", "h2")).alias(gone)))


def drop_common_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int | None = None,
                      fanout: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, any others) with the lines that the rule
    above drops taken out: every input column, ``text`` replaced, plus
    ``n_lines`` and ``n_dropped``."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "line-rows")
    bounds = batch_bounds(docs, batches)
    rows = written_rows(line_rows(docs, min_chars, bounds), path)
    # checkpointed, so the join below exchanges both sides, and a line that a
    # third of all documents share is split among tasks
    common = common_lines(rows, len(bounds) + 1, min_docs, fanout)
    key, text_key, gone = fresh(docs.columns, "doc_key", "text_key", "gone_lines")
    # a set for each doc_id and text, so none is longer than a text's lines (texts
    # of one doc_id that share a hash lose the same lines, so their union is right);
    # checkpointed, so that copies without a doc_id are split among tasks as well
    drops = reliable_checkpoint(drop_lists(rows, common, key, text_key, gone))
    discard(spark, path)
    others = others_of(docs, "text", "n_lines", "n_dropped")
    joined = (docs.select(*others, "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(key),
                          F.xxhash64("text").alias(text_key))
              .join(drops, [key, text_key], "left").select(*others, "text", gone))
    kinds = [docs.schema[c] for c in others]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            at = {n: i for i, n in enumerate(batch.schema.names)}
            texts, lines_in, lines_out = [], [], []
            dropped = batch.column(at[gone]).to_pylist()
            for text, lost_keys in zip(byte_texts(batch.column(at["text"])), dropped):
                lines = text.split(b"\n")
                if lost_keys:
                    keys = np.array([[g["h1"], g["h2"]] for g in lost_keys], dtype="<i8").tobytes()
                    lost = {keys[i:i + 16] for i in range(0, len(keys), 16)}
                    kept = [x for x in lines if (k := line_key(x, min_chars)) is None or k not in lost]
                else:
                    kept = lines
                texts.append(b"\n".join(kept))
                lines_in.append(len(lines))
                lines_out.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(at[c]) for c in others]
                + [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines_in, pa.int64()),
                   pa.array(lines_out, pa.int64())], names=[*others, "text", "n_lines", "n_dropped"])

    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([*(StructField(k.name, k.dataType) for k in kinds), StructField("text", StringType()),
                         StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return joined.mapInArrow(emit, schema)
