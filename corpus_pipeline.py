"""Corpus pipeline: the text operators applied one after another to
``documents``, each stage written as Parquet and read again.

Every stage takes what its predecessor kept; all but the last return the
columns of ``documents`` (``n_chars`` follows the text). A document whose
text has become empty stays, and is a piece of length zero in the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnkit.llm import line_dedup, packing, simhash, substring_dedup, toxicity
from churnkit.llm.common import discard, table, with_text
from churnkit.session import scratch_path, table_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It is fitted on the
    labelled documents among those given."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to three documents or more stay in one of them."""
    return with_text(line_dedup.drop_common_lines(docs), COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs, shingle=3, k=2).select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more stay where they occur first."""
    return with_text(substring_dedup.remove_repeats(docs, window=20), COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in pieces packed into sequences: one row per piece."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: no SQL expresses the classifier and the packing; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole of ``documents``."""
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            discard(spark, before)
        before = path
    return docs
