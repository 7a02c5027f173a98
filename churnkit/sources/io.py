"""Readers and writers (S1-S7, S12, S13) with declared schemas.

Declared schemas skip the inference pass over the input (one full extra
read for JSON / CSV) and keep ids as strings (CSV inference would turn an
all-digit userId into a number). Vector columns go to Parquet: JSON and
CSV do not keep the ML vector type.
"""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from churnkit.schema import EVENT_SCHEMA, FEATURE_SCHEMA, PAGES, feature_columns
from churnkit.session import table_path

# Parquet footer schemas seen in this process, by (application, path,
# modification time, size): a new session may infer types differently.
_FOOTER_SCHEMAS: dict[tuple, T.StructType] = {}
# Row-count bounds proven for a table version: (path, mtime, size) -> largest
# bound checked and found to hold.
_ROW_BOUNDS: dict[tuple, int] = {}


# Where a line that does not fit the schema goes when it is kept.
CORRUPT = "_corrupt_record"
# A null in CSV.
CSV_NULL = "\\N"


def read_events_json(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                     keep_bad_lines: bool = False) -> DataFrame:
    """JSON-lines event log. A line that does not fit the schema (broken,
    or a field of another type) fails the read; with ``keep_bad_lines`` it
    becomes a row with the line's text in ``_corrupt_record``. A log without
    ``event_id`` reads as one whose ids are null."""
    if not keep_bad_lines:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def feature_schema(pages=PAGES) -> T.StructType:
    """The feature table's schema with the counts of the given pages."""
    known = {f.name: f for f in FEATURE_SCHEMA.fields}
    return T.StructType([known.get(c, T.StructField(c, T.LongType(), True)) for c in feature_columns(pages)])


def read_features_json(spark: SparkSession, path: str, pages=PAGES) -> DataFrame:
    """S2."""
    return spark.read.schema(feature_schema(pages)).option("mode", "FAILFAST").json(path)


def read_features_csv(spark: SparkSession, path: str, pages=PAGES) -> DataFrame:
    """S3: CSV with a header line, read with the declared schema."""
    return read_csv(spark, path, feature_schema(pages))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """CSV as ``write_csv`` writes it. ``line_breaks`` reads values that hold
    line breaks, at the price of one task per file."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("escape", '"')
            .option("nullValue", CSV_NULL).option("multiLine", line_breaks).csv(path))


def write_split_json(split: DataFrame, path: str) -> None:
    """A transformed split as JSON; vectors become arrays."""
    vectors = [f.name for f in split.schema.fields if isinstance(f.dataType, VectorUDT)]
    write_json(split.withColumns({c: vector_to_array(c) for c in vectors}), path)


def read_split_json(spark: SparkSession, path: str) -> DataFrame:
    """The users, labels and scaled features of a written split; a line that
    does not fit fails the read."""
    schema = "userId string, label double, scaled_features array<double>"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(path)


def file_version(path: str) -> tuple[str, float, int] | None:
    """What tells one version of a single local file from another; None for
    a folder (whose own time says nothing of its files) or another store."""
    if not os.path.isfile(path):
        return None
    s = os.stat(path)
    return path, s.st_mtime, s.st_size


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of ``sf_dir``. A single local file's footer schema is
    inferred once per session and file version (path, modification time,
    size) and declared on later reads, which then plan without an
    inference job. Other locations are inferred on every read."""
    path = table_path(sf_dir, name)
    version = file_version(path)
    if version is None:
        return spark.read.parquet(path)
    key = (spark.sparkContext.applicationId, *version)
    schema = _FOOTER_SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _FOOTER_SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def read_small_table(spark: SparkSession, sf_dir: str, name: str, max_rows: int) -> DataFrame:
    """A table to be broadcast: marked for broadcast once it is proven to
    hold at most ``max_rows`` rows (a bounded count). For a local table the
    proof is kept per file version, so repeated reads skip the count; a
    larger table is returned unmarked (the join then shuffles)."""
    from churnkit.operators.joins import sized_broadcast
    df = read_table(spark, sf_dir, name)
    path = table_path(sf_dir, name)
    key = file_version(path)
    if key is None:
        return sized_broadcast(df, max_rows)
    if _ROW_BOUNDS.get(key, -1) >= max_rows:
        return F.broadcast(df)
    out = sized_broadcast(df, max_rows)
    if out is not df:
        _ROW_BOUNDS[key] = max_rows
    return out


def write_json(df: DataFrame, path: str) -> None:
    """One file per task, overwrite."""
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """S6."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed CSV with header (no collect to the driver). Blanks at
    the ends of a string stay, quotes are doubled, and a null is ``\\N``, so
    that an empty string stays one."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", CSV_NULL)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def describe_schema(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows, n_nulls) of every column, the
    counts from one aggregate over the rows."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col("_rows").alias("n_rows"), F.col(f"_{i}").alias("n_nulls"))
        for i, f in enumerate(df.schema.fields)]))
    return counts.select(rows.alias("r")).select("r.*")


def preview(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in a deterministic order."""
    return df.orderBy(*order).limit(n)
