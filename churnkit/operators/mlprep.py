"""ML preparation (M1-M7): indexing, one-hot encoding, assembling,
scaling, label cast and a reproducible user split.

Fitting (StringIndexer counts, StandardScaler moments) is a distributed
aggregate; only the fitted vocabularies / moments (one value per category
or feature) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from churnkit.operators.ranks import numbered
from churnkit.schema import CATEGORICAL_COLUMNS, LEAKY_PAGES, MEASURE_COLUMNS, MODEL_PAGE_COLUMNS, SPLIT_PERCENT

NUMERIC_INPUTS = tuple(MEASURE_COLUMNS) + tuple(MODEL_PAGE_COLUMNS)


def index_col(c: str) -> str:
    return f"{c}_index"


def encoded_col(c: str) -> str:
    return f"{c}_encoded"


def model_inputs(categoricals: Sequence[str] = CATEGORICAL_COLUMNS,
                 numeric: Sequence[str] = NUMERIC_INPUTS) -> list[str]:
    """Assembler inputs: numeric measures and non-leaky page counts, then the
    one-hot vectors. Leaky pages (Cancel, Cancellation Confirmation) are
    refused here."""
    leaky = {p.replace(" ", "_") for p in LEAKY_PAGES}
    bad = leaky.intersection(numeric)
    if bad:
        raise ValueError(f"label-leaking inputs: {sorted(bad)}")
    return [*numeric, *[encoded_col(c) for c in categoricals]]


def fill_nulls(users: DataFrame, policy: str = "zero") -> DataFrame:
    """H9: the assembler refuses nulls. ``zero`` fills numeric nulls with 0
    (users without songs stay in), ``drop`` removes rows with any null."""
    if policy == "zero":
        return users.na.fill(0)
    if policy == "drop":
        return users.na.drop(how="any")
    raise ValueError(policy)


def label_cast(users: DataFrame, label: str = "churn_label") -> DataFrame:
    """M2: ``label`` = churn flag as double (1.0 = churned, whatever the
    class balance; a frequency-ordered indexer would flip it when churners
    are the majority)."""
    return users.withColumn("label", F.col(label).cast("double"))


def string_indexer(cols: Sequence[str] = CATEGORICAL_COLUMNS) -> StringIndexer:
    """M1: most frequent value -> 0 (ties alphabetical); null or unseen -> last."""
    return StringIndexer(inputCols=list(cols), outputCols=[index_col(c) for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def frequency_index(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """M1 / M3 for a vocabulary too large for the driver: (col, n, idx) of
    every value, the most frequent 0 (ties in the values' order). The
    numbers come from a distributed sort of the counted values; no
    vocabulary is collected."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, [F.desc("n"), F.asc(col)], name)


def with_frequency_index(df: DataFrame, col: str, index: DataFrame, name: str = "idx") -> DataFrame:
    """``df`` with the index of ``col`` joined on; null and unseen values get
    the number of indexed values, like ``StringIndexer`` that keeps them. As
    a one-hot slot that number is the all-zero baseline."""
    size = index.count()
    return (df.join(index.select(F.col(col), F.col(name).alias("_idx")), col, "left")
            .select(*df.columns, F.coalesce("_idx", F.lit(size)).cast("double").alias(index_col(col))))


def one_hot_encoder(cols: Sequence[str] = CATEGORICAL_COLUMNS) -> OneHotEncoder:
    """M3: one slot per known value; null / unseen is the all-zero baseline."""
    return OneHotEncoder(inputCols=[index_col(c) for c in cols], outputCols=[encoded_col(c) for c in cols],
                         dropLast=True, handleInvalid="error")


def assembler(inputs: Sequence[str] | None = None) -> VectorAssembler:
    """M4."""
    return VectorAssembler(inputCols=list(inputs or model_inputs()), outputCol="features",
                           handleInvalid="error")


def scaler() -> StandardScaler:
    """M5: (x - mean) / sample std; a constant feature becomes 0."""
    return StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)


def transform_stages(inputs: Sequence[str] | None = None) -> list:
    return [string_indexer(), one_hot_encoder(), assembler(inputs), scaler()]


def feature_transform(inputs: Sequence[str] | None = None) -> Pipeline:
    """M6: index -> encode -> assemble -> scale, as one estimator (fit on
    the training split only, applied to every split)."""
    return Pipeline(stages=transform_stages(inputs))


def split_bucket(key: str = "userId"):
    """Stable 0-99 bucket of a user id (md5), independent of partitioning."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100)


def assign_split(users: DataFrame, key: str = "userId",
                 percent: Sequence[int] = SPLIT_PERCENT) -> DataFrame:
    """M7: train / validation / test by hashed user id (70 / 15 / 15).

    Unlike ``randomSplit`` the assignment does not depend on partitioning or
    row order, so a rerun on a resized cluster gives the same split."""
    b = split_bucket(key)
    train, val = percent[0], percent[0] + percent[1]
    return users.withColumn(
        "split", F.when(b < train, "train").when(b < val, "validation").otherwise("test"))


def split_users(users: DataFrame, key: str = "userId"):
    """(train, validation, test) DataFrames."""
    s = assign_split(users, key)
    return tuple(s.filter(F.col("split") == name).drop("split") for name in ("train", "validation", "test"))


def vector_long(df: DataFrame, vec: str, key: str = "userId", nonzero: bool = False,
                digits: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A vector column as (key, *keep, pos, value) rows."""
    out = df.select(key, *keep, F.posexplode(vector_to_array(F.col(vec))).alias("pos", "value"))
    if nonzero:
        out = out.filter(F.col("value") != 0)
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out.withColumn("pos", F.col("pos").cast("int"))


def vector_names(df: DataFrame, vec: str) -> list[tuple[int, str]]:
    """(index, name) of every slot of an assembled vector, from its ML
    metadata: numeric *and* binary (one-hot) attributes, ordered by index."""
    attrs = df.schema[vec].metadata.get("ml_attr", {}).get("attrs", {})
    pairs = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return sorted(pairs)
