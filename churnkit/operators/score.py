"""Scoring and model explanation."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from churnkit.operators import mlprep
from churnkit.operators.train import logistic_regression
from churnkit.schema import PAGES, page_column


def scored(pred: DataFrame) -> DataFrame:
    """(userId, prediction, churn_probability, label) of a prediction table."""
    return pred.select("userId", "prediction", vector_to_array("probability")[1].alias("churn_probability"),
                       "label")


def predicted_churners(pred: DataFrame) -> DataFrame:
    """R2: users predicted to churn, most likely first (a range-partitioned
    sort; ties by user id)."""
    return (scored(pred).filter(F.col("prediction") == 1.0)
            .orderBy(F.desc("churn_probability"), F.asc("userId")))


def actual_churners(pred: DataFrame) -> DataFrame:
    """Users who did churn, with what the model said."""
    return scored(pred).filter(F.col("label") == 1.0)


def save_model(model: PipelineModel, path: str, inputs: Sequence[str]) -> None:
    """Write the fitted pipeline and, beside it, its input column list
    (H18: models on different inputs are not interchangeable)."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(list(inputs)),)], "inputs string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/_inputs")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    """The pipeline and its recorded inputs."""
    model = PipelineModel.load(path)
    inputs = json.loads(spark.read.text(f"{path}/_inputs").first()[0])
    return model, inputs


def score_with_saved_model(spark: SparkSession, path: str, users: DataFrame) -> DataFrame:
    """Score a table of users with a saved end-to-end pipeline (batch,
    distributed; the table may hold one user or millions)."""
    model, inputs = load_model(spark, path)
    needed = [c.removesuffix("_encoded") for c in inputs]  # an encoded input needs its own column
    missing = [c for c in needed if c not in users.columns]
    if missing:
        raise ValueError(f"input columns missing for this model: {missing}")
    prepared = mlprep.fill_nulls(users)
    if "churn_label" in users.columns:
        prepared = mlprep.label_cast(prepared)
    else:  # users whose outcome is not known yet
        prepared = prepared.withColumn("label", F.lit(None).cast("double"))
    return scored(model.transform(prepared))


def coefficient_table(spark: SparkSession, lr_model, transformed: DataFrame,
                      vec: str = "features") -> DataFrame:
    """(feature, coefficient, abs_coefficient) for every vector slot.
    Names come from numeric AND binary (one-hot) attributes, by index; the
    table has one row per slot (metadata-sized, built on the driver)."""
    names = dict(mlprep.vector_names(transformed, vec))
    coefs = lr_model.coefficients.toArray().tolist()
    rows = [(i, names.get(i, f"f{i}"), float(c)) for i, c in enumerate(coefs)]
    df = spark.createDataFrame(rows, "idx int, feature string, coefficient double")
    return df.withColumn("abs_coefficient", F.abs("coefficient"))


def top_features(coefs: DataFrame, k: int = 10) -> DataFrame:
    return coefs.orderBy(F.desc("abs_coefficient"), F.asc("idx")).limit(k)


def feature_importance(spark: SparkSession, tree_model, transformed: DataFrame,
                       vec: str = "features") -> DataFrame:
    """Tree-ensemble importances per named slot (LR has none)."""
    names = dict(mlprep.vector_names(transformed, vec))
    imp = tree_model.featureImportances.toArray().tolist()
    rows = [(i, names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "idx int, feature string, importance double")


def topk_estimator(indices: Sequence[int]) -> Pipeline:
    """Slice the chosen slots out of the assembled vector, re-scale, LR."""
    return Pipeline(stages=[
        VectorSlicer(inputCol="features", outputCol="top_features", indices=sorted(int(i) for i in indices)),
        StandardScaler(inputCol="top_features", outputCol="scaled_top", withMean=True, withStd=True),
        logistic_regression(features="scaled_top"),
    ])


def error_share_scores(users: DataFrame, threshold: float = 0.2, pages=PAGES) -> DataFrame:
    """A fixed, training-free scorer used to check the evaluators exactly:
    score = share of a user's page events that are errors; predicted churn
    when the share exceeds ``threshold``."""
    total = sum((F.coalesce(F.col(page_column(p)), F.lit(0)) for p in pages), F.lit(0))
    score = F.try_divide(F.col("Error").cast("double"), total)
    return users.select(
        "userId", "churn_label",
        F.col("churn_label").cast("double").alias("label"),
        score.alias("rawPrediction"),
        F.when(score > threshold, 1.0).otherwise(0.0).alias("prediction"),
    )
