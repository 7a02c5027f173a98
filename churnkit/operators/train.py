"""Training, model comparison and tuning.

Models train on the user table (one row per user), not on events. The
transformed training split is checkpointed into the shared checkpoint
folder before fitting: iterative fits re-read it many times, and a lost
executor then recomputes from the checkpoint rather than the event log.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from churnkit.operators import evaluate, mlprep, roc
from churnkit.operators.folds import fold_statistics, scaled_vector
from churnkit.schema import LR_GRID
from churnkit.session import reliable_checkpoint

SEED = 42


def logistic_regression(features: str = "scaled_features", **kw) -> LogisticRegression:
    """maxIter 100, no regularisation, threshold 0.5."""
    params = dict(maxIter=100, regParam=0.0, elasticNetParam=0.0, threshold=0.5)
    params.update(kw)
    return LogisticRegression(featuresCol=features, labelCol="label", **params)


def random_forest(features: str = "scaled_features", seed: int = SEED) -> RandomForestClassifier:
    """20 trees, depth 5, 32 bins, gini."""
    return RandomForestClassifier(featuresCol=features, labelCol="label", numTrees=20, maxDepth=5,
                                  maxBins=32, impurity="gini", seed=seed)


def gradient_boosted_trees(features: str = "scaled_features", seed: int = SEED) -> GBTClassifier:
    """20 iterations, depth 5, step 0.1."""
    return GBTClassifier(featuresCol=features, labelCol="label", maxIter=20, maxDepth=5, stepSize=0.1,
                         seed=seed, checkpointInterval=10)


ESTIMATORS = {
    "Random Forest": random_forest,
    "Logistic Regression": logistic_regression,
    "Gradient Boosted Trees": gradient_boosted_trees,
}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage)."""
    return reliable_checkpoint(df)


def require_both_classes(df: DataFrame, name: str, label: str = "label") -> None:
    n = df.select(label).distinct().limit(3).count()
    if n < 2:
        raise ValueError(f"the {name} split holds a single class; use a larger data set")


class PreparedSplits:
    """Fitted transform model and the transformed train / validation / test splits."""

    def __init__(self, users: DataFrame, inputs: Sequence[str] | None = None, null_policy: str = "zero"):
        # one row per user: checkpoint it once, so the many fitting and
        # evaluation jobs read it instead of re-running the event-log job
        base = materialize(mlprep.label_cast(mlprep.fill_nulls(users, null_policy)))
        train, validation, test = mlprep.split_users(base)
        self.inputs = list(inputs or mlprep.model_inputs())
        self.raw_train, self.raw_validation, self.raw_test = train, validation, test
        self.transform_model = mlprep.feature_transform(self.inputs).fit(train)
        self.train = materialize(self.transform_model.transform(train))
        self.validation = self.transform_model.transform(validation)
        self.test = self.transform_model.transform(test)
        require_both_classes(self.train, "train")


def train_and_evaluate(estimator, train: DataFrame, validation: DataFrame):
    """T4: fit, predict the validation split; AUC + metrics + predictions."""
    model = estimator.fit(train)
    pred = model.transform(validation)
    metrics = evaluate.classification_metrics(pred).first().asDict()
    metrics["area_under_roc"] = evaluate.area_under_roc(pred)
    return model, metrics, pred


METRIC_COLUMNS = ("model", "f1_score", "area_under_roc", "accuracy", "precision", "recall",
                  "churn_precision", "churn_recall", "churn_f1")


def metric_row(name: str, metrics: dict) -> tuple:
    return (name, metrics["weighted_f1"], metrics["area_under_roc"], metrics["accuracy"],
            metrics["weighted_precision"], metrics["weighted_recall"], metrics["churn_precision"],
            metrics["churn_recall"], metrics["churn_f1"])


METRIC_SCHEMA = "model string, " + ", ".join(f"{c} double" for c in METRIC_COLUMNS[1:])


def compare_models(spark, named_models: Sequence[tuple[str, object]], validation: DataFrame):
    """E5 + E6: metric table of fitted models on the validation split, and
    the best one by strictly greater weighted F1 (ties: first listed).

    All models' scores are one table of (model, label, prediction, score),
    written once; its confusion counts and ROC curves are one aggregate and
    one sorted pass for all models."""
    scores = None
    for i, (_, model) in enumerate(named_models):
        rows = model.transform(validation).select(
            F.lit(i).alias("model"), "label", "prediction", vector_to_array("rawPrediction")[1].alias("score"))
        scores = rows if scores is None else scores.union(rows)
    scores = materialize(scores)
    metrics = evaluate.metrics_from_counts(evaluate.confusion_counts(scores, by=["model"]), by=["model"])
    areas = roc.roc_summary(roc.roc_points(scores)).select("model", "area_under_roc")
    found = {r["model"]: r.asDict() for r in metrics.join(areas, "model").collect()}  # a row per model
    rows, best = [], None
    for i, (name, model) in enumerate(named_models):
        rows.append(metric_row(name, found[i]))
        if best is None or found[i]["weighted_f1"] > best[1]:
            best = (name, found[i]["weighted_f1"], model)
    return spark.createDataFrame(rows, METRIC_SCHEMA), best


def param_grid(estimator, grid: dict | None = None):
    """T5: every combination of the grid's values; by default the regParam x
    elasticNetParam x maxIter grid. An empty grid is the estimator as it is."""
    b = ParamGridBuilder()
    for name, values in (LR_GRID if grid is None else grid).items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def evaluator_for(metric: str):
    """(name -> larger is better) AUC or weighted F1 of predictions."""
    if metric == "areaUnderROC":
        return BinaryClassificationEvaluator(metricName=metric)
    if metric == "f1":
        return MulticlassClassificationEvaluator(metricName=metric)
    raise ValueError(metric)


def cross_validate(raw_train: DataFrame, inputs: Sequence[str] | None = None, grid: dict | None = None,
                   folds: int = 5, parallelism: int = 8, estimator=None, metric: str = "areaUnderROC"):
    """T6 + T7: k-fold cross-validation of a classifier (by default logistic
    regression by AUC; gradient-boosted trees by weighted F1 with an empty
    grid is the source's other run). Folds come from a hash of the user id
    (reproducible on any partitioning). The transforms of all folds come from
    one aggregate (``folds``) and are expressions over one checkpointed
    table; every candidate of every fold is fitted on its own,
    ``parallelism`` at a time. Returns the pipeline refitted on all rows with
    the best candidate, and the table."""
    estimator = logistic_regression() if estimator is None else estimator
    params, by = param_grid(estimator, grid), evaluator_for(metric)
    fold = (mlprep.split_bucket() % folds).cast("int")
    data = materialize(raw_train.withColumn("fold", fold))
    found = fold_statistics(data, inputs)
    missing = [k for k in range(folds) if k not in found.rows]
    if missing:
        raise ValueError(f"folds without rows: {missing}; use fewer folds or a larger data set")
    vectors = [data.select("fold", "label", scaled_vector(found.without(k)).alias("scaled_features")) for k in range(folds)]

    def one(task):
        i, k = task
        inside, outside = (vectors[k].where(c) for c in (F.col("fold") != k, F.col("fold") == k))
        return by.evaluate(estimator.fit(inside, params[i]).transform(outside))

    tasks = [(i, k) for i in range(len(params)) for k in range(folds)]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(one, tasks)
    metrics = [scores[i * folds:(i + 1) * folds] for i in range(len(params))]
    names = list(LR_GRID if grid is None else grid)
    rows = [tuple(float(pm[estimator.getParam(n)]) for n in names) + (sum(m) / folds,)
            for pm, m in zip(params, metrics)]
    best = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
    chosen = estimator.copy(params[best])
    model = Pipeline(stages=[*mlprep.transform_stages(inputs), chosen]).fit(data)
    value = "avg_auc" if metric == "areaUnderROC" else "avg_f1"
    table = raw_train.sparkSession.createDataFrame(
        [r + (i == best,) for i, r in enumerate(rows)], [*names, value, "is_best"])
    return model, table
