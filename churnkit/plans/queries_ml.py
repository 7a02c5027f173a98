"""Registered ML preparation, evaluation, training and scoring queries.

Keys whose output is a deterministic function of the tables (indexing,
encoding, assembling, scaling, the split, evaluator arithmetic on a fixed
scorer) carry DuckDB SQL; keys built on fitted models are rows-only.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.operators import clean, evaluate, explain, folds, mlprep, roc, score, train
from churnkit.plans import oracle as O
from churnkit.plans.registry import events, register, user_table
from churnkit.plans.oracle import TEST_FEATURE_COLUMNS as FEATURE_COLUMNS, TEST_PAGES, TEST_PAGE_COLUMNS as PAGE_COLUMNS
from churnkit.schema import CATEGORICAL_COLUMNS
from churnkit.session import reliable_checkpoint, scratch_path

W = O.with_ctes
NUMERIC = list(mlprep.NUMERIC_INPUTS)
_STRINGS = ("userId", "gender", "state")


def _filled_sql():
    cols = []
    for c in FEATURE_COLUMNS:
        if c in _STRINGS:
            cols.append(c)
        elif c == "churn_label":
            cols.append("CAST(coalesce(churn_label, 0) AS INTEGER) AS churn_label")
        else:
            cols.append(f"coalesce({c}, 0) AS {c}")
    return "filled AS (SELECT " + ", ".join(cols) + " FROM features)"


def _idx_sql(c):
    return (f"{c}_idx AS (SELECT {c}, CAST(row_number() OVER (ORDER BY n DESC, {c}) - 1 AS DOUBLE) AS idx "
            f"FROM (SELECT {c}, count(*) AS n FROM features WHERE {c} IS NOT NULL GROUP BY {c}))")


ML_CTES = ",\n".join([_filled_sql(), _idx_sql("state"), _idx_sql("gender")])


def _users_filled(spark, sf_dir):
    return mlprep.label_cast(mlprep.fill_nulls(user_table(spark, sf_dir)))


def _fit_input(users):
    """The user table checkpointed once before a fit + transform: the fit's
    jobs and the transformed result then read the checkpoint instead of
    each recomputing the feature job over the event log."""
    return reliable_checkpoint(users)


# ---------------------------------------------------------------------------
# M: preparation
# ---------------------------------------------------------------------------

@register("string_index", W(
    "SELECT f.userId, f.gender, coalesce(g.idx, (SELECT count(*) FROM gender_idx)) AS gender_index, "
    "f.state, coalesce(s.idx, (SELECT count(*) FROM state_idx)) AS state_index FROM features f "
    "LEFT JOIN gender_idx g ON f.gender = g.gender LEFT JOIN state_idx s ON f.state = s.state",
    "features", extra=ML_CTES))
def q_string_index(spark, sf_dir):
    users = _fit_input(user_table(spark, sf_dir))
    model = mlprep.string_indexer().fit(users)
    return model.transform(users).select("userId", "gender", "gender_index", "state", "state_index")


@register("label_cast", W("SELECT userId, churn_label, CAST(churn_label AS DOUBLE) AS label FROM features",
                          "features"))
def q_label_cast(spark, sf_dir):
    return mlprep.label_cast(user_table(spark, sf_dir)).select("userId", "churn_label", "label")


@register("one_hot", W(
    "SELECT f.userId, 'state_encoded' AS feature, CAST(s.idx AS INTEGER) AS slot, 1.0 AS value FROM features f "
    "JOIN state_idx s ON f.state = s.state UNION ALL "
    "SELECT f.userId, 'gender_encoded', CAST(g.idx AS INTEGER), 1.0 FROM features f "
    "JOIN gender_idx g ON f.gender = g.gender", "features", extra=ML_CTES))
def q_one_hot(spark, sf_dir):
    users = _fit_input(user_table(spark, sf_dir))
    indexed = mlprep.string_indexer().fit(users).transform(users)
    encoded = mlprep.one_hot_encoder().fit(indexed).transform(indexed)
    # both encoded vectors unfolded in one pass over the user table
    vectors = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), vector_to_array(c).alias("v"))
                                  for c in map(mlprep.encoded_col, CATEGORICAL_COLUMNS)]))
    long = (encoded.select("userId", vectors.alias("f"))
            .select("userId", F.col("f.feature").alias("feature"), F.posexplode("f.v").alias("slot", "value")))
    return long.filter(F.col("value") != 0).withColumn("slot", F.col("slot").cast("int"))


def _assembled_sql():
    n = len(NUMERIC)
    numeric = " UNION ALL ".join(
        f"SELECT userId, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM filled" for i, c in enumerate(NUMERIC))
    return W(
        "SELECT userId, CAST(pos AS INTEGER) AS pos, value FROM (" + numeric +
        f" UNION ALL SELECT f.userId, {n} + CAST(s.idx AS INTEGER), 1.0 FROM features f "
        "JOIN state_idx s ON f.state = s.state"
        f" UNION ALL SELECT f.userId, {n} + CAST((SELECT count(*) FROM state_idx) AS INTEGER)"
        " + CAST(g.idx AS INTEGER), 1.0 FROM features f JOIN gender_idx g ON f.gender = g.gender"
        ") WHERE value <> 0", "features", extra=ML_CTES)


@register("assemble_features", _assembled_sql())
def q_assemble_features(spark, sf_dir):
    users = _fit_input(_users_filled(spark, sf_dir))
    stages = mlprep.transform_stages()[:3]
    from pyspark.ml import Pipeline
    out = Pipeline(stages=stages).fit(users).transform(users)
    return mlprep.vector_long(out, "features", nonzero=True)


def _scaled_sql():
    numeric = " UNION ALL ".join(
        f"SELECT userId, {i} AS pos, CAST({c} AS DOUBLE) AS x FROM filled" for i, c in enumerate(NUMERIC))
    return W(
        "SELECT userId, CAST(pos AS INTEGER) AS pos, "
        "round(CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (x - mu) / sd END, 6) + 0.0 AS value FROM ("
        "SELECT userId, pos, x, avg(x) OVER (PARTITION BY pos) AS mu, "
        "stddev_samp(x) OVER (PARTITION BY pos) AS sd FROM (" + numeric + "))",
        "features", extra=_filled_sql())


@register("standard_scale", _scaled_sql())
def q_standard_scale(spark, sf_dir):
    from pyspark.ml import Pipeline
    users = _fit_input(_users_filled(spark, sf_dir))
    out = Pipeline(stages=[mlprep.assembler(NUMERIC), mlprep.scaler()]).fit(users).transform(users)
    long = mlprep.vector_long(out, "scaled_features", digits=6)
    return long.withColumn("value", F.col("value") + F.lit(0.0))


SPLIT_SQL = (
    "SELECT userId, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS split "
    "FROM (SELECT userId, CAST(('0x' || substr(md5(userId), 1, 8)) AS BIGINT) % 100 AS b FROM features)")


@register("train_val_test_split", W(SPLIT_SQL, "features"))
def q_train_val_test_split(spark, sf_dir):
    return mlprep.assign_split(user_table(spark, sf_dir)).select("userId", "split")


def _train_idx_sql(c):
    return (f"{c}_idx AS (SELECT {c}, row_number() OVER (ORDER BY n DESC, {c}) - 1 AS idx FROM "
            f"(SELECT {c}, count(*) AS n FROM users WHERE {c} IS NOT NULL AND split = 'train' GROUP BY {c}))")


def _transform_sql():
    """Every slot of every user: numeric inputs and one-hot slots of the
    training split's categories, scaled by the training split's moments."""
    n = len(NUMERIC)
    numeric = " UNION ALL ".join(
        f"SELECT userId, split, {i} AS pos, CAST({c} AS DOUBLE) AS x FROM users" for i, c in enumerate(NUMERIC))
    slots = " UNION ALL ".join(
        f"SELECT u.userId, u.split, {n} + {shift} + i.idx, CASE WHEN u.{c} = i.{c} THEN 1.0 ELSE 0.0 END "
        f"FROM users u CROSS JOIN {c}_idx i"
        for c, shift in (("state", "0"), ("gender", "(SELECT count(*) FROM state_idx)")))
    return ",\n".join([
        _filled_sql(), f"splits AS ({SPLIT_SQL})", "users AS (SELECT f.*, s.split FROM filled f JOIN splits s USING (userId))",
        _train_idx_sql("state"), _train_idx_sql("gender"), f"vals AS ({numeric} UNION ALL {slots})",
        "moments AS (SELECT pos, avg(x) AS mu, stddev_samp(x) AS sd FROM vals WHERE split = 'train' GROUP BY pos)"])


@register("feature_transform", W(  # M6
    "SELECT v.userId, v.split, CAST(v.pos AS INTEGER) AS pos, "
    "round(CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (x - mu) / sd END, 6) + 0.0 AS value "
    "FROM vals v JOIN moments m ON v.pos = m.pos", "features", extra=_transform_sql()))
def q_feature_transform(spark, sf_dir):
    return _transformed(train.PreparedSplits(user_table(spark, sf_dir)))


def _transformed(s):
    parts = [mlprep.vector_long(df.withColumn("split", F.lit(name)), "scaled_features", digits=6, keep=("split",))
             for name, df in (("train", s.train), ("validation", s.validation), ("test", s.test))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("value", F.col("value") + F.lit(0.0))


@register("splits_json_roundtrip", W(
    "SELECT v.userId, v.split, CAST(v.pos AS INTEGER) AS pos, "
    "round(CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (x - mu) / sd END, 6) + 0.0 AS value "
    "FROM vals v JOIN moments m ON v.pos = m.pos", "features", extra=_transform_sql()))
def q_splits_json_roundtrip(spark, sf_dir):
    """The three transformed splits written as JSON and read again."""
    from churnkit.sources import io
    s = train.PreparedSplits(user_table(spark, sf_dir))
    out = None
    for name, df in (("train", s.train), ("validation", s.validation), ("test", s.test)):
        path = scratch_path(spark, f"{name}-json")
        io.write_split_json(df, path)
        part = io.read_split_json(spark, path).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    rows = out.select("userId", "split", F.posexplode("scaled_features").alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 6) + F.lit(0.0)).withColumn("pos", F.col("pos").cast("int"))


# ---------------------------------------------------------------------------
# E: evaluation on the fixed error-share scorer (exact oracles)
# ---------------------------------------------------------------------------

_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in PAGE_COLUMNS)
RULE = (f"rule AS (SELECT userId, CAST(churn_label AS DOUBLE) AS label, "
        f"CAST(Error AS DOUBLE) / nullif({_TOTAL}, 0) AS score FROM features), "
        "rule_pred AS (SELECT userId, label, score, CASE WHEN score > 0.2 THEN 1.0 ELSE 0.0 END AS prediction "
        "FROM rule)")
COUNTS = ("counts AS (SELECT count(*) FILTER (WHERE prediction = 1.0 AND label = 1.0) AS tp, "
          "count(*) FILTER (WHERE prediction = 1.0 AND label = 0.0) AS fp, "
          "count(*) FILTER (WHERE prediction = 0.0 AND label = 0.0) AS tn, "
          "count(*) FILTER (WHERE prediction = 0.0 AND label = 1.0) AS fn FROM rule_pred)")


def _d(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"


METRICS_SQL = (
    "SELECT " + _d("tp + tn", "n") + " AS accuracy, w0 * p0 + w1 * p1 AS weighted_precision, "
    "w0 * r0 + w1 * r1 AS weighted_recall, w0 * f0 + w1 * f1 AS weighted_f1, p1 AS churn_precision, "
    "r1 AS churn_recall, f1 AS churn_f1 FROM ("
    "SELECT *, " + _d("p1 * r1 * 2.0", "p1 + r1") + " AS f1, " + _d("p0 * r0 * 2.0", "p0 + r0") + " AS f0 FROM ("
    "SELECT *, " + _d("tp", "tp + fp") + " AS p1, " + _d("tp", "tp + fn") + " AS r1, "
    + _d("tn", "tn + fn") + " AS p0, " + _d("tn", "tn + fp") + " AS r0, "
    + _d("tp + fn", "n") + " AS w1, " + _d("tn + fp", "n") + " AS w0 FROM ("
    "SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, "
    "CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) + CAST(fp AS DOUBLE) + CAST(tn AS DOUBLE) + CAST(fn AS DOUBLE) AS n "
    "FROM counts)))")


def _rule(spark, sf_dir):
    return score.error_share_scores(user_table(spark, sf_dir), pages=TEST_PAGES)


@register("confusion_matrix", W("SELECT tp, fp, tn, fn FROM counts", "features", extra=RULE + ",\n" + COUNTS))
def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_counts(_rule(spark, sf_dir))


@register("confusion_pct", W(
    "SELECT " + ", ".join(f"{_d(f'CAST({c} AS DOUBLE)', 'CAST(tp + fp + tn + fn AS DOUBLE)')} * 100.0 AS {c}_pct"
                          for c in ("tp", "fp", "tn", "fn")) + " FROM counts",
    "features", extra=RULE + ",\n" + COUNTS))
def q_confusion_pct(spark, sf_dir):
    return evaluate.confusion_pct(evaluate.confusion_counts(_rule(spark, sf_dir)))


@register("classification_metrics", W(METRICS_SQL, "features", extra=RULE + ",\n" + COUNTS))
def q_classification_metrics(spark, sf_dir):
    return evaluate.classification_metrics(_rule(spark, sf_dir))


@register("metrics_on_churn_label", W(METRICS_SQL, "features", extra=RULE + ",\n" + COUNTS))
def q_metrics_on_churn_label(spark, sf_dir):
    """The same metrics scored against ``churn_label`` instead of ``label``
    (equal, since the label is the cast churn flag)."""
    pred = _rule(spark, sf_dir).withColumn("churn_label", F.col("churn_label").cast("double"))
    return evaluate.classification_metrics(pred, label="churn_label")


@register("auc", W(
    "SELECT round((sum(r) FILTER (WHERE label = 1.0) - npos * (npos + 1) / 2.0) / (npos * nneg), 6) AS auc, "
    "CAST(npos AS BIGINT) AS n_pos, CAST(nneg AS BIGINT) AS n_neg FROM ("
    "SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r, "
    "count(*) FILTER (WHERE label = 1.0) OVER () AS npos, count(*) FILTER (WHERE label = 0.0) OVER () AS nneg "
    "FROM rule_pred) GROUP BY npos, nneg", "features", extra=RULE))
def q_auc(spark, sf_dir):
    pred = _fit_input(_rule(spark, sf_dir))  # read by the evaluator's jobs and by the counts
    value = evaluate.area_under_roc(pred, raw="rawPrediction", num_bins=0)
    counts = pred.agg(F.count_if(F.col("label") == 1.0).alias("n_pos"),
                      F.count_if(F.col("label") == 0.0).alias("n_neg"))
    return counts.select(F.round(F.lit(value), 6).alias("auc"), "n_pos", "n_neg")


# -- ROC curves of two fixed scorers in one pass --------------------------------

ROC_SQL = RULE + """,
scorers AS (
  SELECT 'errors' AS model, label, score FROM rule UNION ALL
  SELECT 'adverts', CAST(churn_label AS DOUBLE), CAST(Roll_Advert AS DOUBLE) / nullif(""" + _TOTAL + """, 0) FROM features),
counted AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1.0) AS pos, count(*) FILTER (WHERE label = 0.0) AS neg
  FROM scorers GROUP BY model, score),
points AS (
  SELECT model, score AS threshold, pos, neg,
         CAST(sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS BIGINT) AS fp,
         CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS p, CAST(sum(neg) OVER (PARTITION BY model) AS BIGINT) AS n
  FROM counted)"""


def _scorers(spark, sf_dir):
    users = user_table(spark, sf_dir)
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in PAGE_COLUMNS), F.lit(0))
    scores = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.try_divide(F.col(c).cast("double"), total).alias("score"))
                                 for m, c in (("errors", "Error"), ("adverts", "Roll_Advert"))]))
    return users.select(F.col("churn_label").cast("double").alias("label"), scores.alias("s")).select("label", "s.*")


@register("roc_points", W(
    "SELECT model, threshold, tp, fp, CAST(tp AS DOUBLE) / p AS tpr, CAST(fp AS DOUBLE) / n AS fpr FROM points",
    "features", extra=ROC_SQL))
def q_roc_points(spark, sf_dir):
    return roc.roc_curve(roc.roc_points(_scorers(spark, sf_dir)))


@register("roc_summary", W(
    "SELECT model, max(p) AS n_pos, max(n) AS n_neg, sum(neg * (2 * tp - pos)) / (2.0 * max(p) * max(n)) AS area_under_roc, "
    "max(2.0 * tp / (tp + fp + p)) AS best_f1, arg_max(threshold, (2.0 * tp / (tp + fp + p), threshold)) AS best_threshold "
    "FROM points GROUP BY model", "features", extra=ROC_SQL))
def q_roc_summary(spark, sf_dir):
    return roc.roc_summary(reliable_checkpoint(roc.roc_points(_scorers(spark, sf_dir))))


@register("index_large_vocabulary", W(
    "SELECT u.userId, u.location, CAST(i.idx AS DOUBLE) AS location_index FROM users u JOIN (SELECT location, "
    "row_number() OVER (ORDER BY count(*) DESC, location) - 1 AS idx FROM users GROUP BY location) i USING (location)",
    "event_log", extra="users AS (SELECT DISTINCT userId, location FROM event_log WHERE userId <> '')"))
def q_index_large_vocabulary(spark, sf_dir):
    """M1 without a vocabulary on the driver: the users' locations."""
    users = clean.filter_missing_user(events(spark, sf_dir)).select("userId", "location").distinct()
    users = _fit_input(users)
    index = _fit_input(mlprep.frequency_index(users, "location"))
    return mlprep.with_frequency_index(users, "location", index)


# ---------------------------------------------------------------------------
# T / R: fitted models (rows-only)
# ---------------------------------------------------------------------------

def _splits(spark, sf_dir):
    return train.PreparedSplits(user_table(spark, sf_dir))


def _fit_predict(spark, sf_dir, name):
    s = _splits(spark, sf_dir)
    model, _, pred = train.train_and_evaluate(train.ESTIMATORS[name](), s.train, s.validation)
    return score.scored(pred)


@register("train_lr")
def q_train_lr(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "Logistic Regression")


@register("train_rf")
def q_train_rf(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "Random Forest")


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "Gradient Boosted Trees")


# -- models with a known answer: one binary input ------------------------------
# With a single 0/1 input every model below can only learn the two groups'
# churn shares, which SQL can count.

_GROUP_SQL = (
    "SELECT userId, round({value}, 4) AS churn_probability FROM (SELECT userId, split, avg(CASE WHEN split = 'train' "
    "THEN CAST(churn_label AS DOUBLE) END) OVER (PARTITION BY total_items % 2) AS share, avg(CASE WHEN split = 'train' "
    "THEN CAST(churn_label AS DOUBLE) END) OVER () AS overall FROM features "
    "JOIN (" + SPLIT_SQL + ") USING (userId)) WHERE split = 'validation'")


def _on_parity(spark, sf_dir, estimator):
    """Fit on the parity of a user's item total; score the validation split."""
    from pyspark.ml.feature import VectorAssembler
    users = mlprep.label_cast(user_table(spark, sf_dir).select("userId", "churn_label", "total_items"))
    users = users.withColumn("odd", (F.coalesce("total_items", F.lit(0)) % 2).cast("double"))
    users = _fit_input(VectorAssembler(inputCols=["odd"], outputCol="features").transform(users))
    fit_on, check_on, _ = mlprep.split_users(users)
    pred = estimator.fit(fit_on).transform(check_on)
    return score.scored(pred).select("userId", F.round("churn_probability", 4).alias("churn_probability"))


@register("lr_known_answer", W(_GROUP_SQL.format(value="share"), "features"))
def q_lr_known_answer(spark, sf_dir):
    """Unregularised logistic regression fits the groups' log odds."""
    return _on_parity(spark, sf_dir, train.logistic_regression("features", tol=1e-10))


@register("forest_known_answer", W(_GROUP_SQL.format(
    value="CASE WHEN (min(share) OVER () > 0.5) = (max(share) OVER () > 0.5) THEN overall ELSE share END"), "features"))
def q_forest_known_answer(spark, sf_dir):
    """One tree of depth 1, not bootstrapped, has the shares as leaves,
    merged into one where both predict the same class."""
    return _on_parity(spark, sf_dir, train.random_forest("features").setNumTrees(1).setMaxDepth(1).setBootstrap(False))


@register("boosting_known_answer", W(_GROUP_SQL.format(value="1 / (1 + exp(-2 * (2 * share - 1)))"), "features"))
def q_boosting_known_answer(spark, sf_dir):
    """The first boosted tree predicts the mean of labels -1 and 1, and
    the probability is the logistic function of twice that."""
    return _on_parity(spark, sf_dir, train.gradient_boosted_trees("features").setMaxIter(1).setMaxDepth(1))


# -- what these models make of it: metrics, churners, coefficients, contributions --

PARITY_SQL = """
users AS (SELECT userId, CAST(churn_label AS DOUBLE) AS label, CAST(coalesce(total_items, 0) % 2 AS DOUBLE) AS odd, split, b
          FROM features JOIN (""" + SPLIT_SQL.replace("END AS split", "END AS split, b") + """) USING (userId)),
fit AS (SELECT avg(label) FILTER (odd = 1) AS s1, avg(label) FILTER (odd = 0) AS s0, avg(label) AS s, avg(odd) AS mean,
               stddev_samp(odd) AS sd FROM users WHERE split = 'train'),
fitted AS (SELECT *, ln(s1 / (1 - s1)) - ln(s0 / (1 - s0)) AS slope FROM fit),
known AS (SELECT userId, label, odd, CASE WHEN odd = 1 THEN s1 ELSE s0 END AS share, s, mean, slope, split FROM users, fitted),
rule_pred AS (SELECT userId, label, share AS score, CASE WHEN share > s THEN 1.0 ELSE 0.0 END AS prediction
              FROM known WHERE split = 'validation')"""


class _Parity:
    """The user table reduced to the parity of the item total (and a constant
    input), its splits, and a logistic regression that calls a user a churner
    above the training split's churn share."""

    def __init__(self, spark, sf_dir):
        from pyspark.ml.feature import VectorAssembler
        users = mlprep.label_cast(user_table(spark, sf_dir).select("userId", "churn_label", "total_items"))
        users = users.withColumns({"odd": (F.coalesce("total_items", F.lit(0)) % 2).cast("double"), "same": F.lit(1.0)})
        users = _fit_input(VectorAssembler(inputCols=["odd", "same"], outputCol="features").transform(users))
        self.train, self.validation, self.test = mlprep.split_users(users)
        self.share = self.train.agg(F.avg("label")).first()[0]

    def regression(self, **kw):
        return train.logistic_regression(**{"features": "features", "tol": 1e-12, "threshold": self.share, **kw}).fit(self.train)

    def boosted(self):
        """One tree of depth 1: its probability is 1 / (1 + exp(-2 (2 share - 1)))."""
        import math
        cut = 1 / (1 + math.exp(-2 * (2 * self.share - 1)))
        one = train.gradient_boosted_trees("features").setMaxIter(1).setMaxDepth(1)
        return one.setThresholds([1 - cut, cut]).fit(self.train)


_AUC_SQL = ("(SELECT (sum(r) FILTER (WHERE label = 1.0) - max(p) * (max(p) + 1) / 2.0) / (max(p) * max(n)) FROM (SELECT label, "
            "rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r, "
            "count(*) FILTER (WHERE label = 1.0) OVER () AS p, count(*) FILTER (WHERE label = 0.0) OVER () AS n FROM rule_pred))")


@register("known_comparison", W(
    "SELECT v.model, round(weighted_f1, 6) AS f1_score, round(" + _AUC_SQL + ", 6) AS area_under_roc, round(accuracy, 6) AS accuracy, "
    "round(weighted_precision, 6) AS precision, round(weighted_recall, 6) AS recall, round(churn_f1, 6) AS churn_f1, "
    "v.model = 'Logistic Regression' AS is_best FROM (" + METRICS_SQL + ") m, (VALUES ('Logistic Regression'), "
    "('Gradient Boosted Trees')) AS v(model)", "features", extra=PARITY_SQL + ",\n" + COUNTS))
def q_known_comparison(spark, sf_dir):
    """Two models whose predictions SQL can make; the first of
    equal F1 is the best."""
    p = _Parity(spark, sf_dir)
    table, best = train.compare_models(spark, [("Logistic Regression", p.regression()),
                                               ("Gradient Boosted Trees", p.boosted())], p.validation)
    names = ("f1_score", "area_under_roc", "accuracy", "precision", "recall", "churn_f1")
    return table.select("model", *[F.round(c, 6).alias(c) for c in names], (F.col("model") == best[0]).alias("is_best"))


@register("known_confusion", W("SELECT v.model, tp, fp, tn, fn FROM counts, (VALUES ('Logistic Regression'), "
                               "('Gradient Boosted Trees')) AS v(model)", "features", extra=PARITY_SQL + ",\n" + COUNTS))
def q_known_confusion(spark, sf_dir):
    """The confusion counts of two models, cell by cell."""
    p = _Parity(spark, sf_dir)
    return evaluate.confusion_comparison([("Logistic Regression", p.regression().transform(p.validation)),
                                          ("Gradient Boosted Trees", p.boosted().transform(p.validation))])


@register("known_predicted_churners", W(
    "SELECT userId, prediction, round(score, 6) AS churn_probability, label FROM rule_pred WHERE prediction = 1.0",
    "features", extra=PARITY_SQL))
def q_known_predicted_churners(spark, sf_dir):
    """R2."""
    p = _Parity(spark, sf_dir)
    found = score.predicted_churners(p.regression().transform(p.validation))
    return found.withColumn("churn_probability", F.round("churn_probability", 6))


@register("known_actual_churners", W(
    "SELECT userId, prediction, round(score, 6) AS churn_probability, label FROM rule_pred WHERE label = 1.0",
    "features", extra=PARITY_SQL))
def q_known_actual_churners(spark, sf_dir):
    """R3."""
    p = _Parity(spark, sf_dir)
    found = score.actual_churners(p.regression().transform(p.validation))
    return found.withColumn("churn_probability", F.round("churn_probability", 6))


@register("known_coefficients", W(
    "SELECT CAST(0 AS INTEGER) AS idx, 'odd' AS feature, round(sd * slope, 4) AS coefficient, round(abs(sd * slope), 4) "
    "AS abs_coefficient FROM fitted UNION ALL SELECT 1, 'same', 0.0, 0.0", "features", extra=PARITY_SQL))
def q_known_coefficients(spark, sf_dir):
    """On scaled inputs the coefficient is the input's deviation times
    the log odds ratio."""
    p = _Parity(spark, sf_dir)
    scaled = mlprep.scaler().fit(p.train).transform(p.train)
    model = train.logistic_regression(tol=1e-12).fit(scaled)
    table = score.top_features(score.coefficient_table(spark, model, p.train), 10)
    return table.select("idx", "feature", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("coefficient", "abs_coefficient")])


@register("known_importances", "SELECT CAST(0 AS INTEGER) AS idx, 'odd' AS feature, CAST(1.0 AS DOUBLE) AS importance "
                               "UNION ALL SELECT 1, 'same', 0.0")
def q_known_importances(spark, sf_dir):
    """All importance lies on the one input that splits."""
    p = _Parity(spark, sf_dir)
    return score.feature_importance(spark, p.boosted(), p.train)


@register("known_topk_retrain", W(
    "SELECT round(weighted_f1, 6) AS weighted_f1, round(accuracy, 6) AS accuracy, round(churn_f1, 6) AS churn_f1 FROM ("
    + METRICS_SQL + ")", "features", extra=PARITY_SQL + ",\n" + COUNTS))
def q_known_topk_retrain(spark, sf_dir):
    """The best input alone, scaled again, gives the same predictions."""
    p = _Parity(spark, sf_dir)
    table = score.coefficient_table(spark, p.regression(), p.train)
    indices = [r["idx"] for r in score.top_features(table, 1).collect()]
    top = score.topk_estimator(indices)
    top.getStages()[-1].setThreshold(p.share).setTol(1e-12)
    metrics = evaluate.classification_metrics(top.fit(p.train).transform(p.validation))
    return metrics.select(*[F.round(c, 6).alias(c) for c in ("weighted_f1", "accuracy", "churn_f1")])


@register("lr_contributions", W(
    "SELECT userId, 'odd' AS feature, round(slope * (odd - mean), 4) AS contribution, "
    "round(ln(share / (1 - share)), 4) AS log_odds FROM known WHERE split = 'validation' UNION ALL "
    "SELECT userId, 'same', 0.0, round(ln(share / (1 - share)), 4) FROM known WHERE split = 'validation'",
    "features", extra=PARITY_SQL))
def q_lr_contributions(spark, sf_dir):
    """R5 for single users: contributions, and the log odds they add up to."""
    p = _Parity(spark, sf_dir)
    found = explain.lr_contributions(p.regression(), p.validation, explain.mean_vector(p.train, "features"), "features")
    return _with_total(found, "log_odds")


@register("tree_contributions", W(
    "SELECT userId, feature, CASE feature WHEN 'odd' THEN round(2 * (share - s), 4) + 0.0 ELSE 0.0 END AS contribution, "
    "round(2 * share - 1, 4) AS raw_score FROM known, (VALUES ('odd'), ('same')) AS v(feature) WHERE split = 'validation'",
    "features", extra=PARITY_SQL))
def q_tree_contributions(spark, sf_dir):
    """R7 for single users: Shapley values of boosted trees."""
    p = _Parity(spark, sf_dir)
    return _with_total(explain.tree_contributions(p.boosted(), p.validation, "features"), "raw_score")


def _with_total(found, name):
    from pyspark.sql import Window
    total = F.col("base_value") + F.sum("contribution").over(Window.partitionBy("userId"))  # a row per slot of a user
    return found.select("userId", "feature", (F.round("contribution", 4) + F.lit(0.0)).alias("contribution"),
                        F.round(total, 4).alias(name))


def _fold_sql():
    numeric = " UNION ALL ".join(
        f"SELECT fold, '{c}' AS input, '' AS category, CAST({c} AS DOUBLE) AS x FROM folded" for c in NUMERIC)
    slots = " UNION ALL ".join(
        f"SELECT f.fold, '{c}', v.{c}, CASE WHEN f.{c} = v.{c} THEN 1.0 ELSE 0.0 END FROM folded f, "
        f"(SELECT DISTINCT {c} FROM folded WHERE {c} IS NOT NULL) v" for c in CATEGORICAL_COLUMNS)
    return W(
        "SELECT k.fold, v.input, v.category, count(*) AS n, round(avg(x), 4) + 0.0 AS mean, round(stddev_samp(x), 4) + 0.0 AS sd "
        "FROM vals v, (SELECT DISTINCT fold FROM folded) k WHERE v.fold <> k.fold GROUP BY k.fold, v.input, v.category "
        "HAVING v.category = '' OR sum(x) > 0", "features", extra=",\n".join([
            _filled_sql(), "folded AS (SELECT f.*, CAST(b % 5 AS INTEGER) AS fold FROM filled f JOIN ("
            + SPLIT_SQL.replace("END AS split", "END AS split, b") + ") USING (userId) WHERE b < 70)",
            f"vals AS ({numeric} UNION ALL {slots})"]))


@register("cv_fold_moments", _fold_sql())
def q_cv_fold_moments(spark, sf_dir):
    """Mean and deviation of every slot of every fold's transform, merged
    from one aggregate over the folds."""
    users, _, _ = mlprep.split_users(_users_filled(spark, sf_dir))
    data = users.withColumn("fold", (mlprep.split_bucket() % 5).cast("int"))
    found = folds.fold_statistics(data)
    rows = [(k, c, value or "", m.n, m.mean, m.sd) for k in sorted(found.rows) for c, value, m in found.without(k)]
    table = spark.createDataFrame(rows, "fold int, input string, category string, n long, mean double, sd double")
    return table.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in ("mean", "sd")})


def _cv_sql():
    """Two candidates whose scores only order the two groups: a fold's area
    follows from the groups' shares in the other folds."""
    return W(
        "SELECT v.reg AS \"regParam\", round(avg(auc), 6) AS avg_auc, v.reg = 0.0 AS is_best FROM (SELECT fold, CASE WHEN s1 = s0 THEN 0.5 ELSE CASE WHEN s1 > s0 "
        "THEN (p1 * n0 + 0.5 * (p1 * n1 + p0 * n0)) ELSE (p0 * n1 + 0.5 * (p1 * n1 + p0 * n0)) END / ((p0 + p1) * (n0 + n1)) END AS auc "
        "FROM (SELECT k.fold, avg(label) FILTER (u.fold <> k.fold AND odd = 1) AS s1, avg(label) FILTER (u.fold <> k.fold AND odd = 0) "
        "AS s0, " + ", ".join(
            f"count(*) FILTER (u.fold = k.fold AND odd = {o} AND label = {y}) AS {'np'[y]}{o}" for o in (0, 1) for y in (0, 1))
        + " FROM folded u, (SELECT DISTINCT fold FROM folded) k GROUP BY k.fold)), (VALUES (0.0), (0.01)) AS v(reg) GROUP BY v.reg",
        "features", extra=PARITY_SQL + ",\nfolded AS (SELECT *, b % 5 AS fold FROM users WHERE split = 'train')")


@register("known_cross_validation", _cv_sql())
def q_known_cross_validation(spark, sf_dir):
    """5 folds, two candidates; the first of equal area is chosen."""
    users = mlprep.label_cast(mlprep.fill_nulls(user_table(spark, sf_dir)))
    users = users.withColumn("odd", (F.col("total_items") % 2).cast("double"))
    fit_on, _, _ = mlprep.split_users(_fit_input(users))
    _, table = train.cross_validate(fit_on, ["odd"], grid={"regParam": (0.0, 0.01)})
    return table.select("regParam", F.round("avg_auc", 6).alias("avg_auc"), "is_best")


@register("train_and_evaluate")
def q_train_and_evaluate(spark, sf_dir):
    s = _splits(spark, sf_dir)
    _, metrics, _ = train.train_and_evaluate(train.logistic_regression(), s.train, s.validation)
    return spark.createDataFrame([train.metric_row("Logistic Regression", metrics)], list(train.METRIC_COLUMNS))


def _all_models(spark, sf_dir):
    s = _splits(spark, sf_dir)
    fitted = [(name, make().fit(s.train)) for name, make in train.ESTIMATORS.items()]
    return s, fitted


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    s, fitted = _all_models(spark, sf_dir)
    table, _ = train.compare_models(spark, fitted, s.validation)
    return table


@register("select_best_model")
def q_select_best_model(spark, sf_dir):
    s, fitted = _all_models(spark, sf_dir)
    table, best = train.compare_models(spark, fitted, s.validation)
    return table.filter(F.col("model") == best[0]).select("model", "f1_score", "area_under_roc")


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    """Grid search by 5-fold AUC; the best row also carries the tuned
    model's AUC and weighted F1 on the validation and test splits."""
    s = _splits(spark, sf_dir)
    return _with_scores(s, *train.cross_validate(s.raw_train, s.inputs))


def _with_scores(s, model, table):
    """The candidates, the best row with the tuned model's scores."""
    scores = {}
    for split, df in (("validation", s.raw_validation), ("test", s.raw_test)):
        pred = model.transform(df)
        scores[f"{split}_auc"] = evaluate.area_under_roc(pred)
        scores[f"{split}_f1"] = evaluate.classification_metrics(pred).first()["weighted_f1"]
    for name, value in scores.items():
        table = table.withColumn(name, F.when(F.col("is_best"), F.lit(value)))
    return table


def _tuned_gbt(spark, sf_dir):
    s = _splits(spark, sf_dir)
    return s, *train.cross_validate(s.raw_train, s.inputs, grid={}, estimator=train.gradient_boosted_trees(),
                                    metric="f1")


@register("cross_validate_gbt_scores")
def q_cross_validate_gbt_scores(spark, sf_dir):
    """T5-T8 as the source's other run: boosted trees by weighted F1 over an
    empty grid (one candidate, the estimator as it is), 5 folds; the row also
    carries the refitted model's scores on the validation and test splits."""
    return _with_scores(*_tuned_gbt(spark, sf_dir))


@register("cross_validate_gbt", W(
    "SELECT CAST(count(*) AS BIGINT) AS n_users, CAST(1 AS BIGINT) AS n_candidates, TRUE AS in_range FROM ("
    + SPLIT_SQL + ") WHERE split = 'train'", "features"))
def q_cross_validate_gbt(spark, sf_dir):
    """What can be counted of ``cross_validate_gbt_scores``."""
    s, _, table = _tuned_gbt(spark, sf_dir)
    scores = [r["avg_f1"] for r in table.collect()]  # a row per candidate
    return s.raw_train.agg(F.count(F.lit(1)).alias("n_users")).select(
        "n_users", F.lit(len(scores)).cast("bigint").alias("n_candidates"),
        F.lit(all(0 <= x <= 1 for x in scores)).alias("in_range"))


def _best_lr(spark, sf_dir):
    s = _splits(spark, sf_dir)
    model = train.logistic_regression().fit(s.train)
    return s, model


@register("score_users")
def q_score_users(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    return score.scored(model.transform(s.test))


@register("predicted_churners")
def q_predicted_churners(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    return score.predicted_churners(model.transform(s.test))


@register("actual_churners")
def q_actual_churners(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    return score.actual_churners(model.transform(s.test))


SAME_SQL = "SELECT userId, TRUE AS same FROM (" + SPLIT_SQL + ") WHERE split = 'test'"


def _same(before, after):
    """(userId, same): is each user's score the same, probability and all?"""
    after = after.select("userId", F.col("prediction").alias("q"), F.col("churn_probability").alias("p"))
    equal = (F.col("prediction") == F.col("q")) & (F.col("churn_probability") == F.col("p"))
    return before.join(after, "userId", "full").select("userId", F.coalesce(equal, F.lit(False)).alias("same"))


def _saved_pipeline(spark, sf_dir):
    from pyspark.ml import Pipeline
    s = _splits(spark, sf_dir)
    full = Pipeline(stages=[*mlprep.transform_stages(s.inputs), train.logistic_regression()]).fit(s.raw_train)
    path = scratch_path(spark, "model")
    score.save_model(full, path, s.inputs)
    return s, full, path


@register("score_with_saved_model")
def q_score_with_saved_model(spark, sf_dir):
    s, _, path = _saved_pipeline(spark, sf_dir)  # its splits come from one checkpointed user table
    return score.score_with_saved_model(spark, path, s.raw_test)


@register("score_unlabelled_users", W(SAME_SQL, "features"))
def q_score_unlabelled_users(spark, sf_dir):
    """R4 on users that carry no label: the same scores as with it."""
    s, _, path = _saved_pipeline(spark, sf_dir)
    known = score.score_with_saved_model(spark, path, s.raw_test)
    unknown = score.score_with_saved_model(spark, path, s.raw_test.drop("churn_label", "label"))
    return _same(known, unknown.where(F.col("label").isNull()))


@register("model_save_load", W(SAME_SQL, "features"))
def q_model_save_load(spark, sf_dir):
    s, full, path = _saved_pipeline(spark, sf_dir)
    loaded, _ = score.load_model(spark, path)
    return _same(score.scored(full.transform(s.raw_test)), score.scored(loaded.transform(s.raw_test)))


@register("predictions_parquet_roundtrip", W(SAME_SQL, "features"))
def q_predictions_parquet_roundtrip(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    pred = model.transform(s.test).select("userId", "prediction", "probability", "rawPrediction", "label")
    pred.write.mode("overwrite").parquet(path)
    return _same(score.scored(pred), score.scored(spark.read.parquet(path)))


@register("coefficient_ranking")
def q_coefficient_ranking(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    return score.top_features(score.coefficient_table(spark, model, s.train), 10)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    s = _splits(spark, sf_dir)
    rf = train.random_forest().fit(s.train)
    return score.feature_importance(spark, rf, s.train)


def _topk(spark, sf_dir):
    s, model = _best_lr(spark, sf_dir)
    top = score.top_features(score.coefficient_table(spark, model, s.train), 10)
    indices = [r["idx"] for r in top.select("idx").collect()]  # 10 slot numbers
    top_model = score.topk_estimator(indices).fit(s.train)
    return s, model, top_model


@register("topk_retrain")
def q_topk_retrain(spark, sf_dir):
    s, model, top_model = _topk(spark, sf_dir)
    rows = []
    for name, m in (("Logistic Regression all data", model), ("Logistic Regression top features", top_model)):
        for split, df in (("validation", s.validation), ("test", s.test)):
            pred = m.transform(df)
            met = evaluate.classification_metrics(pred).first().asDict()
            met["area_under_roc"] = evaluate.area_under_roc(pred)
            rows.append((split,) + train.metric_row(name, met))
    return spark.createDataFrame(rows, ["split", *train.METRIC_COLUMNS])


@register("confusion_comparison")
def q_confusion_comparison(spark, sf_dir):
    s, model, top_model = _topk(spark, sf_dir)
    return evaluate.confusion_comparison([("Logistic Regression all data", model.transform(s.test)),
                                          ("Logistic Regression top features", top_model.transform(s.test))])


# -- what SQL can say of the fitted results --------------------------------------

@register("confusion_totals", W(
    "SELECT m.model, CAST(count(*) FILTER (WHERE churn_label = 1) AS BIGINT) AS n_churned, "
    "CAST(count(*) FILTER (WHERE churn_label = 0) AS BIGINT) AS n_retained FROM features JOIN (" + SPLIT_SQL + ") USING (userId), "
    "(VALUES ('Logistic Regression all data'), ('Logistic Regression top features')) AS m(model) "
    "WHERE split = 'test' GROUP BY m.model", "features"))
def q_confusion_totals(spark, sf_dir):
    """Whatever the models say, their confusion counts add up to the test
    split's churners and others."""
    c = q_confusion_comparison(spark, sf_dir)
    return c.select(F.col(c.columns[0]).alias("model"), (F.col("tp") + F.col("fn")).alias("n_churned"),
                    (F.col("tn") + F.col("fp")).alias("n_retained"))


@register("best_model_is_argmax", "SELECT CAST(3 AS BIGINT) AS n_models, TRUE AS is_argmax")
def q_best_model_is_argmax(spark, sf_dir):
    """The chosen model is the first of largest weighted F1."""
    s, fitted = _all_models(spark, sf_dir)
    table, best = train.compare_models(spark, fitted, s.validation)
    return table.agg(F.count(F.lit(1)).alias("n_models"),
                     (F.max("f1_score") == F.lit(float(best[1]))).alias("is_argmax"))


@register("importance_slots", W(
    "SELECT CAST(count(*) AS BIGINT) AS n_slots, TRUE AS sums_to_one FROM (SELECT pos FROM moments)", "features",
    extra=_transform_sql()))
def q_importance_slots(spark, sf_dir):
    """One importance per vector slot, all of them adding up to 1."""
    t = q_feature_importance(spark, sf_dir)
    return t.agg(F.count_distinct("idx", "feature").alias("n_slots"),
                 (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
