"""Exact quartiles from sketches, whiskers, outliers; pages in one pass."""

import math
import random

import pytest
from pyspark.sql import functions as F

from churnkit.operators import boxplot, features
from churnkit.plans import registry
from churnkit.sources import io
from tests.conftest import SF001


def brute(values):
    vals = sorted(v for v in values if v is not None)
    q1, median, q3 = (vals[max(1, math.ceil(p * len(vals))) - 1] for p in boxplot.QUARTILES)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    within = [v for v in vals if low <= v <= high]
    return len(vals), vals[0], q1, median, q3, vals[-1], min(within), max(within), len(vals) - len(within)


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(1)
    rows = [(g, d, i, float(v)) for g, draw in (("normal", lambda: rng.gauss(0, 1)), ("few", lambda: rng.randrange(4)),
                                                (None, lambda: rng.paretovariate(1.0)), ("same", lambda: 7))
            for i, (d, v) in enumerate((rng.randrange(5), draw()) for _ in range(900))]
    rows += [("one", 0, 0, 3.5), ("none", 0, 0, None), ("normal", 0, -1, None)]
    return spark.createDataFrame(rows, "g string, day int, id int, value double").repartition(4).cache()


def check(values, box):
    found = {r.g: tuple(r[c] for c in ("n", "min_value", "q1", "median", "q3", "max_value", "lower_whisker", "upper_whisker",
                                       "n_outliers")) for r in box.collect()}
    groups = {}
    for r in values.collect():
        groups.setdefault(r.g, []).append(r.value)
    assert found.pop("none")[:6] == (0, None, None, None, None, None)
    assert found == {g: brute(v) for g, v in groups.items() if g != "none"}


def test_sketches_of_days_merge(spark, values):
    days = boxplot.value_sketches(values, ["g", "day"], k=50)
    merged = boxplot.merge_sketches(days, ["g"])
    check(values, boxplot.box_plot(values, boxplot.quartiles(values, ["g"], merged, k=50), ["g"]))


@pytest.mark.parametrize("slack", [0.0, -0.2, 0.9])
def test_a_missed_band_is_moved(spark, values, slack, monkeypatch):
    """Bands without reach, or turned inside out, miss ranks."""
    looks = []
    look = boxplot._look
    monkeypatch.setattr(boxplot, "_look", lambda *a: looks.append(1) or look(*a))
    box = boxplot.quartiles(values, ["g"], k=8, slack=slack)
    assert len(looks) == (1 if slack > 0.5 else 2)
    check(values, boxplot.box_plot(values, box, ["g"]))


def test_sketches_that_lie(spark, values):
    """Sketches of other values put every band in the wrong place."""
    for shift in (-1e6, 1e6):
        other = boxplot.value_sketches(values.withColumn("value", F.col("value") + shift), ["g"])
        true = boxplot.value_sketches(values, ["g"]).drop("sketch")
        lying = boxplot.on_groups(true, other.select("g", "sketch"), ["g"])
        check(values, boxplot.box_plot(values, boxplot.quartiles(values, ["g"], lying), ["g"]))


def test_outliers_are_the_rows_beyond(spark, values):
    box = boxplot.quartiles(values, ["g"])
    found = boxplot.outliers(values, box, ["g"]).collect()
    plot = {r.g: r for r in boxplot.box_plot(values, box, ["g"]).collect()}
    assert len(found) == sum(r.n_outliers or 0 for r in plot.values()) > 0
    assert all(not plot[r.g].lower_whisker <= r.value <= plot[r.g].upper_whisker and r.id is not None for r in found)


def test_no_values(spark, values):
    assert boxplot.quartiles(values.where("false"), ["g"]).collect() == []


def test_split_reader_fails_on_a_bad_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"userId":"1","label":1.0,"scaled_features":[1.0]}\n{"userId":"2","label":"x"}\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        io.read_split_json(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("job", [features.user_features, features.page_pivot])
def test_pages_are_found_without_a_second_read(spark, job):
    """With unnamed pages the returned table reads counts, not the log."""
    prepared = registry.prepared(spark, SF001)
    found = job(prepared)
    assert "Register" in found.columns
    assert "parquet" not in found._jdf.queryExecution().executedPlan().toString()
    named = job(prepared, pages=features.pages_of(prepared))
    assert sorted(map(str, found.select(named.columns).collect())) == sorted(map(str, named.collect()))
