"""Most played artists from bounded summaries."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnkit.operators import clean, explore, hitters


def order():
    return F.desc("plays"), F.asc_nulls_first("artist"), F.asc("churn_lab")


def log(spark, artist, n=6000, users=40):
    rng = random.Random(7)
    rows = [(f"u{rng.randrange(users)}", artist(rng), "Cancellation Confirmation" if rng.random() < 0.002 else "NextSong")
            for _ in range(n)]
    return spark.createDataFrame(rows, "userId string, artist string, page string").repartition(5).cache()


SHAPES = {
    "steep": lambda rng: f"a{int(rng.paretovariate(0.7))}",
    "flat": lambda rng: f"a{rng.randrange(3000)}",
    "nulls": lambda rng: None if rng.random() < 0.5 else f"a{rng.randrange(50)}",
    "one": lambda rng: "a",
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("capacity", [3, 60, 10_000])
def test_equals_the_plain_query(spark, shape, capacity):
    events = log(spark, SHAPES[shape])
    wanted = clean.top_n(explore.artist_plays_by_label(events), 5, *order()).collect()
    assert hitters.top_artists(events, 5, capacity).collect() == wanted


@pytest.mark.parametrize("capacity", [2, 20, 500])
def test_bounds_hold(spark, capacity):
    events = log(spark, SHAPES["steep"])
    low, paid = hitters.bounds(events, "artist", capacity)
    counts = Counter(r.artist for r in events.collect())
    kept = {r.value: r.low for r in low.collect()}
    assert paid <= sum(counts.values()) / capacity * 2
    for artist, n in counts.items():
        assert kept.get(artist, 0) <= n <= kept.get(artist, 0) + paid


def test_a_summary_stays_small():
    s = hitters.Summary(10)
    for i in range(50):
        s.add(pa.array([f"v{(i * j) % 97}" for j in range(200)] + [None]))
        assert len(s.counts) <= 10


def test_fewer_rows_are_shuffled(spark, monkeypatch):
    """Only the candidates' (user, artist) rows reach the label join."""
    events = log(spark, SHAPES["steep"])
    rows = []
    plain = explore.artist_plays_by_label
    monkeypatch.setattr(explore, "artist_plays_by_label", lambda e, key, churned: (
        rows.append(e.select("userId", "artist").distinct().count()), plain(e, key, churned))[1])
    hitters.top_artists(events, 3, 400)
    assert len(rows) == 1 and rows[0] < events.select("userId", "artist").distinct().count() / 2


def test_an_empty_log(spark):
    assert hitters.top_artists(log(spark, SHAPES["one"]).where("false")).collect() == []
