"""Line dedup, substring dedup and SimHash near-dedup against brute force."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.llm import line_dedup, queries, simhash, substring_dedup
from churnkit.llm.common import components, table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def test_substring_equals_brute_force(spark, documents):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in queries.queries()["op2_substring_dedup"](spark, SF).collect()}
    expected = H.substring_brute(documents)
    assert got == expected
    assert sum(v[1] for v in expected.values()) > 0


def test_substring_crowded_phrases_change_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWDED", 2)
    monkeypatch.setattr(substring_dedup, "GROUP_CHARS", 20_000)
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 30_000)
    kept = substring_dedup.remove_repeats(table(spark, SF, "documents"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.k) for r in
           kept.withColumn("k", F.sha2("kept_words", 256)).collect()}
    assert got == H.substring_brute(documents)


def test_substring_finds_long_and_overlapping_repeats(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [(1, f"start {passage} end"), (2, f"other {passage} rest"), (3, passage + " " + passage),
             (4, " ".join(["same"] * 50)), (5, " ".join(f"w{i}" for i in range(40, 59)))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {i: v[:2] for i, v in H.substring_brute(texts).items()}
    assert got[2] == (62, 60) and got[3] == (120, 120) and got[4] == (50, 49) and got[5] == (19, 0)


def test_substring_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = substring_dedup.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_removed for r in by[9]] == [0, 0, 0]  # listed three times, one document
    assert by[10][0].n_removed == 23 and by[10][0].text == ""
    assert sorted(r.n_removed for r in by[None]) == [0, 23]  # a null doc_id comes last
    assert by[0][0].text is None and by[0][0].n_words == 0
    assert by[11][0].n_removed == 4999 and by[11][0].text == "x"  # word 0 is in the first window alone
    assert by[5][0].text == "Two words" and by[5][0].spans == 5
    assert substring_dedup.remove_repeats(H.empty_documents(spark)).count() == 0


def test_simhash_equals_brute_force(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in queries.queries()["op7_simhash_near_dedup"](spark, SF).collect()}
    prints = {i: H.fingerprint_brute(t) for i, t in documents}
    ids = sorted(prints)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = H.components_brute(ids, pairs)
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i in ids}


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5])
def test_simhash_links_lose_nothing(spark, k):
    rng = np.random.default_rng(k)
    seeds = rng.integers(-2 ** 62, 2 ** 62, 60)
    prints = set(seeds.tolist()) | {0}
    for s in seeds[:40].tolist():
        for _ in range(6):
            flips = rng.choice(63, rng.integers(1, 7), replace=False)
            prints.add(s ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    rows = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), k)
    linked = components(rows, "a", "b").collect()
    got = {p: p for p in prints} | {r.node: r.component for r in linked}
    mask = 2 ** 64 - 1
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & mask).bit_count() <= k]
    assert got == H.components_brute(prints, pairs)
    for r in rows.collect():  # and every link is one
        assert ((r.a ^ r.b) & mask).bit_count() <= k * len(prints)


def test_simhash_long_window_is_cut(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 7)
    fp = np.array([1 << i for i in range(40)] + [0], dtype=np.int64)
    cell, visitor = np.zeros(41, np.int64), np.zeros(41, np.int64)
    a, b = simhash.cell_links(cell, visitor, fp, 2)
    assert len(a) == 40 and len(set(b.tolist())) == 1


def test_simhash_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    blank = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in blank} == {0}  # null, empty and blank texts, the null doc_id too
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 10 not in ids and None not in ids and 9 in ids
    assert kept.columns == docs.columns
    assert simhash.keep_one(H.empty_documents(spark)).count() == 0


def test_simhash_keeps_one_row_of_each_component(spark):
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(200))
    texts = {t: words(t) for t in "abcdefg"}
    rows = [(3, texts["b"]), (5, texts["b"]), (5, texts["a"]),  # row 5 / a is the only one of its group
            (7, texts["c"]), (7, texts["d"]), (7, texts["d"]), (8, texts["c"]),
            (None, texts["e"]), (None, texts["e"]), (None, texts["f"]), (None, texts["g"]), (9, texts["g"]),
            (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n long")
    prints = {H.fingerprint_brute(t) for t in texts.values()} | {0}
    assert min((a ^ b).bit_count() for a in prints for b in prints if a != b) > 2
    kept = simhash.keep_one(docs.repartition(3))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    blank = [r for r in got if not r[1]]
    expected = [(3, texts["b"]), (5, texts["a"]), (7, texts["c"]), (7, texts["d"]), (None, texts["e"]),
                (None, texts["f"]), (9, texts["g"])]
    assert len(blank) == 1 and sorted(map(str, got)) == sorted(map(str, expected + blank))
    assert kept.columns == docs.columns


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r.node: r.component for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_lines_equal_brute_force(spark, documents):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256)
           for r in queries.queries()["op9_line_dedup"](spark, SF).collect()}
    assert got == H.lines_brute(documents)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_lines_whatever_the_batches(spark, documents, batches, fanout):
    kept = line_dedup.drop_common_lines(table(spark, SF, "documents"), batches=batches, fanout=fanout)
    got = {r.doc_id: (r.n_lines, r.n_dropped, H.sha(r.text)) for r in kept.collect()}
    assert got == H.lines_brute(documents)


def test_line_runs_are_joined_and_merged_as_they_lie(spark, documents):
    """Ten batches, two levels of compaction: each run costs a batch one
    merge join and no exchange or sort; merging costs no exchange."""
    docs = table(spark, SF, "documents")
    bounds = line_dedup.batch_bounds(docs, 10)
    rows = line_dedup.line_rows(docs, 20, bounds).cache()
    runs = line_dedup.LineRuns(spark, fanout=3)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k in range(10):
        with line_dedup._runs_lie_sorted(spark):
            text = plan(runs.marked(rows.where(F.col("batch") == k)))
        assert text.count("SortMergeJoin") == len(runs.live())
        assert text.count("Sort [") == bool(runs.live()) and text.count("Exchange hashpartitioning") == 2
        runs.add(rows.where(F.col("batch") == k))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert "Exchange" not in plan(runs.merged())
    got = {(r.h1, r.h2): (r.n, r.holder) for r in runs.merged().collect()}
    expected = {(r.h1, r.h2): (r.n, r.holder) for r in rows.groupBy("h1", "h2").agg(
        F.countDistinct("doc").alias("n"), F.max("doc").alias("holder")).collect()}
    assert got == expected
    runs.close()
    rows.unpersist()


def test_lines_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = line_dedup.drop_common_lines(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[12].text == "second" and by[13].text == "other" and by[14].text == "a line of more than twenty letters"
    assert by[14].gone_lines == 14 and by[1].n_lines == 1 and by[0].text == ""
    # doc_ids 9 (three times), 10 and null hold one line: three documents
    assert by[9].text == "" and by[10].text != ""
    assert line_dedup.drop_common_lines(H.empty_documents(spark)).count() == 0


def test_lines_of_rows_without_doc_id_stay_apart(spark):
    """A list of dropped lines holds no other row's lines, and each once."""
    line = lambda i: f"this is the common line number {i}"
    docs = [(None, f"{line(i)}\n{line(i)}\nown {i}") for i in range(30)] * 4
    docs += [(d, line(i)) for d in (1, 2, 3) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bounds = line_dedup.batch_bounds(frame, 2)
    rows = line_dedup.line_rows(frame, 20, bounds)
    common = line_dedup.common_lines(rows, len(bounds) + 1, 3, 3)
    lists = line_dedup.drop_lists(rows, common, "k", "t", "gone").select("k", F.size("gone").alias("n")).collect()
    assert {r.n for r in lists} == {1} and sum(r.k == line_dedup.NO_ID for r in lists) == 30
    got = line_dedup.drop_common_lines(frame).collect()
    assert sorted(r.text for r in got if r.doc_id is None) == sorted(f"own {i}" for i in range(30) for _ in range(4))
    assert all(r.n_dropped == 2 for r in got if r.doc_id is None)
    assert all((r.text == "") == (r.doc_id < 3) for r in got if r.doc_id)


def test_substring_rows_of_one_id_are_told_apart_by_the_second_hash(spark, monkeypatch):
    """With a first hash that is the same for all texts, texts of one doc_id
    (or of none) are still documents of their own."""
    whole = substring_dedup._hash
    monkeypatch.setattr(substring_dedup, "_hash", lambda seed: F.lit(0).cast("long") if seed == 1 else whole(seed))
    first, other = (" ".join(f"{c}{i}" for i in range(24)) for c in "ab")
    rows = [(1, first), (None, first), (None, other), (9, other), (5, other), (5, first), (5, other)]
    kept = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = collections.Counter((r.doc_id, r.n_removed) for r in kept)
    # `other` comes first in document 5 (listed twice), `first` in document 1
    assert found == {(1, 0): 1, (5, 0): 2, (5, 24): 1, (9, 24): 1, (None, 24): 2}


def test_substring_settled_runs_are_spread_over_the_groups():
    """A passage that every document holds puts no more than an even share
    of the documents into one group."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 2 ** 63, 40).astype(np.uint64)
    powers, counts, groups = substring_dedup.Powers(), collections.Counter(), 16
    for batch in range(200):
        docs = [(batch * 10 + i, i, -i, np.concatenate([rng.integers(0, 2 ** 63, 30).astype(np.uint64), passage]))
                for i in range(10)]
        for group, blob in substring_dedup.branches(docs, 20, powers, np.empty(0, np.uint64), groups):
            rows = substring_dedup.unpack(blob, substring_dedup.KINDS)
            counts[group] += int(rows["settled"].sum())
    assert sum(counts.values()) == 200 * 9 and max(counts.values()) < 3 * 1800 / groups
