"""The pipeline against its stages' brute-force versions, and the SQL."""

import os

import corpus_pipeline
import duckdb
import pytest

from churnkit.llm import packing, queries, toxicity
from churnkit.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_sql(spark, key):
    db = duckdb.connect()
    for f in os.listdir(SF01):
        db.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF01}/{f}'")
    expected = db.sql(queries.oracle_sql()[key])
    names = sorted(expected.columns)
    got = queries.queries()[key](spark, SF01)
    assert sorted(got.columns) == names
    assert sorted(map(tuple, got.select(names).collect())) == sorted(expected.select(*names).fetchall())


def test_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert sorted(int(k[2:].split("_")[0]) for k in names if k.startswith("op") and k[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    scores = model.scores([t.encode() for _, t in rows])
    rows = [r for r, s in zip(rows, scores) if s < toxicity.THRESHOLD]

    holders = {}
    for i, t in rows:
        for line in t.split("\n"):
            holders.setdefault(H.lower_ascii(line.strip(H.BLANK)), set()).add(i)
    stay = lambda i, k: len(k) < 20 or len(holders[k]) < 3 or i == max(holders[k])
    rows = [(i, "\n".join(x for x in t.split("\n") if stay(i, H.lower_ascii(x.strip(H.BLANK))))) for i, t in rows]

    prints = {i: H.fingerprint_brute(t) for i, t in rows}
    ids = sorted(prints)
    roots = H.components_brute(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
                                     if (prints[a] ^ prints[b]).bit_count() <= 2])
    rows = [(i, t) for i, t in rows if roots[i] == i]

    kept = H.substring_brute(rows)
    left = {i: n - gone for i, (n, gone, _) in kept.items()}

    out = corpus_pipeline.run(spark, SF).collect()
    total = dict.fromkeys(left, 0)
    for r in out:
        total[r.doc_id] += r.length
    assert total == left
    for b in {r.bin_id for r in out}:
        used = sum(r.length for r in out if r.bin_id == b)
        assert {r.bin_length for r in out if r.bin_id == b} == {min(s for s in packing.LENGTHS if s >= used)}


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 0, 1), (5, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for docs in (H.odd_documents(spark, extra=False), H.empty_documents(spark)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if k < 4:
                assert docs.columns == list(corpus_pipeline.COLUMNS), name
        docs.count()
