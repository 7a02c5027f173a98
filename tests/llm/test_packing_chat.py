"""Packing, chat formatting and embeddings against brute force."""

import numpy as np
import pytest

from churnkit.llm import chat, embedding_dedup, packing, queries
from churnkit.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def best_fit_brute(lengths, permitted, overhead):
    """The same rule with plain lists."""
    sizes, bins, place = sorted(permitted), [], {}
    waiting = sorted(lengths, reverse=True)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        able = [b for b in range(len(bins)) if bins[b][0] - sum(bins[b][1]) >= n]
        if able:
            b = min(able, key=lambda b: (bins[b][0] - sum(bins[b][1]), b))
        else:
            def cost(s):
                room = s
                for w in waiting:
                    if 0 < w <= room:
                        room -= w
                return ((s + overhead) / max(s - room, 1), -s)
            able_sizes = [s for s in sizes if s >= n]
            b = len(bins)
            bins.append([min(able_sizes, key=cost) if n else able_sizes[0], []])
        place[i] = (b, len(bins[b][1]))
        bins[b][1].append(n)
        waiting.remove(n)
    final = [min(s for s in sizes if s >= sum(b[1])) for b in bins]
    return [place[i][0] for i in range(len(lengths))], [place[i][1] for i in range(len(lengths))], final


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 33, 150).tolist() + [7] * 20
    permitted = [[32], [8, 16, 32], [32, 48, 64], [33, 100], [5, 32, 32], [40, 64, 128]][seed]
    assert packing.best_fit(lengths, permitted, 3) == best_fit_brute(lengths, permitted, 3)


def test_best_fit_refuses_what_cannot_fit():
    with pytest.raises(ValueError):
        packing.best_fit([9], [8])
    assert packing.best_fit([], [8]) == ([], [], [])


def test_packing_is_whole(spark):
    words = {r.doc_id: len(H.WORD.findall(r.text or "")) for r in table(spark, SF, "documents").collect()}
    rows = queries.queries()["op1_best_fit_packing"](spark, SF).collect()
    total, bins = dict.fromkeys(words, 0), {}
    for r in rows:
        assert r.start == r.piece * 8192
        total[r.doc_id] += r.length
        bins.setdefault(r.bin_id, []).append(r)
    assert total == words
    for members in bins.values():
        used = sum(r.length for r in members)
        assert {r.bin_used for r in members} == {used}
        assert {r.bin_length for r in members} == {min(s for s in packing.LENGTHS if s >= used)}
        assert sorted(r.place for r in members) == list(range(len(members)))


def test_packing_does_not_depend_on_partitioning(spark):
    docs = table(spark, SF, "documents")
    one = sorted(map(tuple, packing.pack(docs, shard_pieces=40).collect()))
    assert one == sorted(map(tuple, packing.pack(docs.repartition(7), shard_pieces=40).collect()))


def test_packing_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = packing.pack(docs, permitted=(64, 1024)).collect()
    assert len({(r.doc_id) for r in rows}) == len({r.doc_id for r in docs.collect()})
    assert sorted(r.length for r in rows if r.doc_id == 11) == [904, 1024, 1024, 1024, 1024]
    assert [r.length for r in rows if r.doc_id == 0] == [0]
    assert sum(r.doc_id == 9 for r in rows) == 3
    assert packing.pack(H.empty_documents(spark)).count() == 0


def turns_of(spark, conversations):
    rows = [(c, t, role, text) for c, turns in conversations for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_packing_deals_rows_without_doc_id_evenly(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 70)
    docs = [(None, "a b c")] * 900 + [(None, "a b")] * 300 + [(5, None)] * 600 + [(i, "one") for i in range(10, 600)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_pieces=200).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == sorted(
        (str(i), len((t or "").split())) for i, t in docs)
    shards = [r.bin_id >> 32 for r in rows]
    assert max(map(shards.count, set(shards))) < 300


def test_shards_follow_the_pieces_of_long_texts(spark):
    """Ten texts of 400 pieces each fill as many shards as 4,000 short ones."""
    docs = spark.createDataFrame([(i, "w " * (400 * 64)) for i in range(10)], "doc_id long, text string")
    rows = packing.pack(docs, permitted=(16, 64), shard_pieces=200).collect()
    shards = [r.bin_id >> 32 for r in rows]
    assert len(rows) == 4000 and len(set(shards)) == 20 and max(map(shards.count, set(shards))) < 300


def test_chat_collapses_prefixes_and_copies(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello <|end|>"), ("user", None)
    turns = turns_of(spark, [(1, [a]), (2, [a, b]), (3, [a, b, c]), (4, [a, b, c]), (5, [b]), (6, [a, c]), (7, [(None, "hi")])])
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.render(turns).collect()}
    assert set(got) == {3, 5, 6, 7} and got[3][:2] == (3, 2)
    assert got[3][2] == "<|user|>\nhi<|end|>\n<|assistant|>\nhello < |end|><|end|>\n<|user|>\n<|end|>\n"


def test_chat_odd_cases(spark):
    schema = "conv_id long, turn long, role string, text string, line string, n long, kept_id long"
    rows = [(None, None, None, None), (None, 1, "user", "x"), (1, 1, "user", "x"), (1, 1, "user", "x"),
            (2, None, "user", "last"), (2, 0, "user", ""), (3, 0, "user", "y" * 100_000), (4, 0, "user", ""),
            (5, 2, "user", "x"), (5, 9, "user", "x")]
    got = {r.conv_id: r for r in chat.render(spark.createDataFrame([(*r, "z", 1, 1) for r in rows], schema)).collect()}
    assert set(got) == {None, 1, 2, 3} and got[None].n_turns == 2
    assert got[2].rendered.index("last") > 10  # a null turn comes last; 4 is its prefix
    assert got[1].n_turns == 2 and got[1].n_copies == 2  # a repeated row is a repeated turn, as in 5
    assert chat.render(spark.createDataFrame([], schema)).count() == 0


def test_chat_uses_no_python(spark):
    plan = chat.render(table(spark, SF, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def embedding_brute(rows, threshold):
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1]
            and np.isfinite(r[1]).all() and np.any(r[1])]
    links = {r[0]: 0 for r in rows}
    pairs = []
    for i, a in enumerate(good):
        for b in good[i + 1:]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    pairs.append((a[0], b[0]))
    return links, H.components_brute([r[0] for r in rows], pairs)


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    monkeypatch.setattr(embedding_dedup, "LEAF", 8)
    rng = np.random.default_rng(5)
    rows, centres = [], rng.normal(size=(12, 16))
    for i in range(400):
        v = centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 else 0.6)
        rows.append((i, v.astype(np.float32).tolist(), i % 4 if i % 50 else None))
    rows += [(400 + k, rows[7][1], rows[7][2]) for k in range(5)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [], 1),
             (504, [None, *rows[8][1][1:]], 0), (505, [float("inf")] * 16, 1), (506, rows[9][1][:8], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_duplicates(frame.withColumn("class", frame.vec_id), parts=5).collect()
    links, roots = embedding_brute(rows, 0.98)
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == roots
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    assert sum(links.values()) > 500


def test_embedding_odd_cases(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, None, None), (2, [2.0, 4.0], 1),
            (3, [1.0, 2.0], None), (4, [1e-30, 2e-30], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in got) == sorted(
        [(1, 4, 1), (1, 4, 1), (-1, 4, 1), (-1, 0, -1), (2, 4, 1), (3, 0, 3), (4, 4, 1)])
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_embedding_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = queries.queries()["op5_embedding_near_dedup"](spark, SF).collect()
    links, roots = embedding_brute(rows, 0.98)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {k: (links[k], roots[k]) for k in links}
