"""The two classifiers: kernel arithmetic, held-out accuracy, odd cases."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.llm import quality, queries, toxicity
from churnkit.llm.common import labelled_sample, table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    values, ranks = np.asarray(s)[order], np.empty(len(s))
    first = np.searchsorted(values, values)
    last = np.searchsorted(values, values, side="right")
    ranks[order] = (first + last + 1) / 2
    y = np.asarray(y)
    n1 = int(y.sum())
    return (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def kernel_brute(a: bytes, b: bytes) -> float:
    def weights(s):
        out = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < toxicity.SPAN:
                t = (s[i], s[j], s[k])
                out[t] = max(out.get(t, 0), toxicity.DECAY ** (k - i - 2))
        return out
    x, y = weights(a), weights(b)
    return sum(v * y.get(t, 0) for t, v in x.items())


def test_kernel_equals_brute_force():
    strings = [toxicity.letters(w) for w in (b"insult", b"insane", b"result", b"abcabc")]
    marks = toxicity.Landmarks(strings)
    words = [b"insult", b"in-su.lt", b"inxsult", b"unrelated", b"ab", b"", b"abcabcabc", b"in5u1t"]
    got = marks.values(words)
    for w, row in zip(words, got):
        for s, value in zip(strings, row):
            assert value == pytest.approx(kernel_brute(toxicity.letters(w), s) / kernel_brute(s, s), abs=1e-5)
    assert got[1, 0] == pytest.approx(1) and got[7, 0] > 0.4  # marks, and look-alikes (1 is an i)
    assert got[3, 0] < 0.2 < got[2, 0] < 1  # an inserted letter weakens


def planted_model():
    rng = np.random.default_rng(0)
    words = ["garden", "river", "stone", "window", "paper", "yellow", "letter", "summer", "market", "bridge"]
    texts, y = [], []
    for i in range(400):
        w = [words[k] for k in rng.integers(0, 10, 40)]
        if i % 4 == 0:
            for _ in range(2):
                w[rng.integers(0, 40)] = ["blockhead", "nitwit"][rng.integers(0, 2)]
        texts.append(". ".join(" ".join(w[k:k + 8]) for k in range(0, 40, 8)))
        y.append(int(i % 4 == 0))
    return toxicity.Model(texts, np.array(y), 0.25)


def test_toxicity_tolerates_gaps_and_insertions():
    model = planted_model()
    clean = b"the garden by the river has a stone bridge"
    spoiled = [b"you blockhead. summer", b"you bl-ock.head, summer", b"you bloxckhead summer", b"you n.i.t.w.i.t",
               b"you N I T W I T again", b"you n1twit"]
    scores = model.scores([clean, b"", *spoiled])
    assert (scores[:2] < 0.3).all() and (scores[2:] >= 0.3).all(), scores


def test_toxicity_tolerates_several_insertions_and_omissions():
    model = planted_model()
    spoiled = [b"bloxckxhead", b"bzloqckheazd", b"bxlxoxcxkxhxexaxd", b"nixtwyit", b"nzizizwizt", b"blckhead", b"blokhead",
               b"nitwt"]
    scores = model.scores([b"you " + w + b" by the garden. summer" for w in spoiled])
    assert (scores >= 0.3).all(), dict(zip(spoiled, scores))
    fine = [b"stone bridge and river", b"a letter", b"with it", b"black bread", b"blocks ahead of the head"]
    assert (model.scores(fine[:4]) < 0.3).all()


def test_floors_keep_chance_matches_out():
    rng = np.random.default_rng(2)
    clean = [b" ".join([b"insane", b"result", b"garden"][k] for k in rng.integers(0, 3, 20)) for _ in range(200)]
    marks = toxicity.Landmarks([toxicity.letters(b"insult")])
    marks.learn_floors(clean)
    chance = marks.values([b"insane", b"result"])[:, 0].max()
    assert marks.floors[0] >= chance
    assert not marks.calibrated([b"insane", b"result"]).any()
    assert marks.calibrated([b"insult"])[0, 0] == pytest.approx(1)
    assert marks.calibrated([b"insxulzt"])[0, 0] > toxicity.TRACE


def test_sample_bounds_rows_and_bytes_never_texts(spark):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(40)] + [(None, "n")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1)], "doc_id long, toxic int")
    everyone = lambda c: F.col(c).isNotNull()
    texts, y = labelled_sample(docs, marks, "toxic", everyone, 15, 1 << 20)
    assert len(texts) == 30 and y.sum() == 15 and {len(t) for t in texts} == {1000}
    texts, y = labelled_sample(docs, marks, "toxic", everyone, 15, 4500)  # five texts of each class pass it
    assert len(texts) == 10 and y.sum() == 5 and {len(t) for t in texts} == {1000}


def test_models_without_both_classes():
    for module in (toxicity, quality):
        assert module.Model([], np.array([], int)).scores([b"x", b""]).tolist() == [0.0, 0.0]
        assert module.Model(["a"], np.array([1])).scores([b"x"]).tolist() == [1.0]


@pytest.mark.parametrize("key,label,modulo,held", [("op3_toxicity", "toxic", 4, 2),
                                                   ("op10_quality_classifier", "quality", 5, 0)])
def test_held_out_accuracy(spark, key, label, modulo, held):
    rows = queries.queries()[key](spark, SF).collect()
    truth = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulo == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    out = [(truth[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(*zip(*out)) > {"toxic": 0.88, "quality": 0.95}[label]


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(32, 122, n).astype(np.uint8)) for n in (700, 30, 1500, 0)]
    y = np.array([1, 0, 1, 0])
    net = quality.Network(3)
    net.bias += np.float32(0.05)  # off the kink at which the empty text would lie

    def loss():
        p = quality.sigmoid(net.logits(texts))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g_filters, g_bias, g_layer, g_offset = net._gradients(texts, y)
    for array, grad, at in ((net.filters, g_filters, (5, 3)), (net.filters, g_filters, (40, 11)),
                            (net.bias, g_bias, (2,)), (net.layer, g_layer, (7,)), (net.layer, g_layer, (60,))):
        old, eps = float(array[at]), 1e-3
        array[at] = old + eps
        up = loss()
        array[at] = old - eps
        down = loss()
        array[at] = old
        assert (up - down) / (2 * eps) == pytest.approx(float(grad[at]), abs=3e-4)


def test_network_covers_whole_texts():
    net = quality.Network(3)
    blocks = np.array([1, 2, 8, 9, 15, 16, 40])
    start, end, owner = quality._chunks(blocks)
    first = np.cumsum(blocks) - blocks
    for k, n in enumerate(blocks):
        covered = set()
        for s, e in zip(start[owner == k], end[owner == k]):
            covered |= set(range(s, e))
        assert covered == set(range(first[k], first[k] + n))
    long = b"plain words only here " * 4000
    assert net.logits([long]) != net.logits([long[:-1] + b"%%%%%%%%%%%%%%%%"])
    together = net.logits([b"one text", long, b""])
    assert np.allclose(together, [net.logits([t])[0] for t in (b"one text", long, b"")], atol=1e-4)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_documents_are_scored(spark, module):
    docs = H.odd_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(14)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = module.score(docs, module.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id == 9]
    assert max(same) - min(same) < 2e-5
    none = labels.where("false")
    assert {r.score for r in module.score(docs, module.fit(docs, none)).collect()} == {0.0}
    empty = H.empty_documents(spark)
    assert module.score(empty, module.fit(empty, labels)).count() == 0


def test_rejection_keeps_all_columns(spark):
    docs = H.odd_documents(spark)
    assert toxicity.keep_clean(docs, toxicity.Model([], np.array([], int))).count() == docs.count()
    kept = toxicity.keep_clean(spark.createDataFrame([(1, "a blockhead here"), (2, "a garden")],
                                                     "doc_id long, text string"), planted_model())
    assert [r.doc_id for r in kept.collect()] == [2]
