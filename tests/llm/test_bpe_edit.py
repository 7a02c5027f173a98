"""BPE against the tokenizers library; edit fingerprints against a plain walk."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Library

from churnkit.llm import bpe, common, edit_fingerprint as E, queries
from churnkit.llm.common import table
from churnkit.session import reliable_checkpoint
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"
PATH = f"{queries.TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    t = Library.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def check(library, texts):
    own = bpe.Tokenizer(PATH) if not hasattr(check, "own") else check.own
    check.own = own
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in own.encode(texts)]
    assert got == expected
    assert [own.decode(i) for i in got] == [library.decode(i, skip_special_tokens=False) for i in expected]


def test_bpe_equals_the_library_on_odd_texts(library):
    check(library, [t or "" for t in H.ODD_TEXTS])
    check(library, ["<|startoftext|>a <|endoftext|>b<|endoftext|>", "x<|endoftext", "ΟΔΥΣΣΕΥΣ ΣΑΣ İstanbul ǅ ﬁ Å é ẞ",
                    "a b c　d\x1ce\x85f\x0bg", "don't I'LL we'Ve '''s 's'", "١٢٣ ½ ² 123456", "😀👩‍👩‍👧 ☃️ ​﻿ x",
                    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "!!!!???...,,,;;;" * 20, "\x00\x01\x7f\u0080", "ſ K Ω"])


def test_bpe_equals_the_library_on_random_texts(library):
    rng = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCé ñß'.,!?-_ \n\t0123456789<|>#日本ЖΣ"
    check(library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(400)])
    own = check.own
    tokens = [t.replace("</w>", "") for t in own.tokens[1000:49000:7] if t.isascii()]
    check(library, ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))) for _ in range(4000)])


def test_bpe_long_words(library, monkeypatch):
    rng = random.Random(8)
    long = ["a" * 3001, "".join(rng.choice("abcdeth") for _ in range(30_000)), "!?" * 2000, "x" * 100_000]
    check(library, long)
    own = check.own
    for _ in range(200):  # both ways of merging agree
        piece = "".join(rng.choice("theingoras") for _ in range(rng.randint(2, 60)))
        quick = own._merge_long(own.symbols(piece))
        monkeypatch.setattr(bpe, "LONG", 100)
        assert quick == own.merge(own.symbols(piece))


def test_bpe_query(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.queries()["op4_bpe"](spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                 H.sha(library.decode(ids, skip_special_tokens=False)))


def test_bpe_forgets_and_goes_on(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5)
    for _ in range(3):
        check(library, ["some words that are more than five", "and some others too, again words"])


def test_bpe_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = bpe.encode_documents(docs, PATH, with_ids=True).collect()
    assert len(rows) == docs.count()
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2, 3)} == {0}
    assert bpe.encode_documents(H.empty_documents(spark), PATH).count() == 0


def walk_brute(text: str) -> np.ndarray:
    """The walk, character by character."""
    c, i, step, out = E.classes(text), 0, 1, []
    wanted = {int(s): o for o in range(E.OCTAVES) for s in E.STEPS[o]}
    while len(c):
        octave = step.bit_length() - 1
        if step == 1 << octave and i >= len(c):
            break
        here = int(c[i]) if i < len(c) else 0
        if step in wanted:
            out.append(E.NIBBLES[step % E.PERIOD][here] if here else 16)
        if here:
            i += int(E.MOVES[step % E.PERIOD][here])
        step += 1
    return np.array(out, np.uint8)


def test_walks_equal_brute_force():
    rng = random.Random(1)
    texts = ["", "a", "ab", "é日😀" * 30] + ["".join(rng.choice("abcdef ghi") for _ in range(n)) for n in (5, 63, 64, 700, 3000)]
    for got, text in zip(E.fingerprints([E.classes(t) for t in texts]), texts):
        assert np.array_equal(got, walk_brute(text)), len(text)


def likeness_of(a: str, b: str) -> float:
    x, y = E.fingerprints([E.classes(a), E.classes(b)])
    return E.likeness(x, y, len(a), len(b))


def test_likeness_follows_edits():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(4000))
    other = "".join(rng.choice("abcdefghijklmnop ") for _ in range(4000))
    one_gone = text[:500] + text[501:]
    assert likeness_of(text, text) == 1.0
    assert likeness_of(text, one_gone) > 0.8
    assert 0.3 < likeness_of(text, text[:2000] + other[:2000]) < 0.7
    assert likeness_of(text, other) < 0.25
    assert likeness_of("", "") == 1.0 and likeness_of("", text) == 0.0


def test_fingerprint_query(spark):
    rows = {r.doc_id: r for r in queries.queries()["op8_document_fingerprints"](spark, SF).collect()}
    docs = sorted(((r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect()), reverse=True)
    assert len(rows) == len(docs)
    for (i, a), (_, b) in zip(docs, docs[1:] + docs[:1]):
        edited = E.edited(a, b)
        assert rows[i].n_chars == len(a) and rows[i].edited_sha256 == H.sha(edited)
        assert rows[i].near_next == pytest.approx(likeness_of(a, b))
        assert rows[i].near_edited == pytest.approx(likeness_of(a, edited))
        samples, n = E.parse(rows[i].fingerprint)
        assert n == len(a) and np.array_equal(samples, E.fingerprints([E.classes(a)])[0])


def test_following_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(E, "WALK_CHARS", 60)
    docs = [(i * 7, f"text number {i} " * (1 + i % 5)) for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(E.with_following, "__defaults__", (150,))
    rows = {r.doc_id: r for r in E.document_fingerprints(frame).collect()}
    order = sorted(docs, reverse=True)
    assert len(rows) == 50
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        assert rows[i].edited_sha256 == H.sha(E.edited(a, b))


def test_fingerprint_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = E.document_fingerprints(docs).collect()
    assert len(rows) == docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (9, 10)}) == 1
    one = E.document_fingerprints(spark.createDataFrame([(5, "alone")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == H.sha("aloal")
    assert E.document_fingerprints(H.empty_documents(spark)).count() == 0


def test_near_duplicates_by_banding(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(1500)) for _ in range(6)]
    docs = [(i, t) for i, t in enumerate(base)] + [(10 + i, t[:700] + "x" + t[700:]) for i, t in enumerate(base)] + [(20, base[0])]
    prints = E.document_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "fingerprint")
    got = {r.doc_id: r.component_id for r in E.near_duplicates(prints, 0.75).collect()}
    assert got == {i: i for i in range(6)} | {10 + i: i for i in range(6)} | {20: 0}


def _edited_texts(rng, seeds: int, copies: int) -> list[str]:
    """Random texts and copies of them with a few letters changed, taken out
    or put in."""
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz     "))
    texts = []
    for _ in range(seeds):
        base = rng.choice(letters, int(rng.integers(60, 1500))).tolist()
        texts.append("".join(base))
        for _ in range(copies):
            t = list(base)
            for _ in range(int(rng.integers(1, 2 + len(t) // 100))):
                at = int(rng.integers(0, len(t)))
                t[at:at + int(rng.integers(0, 2))] = rng.choice(letters, int(rng.integers(0, 2))).tolist()
            texts.append("".join(t))
    return texts


def _alike(prints: list[str], threshold: float) -> list[tuple[int, int]]:
    parsed = [E.parse(p) for p in prints]
    return [(i, j) for i in range(len(prints)) for j in range(i)
            if E.likeness(parsed[i][0], parsed[j][0], parsed[i][1], parsed[j][1]) >= threshold]


def _prints(texts: list[str]) -> list[str]:
    return [E.as_string(x, len(t)) for t, x in zip(texts, E.fingerprints([E.classes(t) for t in texts]))]


def test_bands_find_pairs_above_the_threshold():
    prints = _prints(_edited_texts(np.random.default_rng(5), 60, 4))
    keys = [set(E.bands_of(E.parse(p)[0])) for p in prints]
    pairs = [(i, j) for i, j in _alike(prints, 0.8) if prints[i] != prints[j]]
    found = sum(bool(keys[i] & keys[j]) for i, j in pairs)
    assert len(pairs) > 150 and found >= 0.95 * len(pairs)


def test_near_duplicates_lose_no_link_of_a_bucket(spark, monkeypatch):
    """Components equal brute force over the pairs that share a band, with
    crowded buckets in blocks of three; null and repeated doc_ids too."""
    monkeypatch.setattr(E, "BLOCK", 3)
    prints = _prints(_edited_texts(np.random.default_rng(6), 12, 9) + ["", "", "short", "short"])
    rows = [(None if i % 10 == 3 else i // 2 * 2, p) for i, p in enumerate(prints)]
    keys = [set(E.bands_of(E.parse(p)[0])) for p in prints]
    pairs = [(i, j) for i, j in _alike(prints, 0.8) if prints[i] == prints[j] or keys[i] & keys[j]]
    root = H.components_brute(range(len(rows)), pairs)
    least = {}
    for i, r in root.items():
        least[r] = min([x for x in (rows[i][0], least.get(r)) if x is not None], default=None)
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, fingerprint string, row long")
    got = E.near_duplicates(frame.repartition(3)).collect()
    assert sorted((r.row, r.component_id) for r in got) == [(i, least[root[i]]) for i in range(len(rows))]
    empty = spark.createDataFrame([], "doc_id long, fingerprint string")
    assert E.near_duplicates(empty).count() == 0


def test_fingerprint_groups_equal_brute_force(spark):
    """The query's components: equal fingerprints, and pairs that share a
    band and are alike, over the whole table; the odd table too."""
    rows = queries.queries()["op8_document_fingerprints"](spark, SF).collect()
    prints = [r.fingerprint for r in rows]
    keys = [set(E.bands_of(E.parse(p)[0])) for p in prints]
    pairs = [(i, j) for i, j in _alike(prints, 0.8) if prints[i] == prints[j] or keys[i] & keys[j]]
    root = H.components_brute(range(len(rows)), pairs)
    least = {}
    for i, r in root.items():
        least[r] = min(rows[i].doc_id, least.get(r, rows[i].doc_id))
    assert [r.component_id for r in rows] == [least[root[i]] for i in range(len(rows))]
    assert len(set(least.values())) < len(rows)
    odd = E.fingerprint_groups(H.odd_documents(spark)).collect()
    by = {r.doc_id: r.component_id for r in odd if r.doc_id is not None}
    assert len(odd) == H.odd_documents(spark).count() and by[10] == 9 and by[1] == 0
    assert E.fingerprint_groups(H.empty_documents(spark)).count() == 0


def test_likenesses_equal_likeness():
    prints = _prints(_edited_texts(np.random.default_rng(9), 12, 4) + ["", "", "a", "a", "ab" * 40])
    parsed, matrix = [E.parse(p) for p in prints], E.packed(prints)
    for i, (x, n) in enumerate(parsed):
        expected = [E.likeness(x, y, n, m) for y, m in parsed]
        assert E.likenesses(matrix[i:i + 1], matrix).tolist() == expected
        assert E.likenesses(np.repeat(matrix[i:i + 1], len(prints), axis=0), matrix).tolist() == expected
    assert E.likenesses(E.packed([]), E.packed([])).tolist() == []


def test_near_duplicates_need_few_checkpoints(spark, monkeypatch):
    """The driver keeps every job in mind: few links, though in a long
    chain, must not take one round of jobs after another."""
    rng = random.Random(12)
    text = [rng.choice("abcdefghijklmnop ") for _ in range(1200)]
    texts = []
    for _ in range(150):  # each is like the next, none like those far away
        for _ in range(12):
            text[rng.randrange(len(text))] = rng.choice("abcdefghijklmnop ")
        texts.append("".join(text))
    prints = _prints(texts)
    keys = [set(E.bands_of(E.parse(p)[0])) for p in prints]
    pairs = [(i, j) for i, j in _alike(prints, 0.8) if prints[i] == prints[j] or keys[i] & keys[j]]
    assert E.likeness(*(E.parse(prints[k])[0] for k in (0, -1)), 1200, 1200) < 0.5 and len(pairs) > 150
    made = []

    def counted(df):
        made.append(1)
        return reliable_checkpoint(df)

    monkeypatch.setattr(E, "reliable_checkpoint", counted)
    monkeypatch.setattr(common, "reliable_checkpoint", counted)
    frame = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    got = {r.doc_id: r.component_id for r in E.near_duplicates(frame).collect()}
    assert got == H.components_brute(range(len(texts)), pairs)
    assert len(made) <= 18  # 28 before


def test_components_of_few_edges(spark):
    rng = random.Random(13)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    frame = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    expected = {n: r for n, r in H.components_brute(nodes, [p for p in pairs if p[0] != p[1]]).items()}
    for few in (0, 1, 60, 10_000):
        assert {r.node: r.component for r in common.components(frame, "a", "b", few).collect()} == expected
    assert common.components(frame.where("a < 0"), "a", "b", 10).count() == 0
