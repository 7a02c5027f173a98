"""Minimum bin slack, the conversation trie and ranked search against brute
force."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from churnkit.llm import bin_slack, lexical, prefix_trie, queries
from churnkit.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


# minimum bin slack ---------------------------------------------------------
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bin_slack.tokenizer_path(bin_slack.TOKENIZER))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("seed", range(8))
def test_least_slack_is_the_best_of_all_multisets(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted(rng.choice(np.arange(1, 40), 5, replace=False).tolist())
    counts = {n: int(rng.integers(0, 4)) for n in lengths}
    room = int(rng.integers(0, 90))
    found = bin_slack.least_slack(lengths, counts, room)
    assert all(0 < times <= counts[n] for n, times in found)
    best = max(s for s in (sum(n * k for n, k in zip(lengths, ks)) for ks in product(*(range(counts[n] + 1) for n in lengths)))
               if s <= room)
    assert sum(n * times for n, times in found) == best


@pytest.mark.parametrize("lengths", [[], [16], [16] * 5 + [1] * 3, [9, 8, 7, 5, 4, 3, 3, 3, 2, 1], list(range(1, 17)) * 4])
def test_windows_hold_every_piece_once(lengths):
    held, at = Counter(), 0
    for kind, repeat in bin_slack.windows(Counter(lengths), 16):
        assert sum(n * times for n, times in kind) <= 16
        for n, times in kind:
            held[n] += times * repeat
    assert held == Counter(lengths)
    window, offset, used = bin_slack.place(np.array(lengths, np.int64), 16)
    for w in range(len(used)):
        for piece in sorted(np.flatnonzero(window == w), key=lambda i: offset[i]):
            assert offset[piece] == at
            at += lengths[piece]
        assert at == used[w]
        at = 0


def test_windows_refuse_what_cannot_fit():
    for bad in (17, 0):
        with pytest.raises(ValueError):
            list(bin_slack.windows({bad: 1}, 16))


def test_padding_stops_at_a_power_of_two():
    assert [bin_slack.padded(n) for n in (1, 2, 3, 512, 1023, 1024, 2047, 2048)] == [1, 2, 2048, 512, 2048, 1024, 2048, 2048]


def test_word_ids_equal_the_library():
    special = "".join(chr(c) for c in range(0x2100) if not 0xD800 <= c < 0xE000)
    texts = ["", None, " a  b ", "It's WE'LL 12th foo'., end.", "x<|endoftext|>y <|STARTOFTEXT|> <| a<|startoftext|>", "ΑΣ Σ. İI K Å",
             "é Å. ...!? don't.", "a\x1cb\x1f c\x00d", " ".join(special), "a".join(special), "日本語、テキスト。 😀😀", "w" * 5000,
             "á́ ́x .́ a.́"]
    words, tk = bin_slack.WordIds(bin_slack.tokenizer_path(bin_slack.TOKENIZER)), library()
    for _ in range(2):
        ids, ends = words.encode(pa.array(texts, pa.string()))
        for text, first, end in zip(texts, [0, *ends[:-1]], ends):
            assert ids[first:end].tolist() == tk.encode(text or "", add_special_tokens=False).ids, repr(text)[:60]


def check_packing(rows, docs, capacity=2048):
    tk, expected = library(), Counter()
    for doc_id, text in docs:
        ids = [*tk.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), capacity):
            piece = np.array(ids[at:at + capacity], "<u4")
            expected[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and {r.sequence_used for r in members} == {at}
        assert {r.sequence_length for r in members} == {bin_slack.padded(at, capacity)}
    return sequences


def test_packing_is_whole_and_tight(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    sequences = check_packing(queries.queries()["op11_packing"](spark, SF).collect(), docs)
    used = [m[0].sequence_used for m in sequences.values()]
    assert sum(used) / sum(m[0].sequence_length for m in sequences.values()) > 0.98


def test_packing_does_not_depend_on_partitioning(spark):
    docs = table(spark, SF, "documents")
    one = sorted(map(tuple, bin_slack.pack(docs, shard_pieces=30).collect()))
    assert one == sorted(map(tuple, bin_slack.pack(docs.repartition(7), shard_pieces=30).collect()))


def test_packing_odd_cases(spark):
    docs = H.odd_documents(spark)
    rows = bin_slack.pack(docs, capacity=64, shard_pieces=50).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert bin_slack.pack(H.empty_documents(spark)).collect() == []


def test_equal_pieces_are_dealt_over_the_shards(spark):
    docs = spark.createDataFrame([(None, "one two three")] * 600, "doc_id long, text string")
    rows = bin_slack.pack(docs, capacity=16, shard_pieces=50).collect()
    by_shard = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 600 and len(by_shard) == 12 and max(by_shard.values()) < 100


# conversation trie ---------------------------------------------------------
def trie_brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))

    def hashes(r, t):
        t1 = xxhash.xxh64_intdigest(t.encode(), xxhash.xxh64_intdigest(r.encode(), 42))
        return t1 - (1 << 64) if t1 >= 1 << 63 else t1

    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c], key=lambda x: (x[0] is not None, x[0] or 0, hashes(*x[1:])))]
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + mine[h:])
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(m) - 1) * len(H.WORD.findall(n[-1][1])) if n else 0
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children[n], leaves[n], saved[n],
                   H.sha(",".join(map(str, sorted(c for c in m if built[c] == n))))) for n, m in members.items())


def got(rows):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows)


def logged(seed, convs=90, letters=2, longest=9):
    """Short alphabets, so that many conversations share turns."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-60, 200), convs, replace=False).tolist():
        for turn in range(int(rng.integers(1, longest))):
            rows.append((c, turn, "user" if turn % 2 else None, " ".join(["w"] * int(rng.integers(0, letters)))))
    return rows


CONVS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,layer,shard", [(0, 512, 200_000), (1, 1, 5), (2, 2, 5), (3, 3, 1), (4, 4, 200_000)])
def test_trie_equals_brute_force(spark, seed, layer, shard):
    rows = logged(seed)
    frame = spark.createDataFrame(rows, CONVS).repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # many shards
    try:
        assert got(prefix_trie.trie(frame, layer=layer, shard_nodes=shard).collect()) == trie_brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_trie_of_a_chain_below_cuts(spark):
    same = [(c, t, "user", f"turn {t}") for c in (20, 40, 45) for t in range(30)]
    rows = same + [(7, t, "x", f"mine {t}") for t in range(40)] + [(60, t, "user", f"turn {t}") for t in range(11)]
    frame = spark.createDataFrame(rows, CONVS)
    assert got(prefix_trie.trie(frame, layer=4).collect()) == trie_brute(rows)


def test_trie_odd_cases(spark):
    rows = [(None, 0, "user", "gone"), (None, None, None, None), (1, None, None, None), (1, None, "a", "b"), (1, 3, "", ""),
            (1, 3, "", ""), (2, 0, "user", "x " * 9000), (3, 0, "user", "x " * 9000), (3, 0, "user", "x " * 9000),
            (20, 0, "user", "é"), (21, 0, None, "é"), (22, -5, None, None), (-21, 1, "r", "t"), (-20, 1, "r", "t")]
    clash = ", ".join(f"{c} string" for c in ("depth", "part", "p1", "conv", "h", "n_convs"))
    frame = spark.createDataFrame([(*r, *"abcdef") for r in rows], f"{CONVS}, {clash}")
    assert got(prefix_trie.trie(frame).collect()) == trie_brute(rows)
    assert prefix_trie.trie(spark.createDataFrame([], CONVS)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], CONVS)).collect() == []


def test_trie_digest_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 7)
    rows = [(c, 0, "user", "same") for c in range(300)]
    assert got(prefix_trie.trie(spark.createDataFrame(rows, CONVS)).collect()) == trie_brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_findclose_and_leaf_pairs(seed):
    rng = np.random.default_rng(seed)
    par, open_now = [], 0
    while len(par) + open_now < [2, 40, 3000, 900][seed]:
        down = open_now and rng.random() < [0.5, 0.5, 0.5, 0.1][seed]
        par.append(-1 if down else 1)
        open_now += par[-1]
    par += [-1] * open_now
    stack, close = [], {}
    for i, x in enumerate(par):
        if x == 1:
            stack.append(i)
        else:
            close[stack.pop()] = i
    trie, opens = prefix_trie.Parentheses(np.array(par)), np.flatnonzero(np.array(par) == 1)
    closes = trie.findclose(opens)
    assert closes.tolist() == [close[i] for i in opens.tolist()]
    text = "".join("()"[x < 0] for x in par)
    assert trie.leaf_pairs(opens, closes).tolist() == [text.count("()", i, close[i] + 1) for i in opens.tolist()]


def test_turn_positions_do_not_gather_a_conversation(spark):
    """A conversation of a third of all rows is numbered in several ranges."""
    rows = [(0, t, "user", f"{t}") for t in range(2000)] + [(c, 0, "user", "a") for c in range(1, 4001)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this table would fit into one range
    try:
        found = prefix_trie.turns(spark.createDataFrame(rows, CONVS).repartition(8)).where("conv = 0").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.pos for r in found) == list(range(2000)) and len({r.part for r in found}) > 1


# ranked search -------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search_brute(docs, items, k):
    held = [(i, Counter(TERM.findall(H.lower_ascii(t or "")))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(H.lower_ascii(t or "")))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 50 + (50 * c.total() * n_docs) // n_terms if n_terms else 1
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,width,block", [(50, 2048, 512), (3, 4, 2), (1, 1, 1)])
def test_search_equals_brute_force(spark, k, width, block):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = lexical.search(docs.repartition(5), items, k, width, block).collect()
    assert sorted(map(tuple, found), key=str) == search_brute(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)


@pytest.mark.parametrize("slice_rows", [3, 4096])
def test_search_odd_cases(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(lexical, "SLICE_ROWS", slice_rows)
    docs = H.odd_documents(spark)
    items = [(1, "the QUICK fox, 日本語"), (2, None), (3, ""), (None, "tie x"), (None, "words"), (5, "absent"), (6, "x x x é"),
             (1, "lines"), (7, "...")]
    frame = spark.createDataFrame([(*i, "a", 1) for i in items], "item_id long, text string, doc_id string, rank int")
    found = lexical.search(docs, frame, 4).collect()
    assert sorted(map(tuple, found), key=str) == search_brute([(r.doc_id, r.text) for r in docs.collect()], items, 4)
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(docs, none).collect() == [] and lexical.search(H.empty_documents(spark), frame).collect() == []


def test_terms_cut_where_the_class_says():
    text = "".join(map(chr, range(0x180))) + " Straße_ÉCOLE naïve9Z"
    assert [t for t in lexical.terms(text) if t] == TERM.findall(H.lower_ascii(text))
