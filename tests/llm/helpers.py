"""Brute-force versions of the operators and small tables of odd cases."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"

ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "Two words", "é" * 5, "a b \x1c c", "TIE tie Tie " * 30,
    "the quick brown fox jumps over the lazy dog again and again until all twenty words have been said here once more now",
    "the quick brown fox jumps over the lazy dog again and again until all twenty words have been said here once more now",
    "x " * 5000, "A line of more than twenty letters\nsecond\nA line of more than twenty letters  ",
    "  a LINE of more than twenty letters\nother", "a line of more than twenty letters", "日本語 テキスト 絵文字 😀 " * 3,
]


def odd_documents(spark, extra: bool = True):
    """Nulls everywhere, empty, long and repeated texts, ties, repeated
    rows, a null doc_id, and columns whose names clash with the operators'
    own."""
    rows = [(i, t, None if i % 3 else "en", f"s{i % 2}", None if t is None else len(t), i)
            for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[9], rows[9], (None, ODD_TEXTS[9], None, None, None, None), (None, None, None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    if not extra:
        return spark.createDataFrame([r[:5] for r in rows], names)
    clash = ", spans long, kept_id long, rank long, doc_key long, gone_lines long, n_words string, fp string"
    return spark.createDataFrame([(*r[:5], r[5], r[5], r[5], r[5], r[5], "x", "y") for r in rows], names + clash)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def substring_brute(docs: list[tuple[int, str]], window: int = 20) -> dict:
    seen, out = set(), {}
    for i, text in sorted(docs):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(words, gone) if not g]
        out[i] = (len(words), sum(gone), sha(" ".join(kept)))
    return out


def fingerprint_brute(text: str | None, shingle: int = 3) -> int:
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(nodes: list, pairs) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def lines_brute(docs: list[tuple[int, str]], min_chars: int = 20, min_docs: int = 3) -> dict:
    holders: dict[str, set] = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            key = lower_ascii(line.strip(BLANK))
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(lower_ascii(line.strip(BLANK)), set())
            if len(held) < min_docs or i == max(held):
                kept.append(line)
        out[i] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out
