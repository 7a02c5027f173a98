"""Document fingerprints by a randomised edit embedding.

All texts are read by the same random walk: at step ``j`` the walk emits
the character under it and moves on if a bit shared by all texts, drawn
for (``j`` modulo ``PERIOD``, character class), is set. Texts that differ
by a few edits fall into step again soon after each, so edit distance
becomes Hamming distance between the emitted strings. About two
characters are emitted for each one read; the walk ends with the text.

A fingerprint samples the emitted string at fixed random steps: up to
``SAMPLES`` in every octave [2^o, 2^(o+1)), four bits each (the class of
the emitted character, hashed with the step). Sampling by octaves lets
texts of any length be compared without a common scale: the *likeness* of
two fingerprints is the share of agreeing samples, corrected for chance,
each octave weighted by the steps it stands for in the longer text. A
sample beyond a text's end agrees with nothing but another end.

``near_duplicates`` finds similar texts by banding (bit sampling): ``BANDS``
random groups of ``BAND`` samples of each of a text's last two octaves are
bucket keys, and two texts of a bucket link if the likeness of their
fingerprints reaches the threshold. Equal fingerprints are one class. In
each bucket all classes are first compared with the least one; classes that
this has put into one component need no further comparison, any other pair
of the bucket is compared then, a crowded bucket in blocks dealt to tasks.
What leaves the tasks is links that span, never all pairs, so components
lose no link that shares a bucket.

Defined results: a null or empty text has the fingerprint of no samples
(its header alone), two such are alike (1.0) and unlike any other text
(0.0); a null doc_id comes after every other doc_id in descending order;
rows that repeat a doc_id follow in the order of their texts; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import byte_texts, components, discard, slices
from churnkit.session import reliable_checkpoint, scratch_path

PERIOD = 4096
SAMPLES = 32
OCTAVES = 40
BAND, BANDS = 8, 16
BLOCK = 1024
#: links that one task may fold (see ``components``): 32 bytes each
FEW_LINKS = 1 << 17
SLICE_BYTES = 6 << 20
WALK_CHARS = 16 << 20
SEED = 20240229
NO_ID = -(2 ** 63)

_rng = np.random.default_rng(SEED)
#: [step, class]: move on? Class 0 is the end of a text, where a walk rests.
MOVES = _rng.integers(0, 2, (PERIOD, 256)).astype(np.uint8)
MOVES[:, 0] = 0
#: [step, class]: the four bits that stand for the class at a step
NIBBLES = _rng.integers(0, 16, (PERIOD, 256)).astype(np.uint8)


def _sample_steps() -> list[np.ndarray]:
    """Per octave the steps that are sampled, sorted."""
    rng = np.random.default_rng(SEED + 1)
    out = []
    for o in range(OCTAVES):
        size = 1 << o
        n = min(size, SAMPLES)  # one step in each of n equal stretches
        out.append(size + np.arange(n, dtype=np.int64) * (size // n) + rng.integers(0, size // n, n))
    return out


STEPS = _sample_steps()
COUNTS = np.array([len(s) for s in STEPS])


def classes(text: str) -> np.ndarray:
    """Code points as classes 1 to 255."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return ((points * np.uint32(2654435761) >> np.uint32(24)) % np.uint32(255) + np.uint32(1)).astype(np.uint8)


def fingerprints(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text (as classes) its samples, a byte each (0 to 15), octave by
    octave up to the octave in which its walk ends; 16 marks a sampled step
    beyond the end."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([x for t in texts for x in (t, np.zeros(1, np.uint8))]) if texts else np.empty(0, np.uint8)
    begin = (np.cumsum(lengths + 1) - lengths - 1)
    pos = begin[order].astype(np.int64)
    alive = order[:int((lengths > 0).sum())]
    pos = pos[:len(alive)]
    found: list[list[np.ndarray]] = [[] for _ in texts]
    step = 1
    for octave in range(OCTAVES):
        if not len(alive):
            break
        end = 1 << (octave + 1)
        wanted = iter(STEPS[octave].tolist())
        next_wanted = next(wanted, None)
        samples = np.full((len(texts), COUNTS[octave]), 16, np.uint8)
        taken, members = 0, alive
        while step < end and len(alive):
            stop = min(end, step + 256)
            move = np.empty(len(pos), np.uint8)
            here = np.empty(len(pos), np.uint8)
            while step < stop:
                row = step % PERIOD
                np.take(flat, pos, out=here, mode="clip")
                if step == next_wanted:
                    samples[alive, taken] = np.where(here > 0, NIBBLES[row][here], 16)
                    taken += 1
                    next_wanted = next(wanted, None)
                np.take(MOVES[row], here, out=move, mode="clip")
                pos += move
                step += 1
            going = flat[pos] > 0
            if not going.all():
                alive, pos = alive[going], pos[going]
        step = end
        for i in members.tolist():
            found[i].append(samples[i])
    return [np.concatenate(f) if f else np.empty(0, np.uint8) for f in found]


def as_string(samples: np.ndarray, n_chars: int) -> str:
    """Length in code points, a colon, one character a sample (hexadecimal
    digits, ``-`` beyond the end)."""
    return f"{n_chars:x}:" + samples.tobytes().translate(_DIGITS).decode("ascii")


_DIGITS = bytes(b"0123456789abcdef-"[i] if i < 17 else 45 for i in range(256))
_VALUES = bytes((int(chr(i), 16) if chr(i) in "0123456789abcdef" else 16) for i in range(256))
_OCTAVE_OF = np.repeat(np.arange(OCTAVES), COUNTS)
_WEIGHTS = 2.0 ** _OCTAVE_OF / COUNTS[_OCTAVE_OF]


def likeness(a: np.ndarray, b: np.ndarray, length_a: int, length_b: int) -> float:
    """Estimated share of equal steps of two walks, 0 to 1."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if length_a == length_b and np.array_equal(a, b):
        return 1.0
    n, m = max(len(a), len(b)), min(len(a), len(b))
    octave = _OCTAVE_OF[:n]
    x, y = a[:m], b[:m]
    inside = np.ones(n, bool)
    inside[:m] = (x < 16) | (y < 16)  # steps beyond both ends stand for nothing
    same = np.zeros(n, bool)
    same[:m] = (x == y) & (x < 16)
    weight = 2.0 ** octave / COUNTS[octave] * inside
    share = float((weight * same).sum() / max(weight.sum(), 1e-12))
    return min(1.0, max(0.0, (share - 1 / 16) / (1 - 1 / 16)))


def parse(fingerprint: str) -> tuple[np.ndarray, int]:
    size, _, samples = fingerprint.partition(":")
    return np.frombuffer(samples.encode("ascii").translate(_VALUES), np.uint8), int(size, 16)


def packed(prints: list[str]) -> np.ndarray:
    """The samples of fingerprints, one row each, 17 after the last."""
    found = [parse(p)[0] for p in prints]
    out = np.full((len(found), max(map(len, found), default=0)), 17, np.uint8)
    for row, samples in zip(out, found):
        row[:len(samples)] = samples
    return out


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``likeness`` of each row of ``a`` (or its only one) and the same row
    of ``b`` (both as ``packed``, equally wide): the same values, as sums of
    the weights, which are whole numbers, are exact in any order."""
    weight, equal, inside = _WEIGHTS[:a.shape[1]], a == b, a < 16
    same = (equal & inside) @ weight
    total = weight.sum() - (equal & ~inside) @ weight  # steps beyond both ends stand for nothing
    share = same / np.maximum(total, 1e-12)
    return np.where(total == 0, 1.0, np.clip((share - 1 / 16) / (1 - 1 / 16), 0.0, 1.0))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or
    all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _mark():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), "text",
                       _mark().alias("mark"))


def with_following(docs: DataFrame, chars: int = 8 << 20, *, named: DataFrame | None = None) -> DataFrame:
    """(part, context, doc_id, key, text, mark) partitioned and sorted so that every
    row with ``context`` false is followed by the row after it in
    descending order of doc_id, the last by the first: the documents are
    dealt by ranges of doc_id, and the row that begins a range is repeated
    (``context``) at the end of the range before. Texts travel compressed.
    The rows of ``named`` (doc_id, mark, cls, component_id) come without a
    text, each before the texts of its doc_id and mark."""
    keyed = _keyed(docs)
    size = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("c")).first()
    parts = max(1, min(-(-(size["c"] or 0) // chars), size["n"], 100_000))
    cuts = sorted({int(c) for c in keyed.approxQuantile("key", [k / parts for k in range(1, parts)], 0.2 / parts)}) \
        if parts > 1 else []
    # part 0 holds the largest doc_ids; at most `parts` bounds
    bounds = np.array(cuts, np.int64)
    heads = {}

    def part_of(ids: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, ids, side="left")

    def tops(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(), np.int64)
            part = part_of(ids)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(ids)], names=["part", "key"])

    for row in (keyed.select("key").mapInArrow(tops, "part long, key long")
                .groupBy("part").agg(F.max("key").alias("top")).collect()):  # one row a range
        heads[row["part"]] = row["top"]
    present = sorted(heads)
    before = {p: present[k - 1] for k, p in enumerate(present)}  # the first range follows the last
    head_keys = {heads[p]: before[p] for p in present}
    known = np.array(sorted(head_keys), np.int64)
    target = np.array([head_keys[k] for k in known.tolist()], np.int64)

    def deal(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids = np.asarray(batch.column(1).to_numpy(), np.int64)
            packed = pa.array([press.compress(t) for t in byte_texts(batch.column(2))], pa.binary())
            part = part_of(ids)
            at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
            extra = np.flatnonzero(known[at] == ids)
            rows = np.concatenate([np.arange(len(ids)), extra])
            context = np.arange(len(rows)) >= len(ids)
            to = np.concatenate([part, target[at[extra]]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(context), batch.column(0).take(pa.array(rows)), pa.array(ids[rows]),
                 packed.take(pa.array(rows)), batch.column(3).take(pa.array(rows))],
                names=["part", "context", "doc_id", "key", "text", "mark"])

    def tag(batches):
        for batch in batches:
            part = part_of(np.asarray(batch.column(0).to_numpy(), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns],
                                             names=["part", "key", "mark", "cls", "component_id"])

    dealt = keyed.mapInArrow(deal, "part long, context boolean, doc_id long, key long, text binary, mark long")
    if named is not None:
        names = named.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "mark", "cls", "component_id").mapInArrow(
            tag, "part long, key long, mark long, cls binary, component_id long")
        dealt = dealt.unionByName(names.withColumn("context", F.lit(False)), allowMissingColumns=True)
    # a name has no text, so it comes before the texts of its key and mark
    return (dealt.repartition(max(1, len(present)), "part")
            .sortWithinPartitions("part", "context", F.desc("key"), "mark", F.sha2("text", 256)))


def document_fingerprints(docs: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next: the document against its edited text (see ``edited``) and
    against the next document in descending order of doc_id. With ``named``
    (doc_id, mark, cls, component_id) also component_id."""
    grouped = named is not None

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        held: list[tuple] = []  # (part, doc_id, text, names); the next row of the same part closes each
        part_now, closed = None, False
        names: dict[bytes, int | None] = {}  # component by class, for the texts of one doc_id and mark
        names_of = None

        def work(rows: list[tuple]) -> pa.RecordBatch:
            texts, edits = [], []
            for row, following in zip(rows, rows[1:]):
                texts.append(row[2])
                edits.append(edited(row[2], following[2]))
            last = rows[-1][2]
            every = fingerprints([classes(t) for t in (*texts, last, *edits)])
            own, other = every[:len(texts) + 1], every[len(texts) + 1:]
            sizes = [len(t) for t in (*texts, last)]
            sizes_e = [len(t) for t in edits]
            n = len(texts)
            strings = [as_string(own[i], sizes[i]) for i in range(n)]
            group = [pa.array(
                [r[3][hashlib.md5(f.encode()).digest()] for r, f in zip(rows, strings)], pa.int64())] if grouped else []
            return pa.RecordBatch.from_arrays([
                pa.array([r[1] for r in rows[:-1]], pa.int64()), pa.array(sizes[:n], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                pa.array(strings, pa.string()),
                pa.array([as_string(other[i], sizes_e[i]) for i in range(n)], pa.string()),
                pa.array([likeness(own[i], other[i], sizes[i], sizes_e[i]) for i in range(n)], pa.float64()),
                pa.array([likeness(own[i], own[i + 1], sizes[i], sizes[i + 1]) for i in range(n)], pa.float64()),
                *group], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                "near_edited", "near_next", *(["component_id"] if group else [])])

        size = 0
        for batch in batches:
            parts, contexts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, packed = batch.column(2).to_pylist(), batch.column(4)
            keys, marks = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            classes_of = batch.column(6).to_pylist() if grouped else [None] * batch.num_rows
            for i in range(batch.num_rows):
                if parts[i] != part_now:
                    part_now, closed, held, size = parts[i], False, [], 0
                if classes_of[i] is not None:
                    if (parts[i], keys[i], marks[i]) != names_of:
                        names, names_of = {}, (parts[i], keys[i], marks[i])
                    names[classes_of[i]] = batch.column(7)[i].as_py()
                    continue
                if closed:
                    continue
                text = grow.decompress(packed[i].as_py()).decode()
                held.append((parts[i], ids[i], text, names))
                size += len(text)
                closed = contexts[i]
                if closed or size >= WALK_CHARS:
                    if len(held) > 1:
                        yield work(held)
                    held, size = held[-1:], len(text)

    rows = with_following(docs, named=named)
    columns = ["part", "context", "doc_id", "key", "text", "mark"] + (["cls", "component_id"] if grouped else [])
    return rows.select(*columns).mapInArrow(
        emit, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double" + (", component_id long" if grouped else ""))


def _band_members() -> list[np.ndarray]:
    """Per octave the samples of each of its bands."""
    rng = np.random.default_rng(SEED + 2)
    out = []
    for n in COUNTS.tolist():
        size = min(BAND, max(1, n // 2))
        out.append(np.stack([np.sort(rng.choice(n, size, replace=False)) for _ in range(BANDS)]))
    return out


MEMBERS = _band_members()
FIRST = np.cumsum(COUNTS) - COUNTS


def bands_of(samples: np.ndarray) -> list[bytes]:
    """Bucket keys of a fingerprint: bands of its last two octaves, those
    that reach beyond the text's end left out."""
    if not len(samples):
        return []
    last = int(_OCTAVE_OF[len(samples) - 1])
    out = []
    for o in range(max(0, last - 1), last + 1):
        picked = samples[FIRST[o]:FIRST[o] + COUNTS[o]][MEMBERS[o]]
        for k in np.flatnonzero((picked < 16).all(axis=1)).tolist():
            out.append(bytes([o, k]) + picked[k].tobytes())
    return out


def _as_long(band: bytes) -> int:
    """A bucket key (octave, number, up to eight samples of four bits) as a
    number, without loss."""
    out = band[0] << 40 | band[1] << 32
    for k, sample in enumerate(band[2:]):
        out |= sample << 4 * k
    return out


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the rows of (a, pa, b, pb) whose fingerprints are alike."""
    def emit(batches):
        for whole in batches:
            for batch in (whole.slice(i, BLOCK) for i in range(0, whole.num_rows, BLOCK)):
                a, b = np.split(packed(batch.column(1).to_pylist() + batch.column(3).to_pylist()), 2)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(
                    pa.array(likenesses(a, b) >= threshold))

    return pairs.select("a", "pa", "b", "pb").mapInArrow(emit, "a binary, b binary")


def links(prints: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that span the components of ``prints`` (cls,
    fingerprint; a class may come often): every two classes of a bucket
    whose likeness reaches the threshold are connected by them."""
    def emit(batches):
        for batch in batches:
            at, keys, seen = [], [], set()
            for i, (c, f) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if c not in seen:
                    seen.add(c)
                    own = bands_of(parse(f)[0])
                    at += [i] * len(own)
                    keys += own
            band = np.array([_as_long(k) for k in keys], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(band), batch.column(0).take(pa.array(at, pa.int64()))],
                                             names=["band", "cls"])

    rows = prints.select("cls", "fingerprint").mapInArrow(emit, "band long, cls binary")
    some = F.xxhash64("cls")
    shared = reliable_checkpoint(rows.groupBy("band").agg(F.min(some).alias("low"), F.max(some).alias("high"))
                                 .where("low <> high").select("band"))
    # both sides exchanged: a crowded bucket is split among tasks
    found = reliable_checkpoint(rows.join(shared, "band").distinct())
    members = reliable_checkpoint(found.join(found.groupBy("band").agg(
        F.min("cls").alias("hub"), F.count(F.lit(1)).alias("n")), "band"))
    needed = found.select("cls").distinct()
    classes = reliable_checkpoint(prints.select("cls", "fingerprint").join(needed, "cls", "left_semi")
                                  .groupBy("cls").agg(F.min("fingerprint").alias("fingerprint")))
    named_print = lambda c, p: classes.select(F.col("cls").alias(c), F.col("fingerprint").alias(p))
    stars = (members.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
             .join(named_print("b", "pb"), "b").join(named_print("a", "pa"), "a"))
    first = reliable_checkpoint(_verified(stars, threshold))

    # classes of a bucket outside the hub's component meet all others but the hub
    roots = components(first, "a", "b", FEW_LINKS)
    root = lambda c: F.coalesce(F.col(f"{c}_root"), F.col(c))
    named = (members.where("n > 2 and cls <> hub")
             .join(roots.select(F.col("node").alias("cls"), F.col("component").alias("cls_root")), "cls", "left")
             .join(roots.select(F.col("node").alias("hub"), F.col("component").alias("hub_root")), "hub", "left")
             .select("band", "cls", root("cls").alias("root"), (root("cls") != root("hub")).alias("apart")))
    named = reliable_checkpoint(named)
    open_ = reliable_checkpoint(named.groupBy("band").agg(
        F.count(F.lit(1)).alias("all"), F.count_if("apart").alias("apart_n"))
        .where("apart_n > 0 and all > 1").select(
        "band", F.ceil(F.col("all") / BLOCK).cast("int").alias("wide"),
        F.ceil(F.col("apart_n") / BLOCK).cast("int").alias("tall")))
    left = named.join(open_, "band").join(named_print("cls", "print"), "cls")
    spread = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    count_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = left.where("apart").select("band", spread("tall").alias("i"), count_to("wide").alias("j"), "cls", "root",
                                       "print", F.lit(True).alias("asks"))
    met = left.select("band", count_to("tall").alias("i"), spread("wide").alias("j"), "cls", "root", "print",
                      F.lit(False).alias("asks"))

    def compare(rows: pa.Table) -> pa.Table:
        asks = rows.column("asks").to_numpy()
        root = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy().copy()
        samples = packed(rows.column("print").to_pylist())
        meets = np.flatnonzero(~asks)
        pairs = []
        for x in np.flatnonzero(asks).tolist():
            others = meets[root[meets] != root[x]]
            near = others[likenesses(samples[x:x + 1], samples[others]) >= threshold]
            # one link to each component that is near
            for y in near[np.unique(root[near], return_index=True)[1]].tolist():
                root[root == root[y]] = root[x]
                pairs.append((x, y))
        at = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.table({n: rows.column("cls").take(pa.array(at[:, k])) for k, n in enumerate("ab")})

    rest = asked.unionByName(met).groupBy("band", "i", "j").applyInArrow(compare, "a binary, b binary")
    return first.unionByName(reliable_checkpoint(rest))


def near_duplicates(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``prints`` (doc_id, fingerprint, any others) without the fingerprint
    and with component_id: the least doc_id reachable by links between
    fingerprints whose likeness reaches ``threshold``, found by banding."""
    keyed = prints.withColumn("cls", F.unhex(F.md5("fingerprint")))
    roots = components(links(keyed, threshold), "a", "b", FEW_LINKS).select(F.col("node").alias("cls"), "component")
    rooted = reliable_checkpoint(keyed.drop("fingerprint").join(roots, "cls", "left")
                                 .withColumn("root", F.coalesce("component", "cls")).drop("component"))
    least = reliable_checkpoint(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return rooted.join(least, "root").drop("root")


def own_prints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fingerprint) of every row of ``docs``; ``mark`` is a
    hash of the text."""
    def emit(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [t.decode() for t in byte_texts(batch.column(2))]
            prints = [as_string(x, len(t)) for t, x in zip(texts, fingerprints([classes(t) for t in texts]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.string())],
                                             names=["doc_id", "mark", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), _mark().alias("mark"), "text").mapInArrow(
        emit, "doc_id long, mark long, fingerprint string")


def fingerprint_groups(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``document_fingerprints`` of ``docs`` with component_id: the least
    doc_id of the texts that are near duplicates of one another (see
    ``near_duplicates``). The fingerprints are made first, by themselves;
    the components then travel to the tasks that hold the texts, so neither
    texts nor results are shuffled once more."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "prints")
    own_prints(docs).write.option("compression", "zstd").parquet(path)
    prints = spark.read.schema("doc_id long, mark long, fingerprint string").parquet(path)
    named = reliable_checkpoint(near_duplicates(prints, threshold).select("doc_id", "mark", "cls", "component_id")
                                .distinct())
    discard(spark, path)
    return document_fingerprints(docs, named)
