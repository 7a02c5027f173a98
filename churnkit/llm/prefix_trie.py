"""The prefix trie of conversations, with what sharing prefixes would save.

Conversations are first rebuilt: conversation c begins with the first h
turns of conversation c - c % 20 (fewer if it has fewer), h being the
CRC-32 of c's decimal text modulo 4, followed by c's own turns after its
first h. Every distinct sequence of first d rebuilt turns (role, text) is a
node of depth d.

*Sequences.* Turns are numbered without gathering a conversation: the rows
are dealt into ranges of (conversation, turn), numbered within a range, and
carry on from the counts of the ranges before. A node's key is the XOR of
its turns' hashes (128 bits, each mixed with its depth), running over a
conversation by the same scheme.

*Shards.* Equal conversations become one sequence with a count. Sequences
sorted by the keys along them are in the trie's depth-first order; ranges
of them are shards, and each shard is encoded on its own as balanced
parentheses (a node opens, its subtree follows, it closes):

* *findclose*: blocks of 64 parentheses keep their least excess in a binary
  tree; from a node's opening the first place where the excess falls below
  is found in its block, or by climbing to the next block that falls so low.
  This delimits the node's subtree.
* *rank*: pairs "()" up to a place are counted, the difference over a
  subtree is its number of leaves.
* *cumulative arrays* over the nodes in preorder give members and savings
  of every subtree as differences. A node saves (members - 1) x words: the
  members' part adds up over shards, the one copy that stays is taken off
  in the shard where the node comes first.

*Shared spines.* Only nodes on the first and last path of a shard occur in
another; each range's first and last path say which of them began earlier
and whether the last leaf goes on. The shards' parts are added by node key.

*Layers.* A path row holds at most ``LAYER`` turns: longer conversations
are cut into layers, done from the deepest up, whose sums enter the layer
above at its deepest nodes. What follows a cut in one conversation alone is
a chain without savings and needs no shard.

What is kept in one place is bounded: a shard by ``SHARD_NODES`` (and one
Arrow batch of paths), a path row by ``LAYER``, on the driver two paths for
each range. A node's list of members that end there is hashed as a stream of
blocks of ids (``BLOCK_IDS`` wide), so a node where a third of all
conversations end takes long, but little memory; a digest of one list can't
be split.

Defined results: rows without conv_id belong to no conversation and are
left out; null turns come first, turns that are equal are ordered by their
hashes; a null role or text is empty; a conversation without turns after
rebuilding ends at the root; repeated rows are turns of their own; an empty
table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.session import reliable_checkpoint

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 20
HEADS = 4
LAYER = 512
SHARD_NODES = 200_000
BLOCK = 64
BLOCK_IDS = 65536
NODE = ("depth", "p1", "p2")
NONE = np.iinfo(np.int64).max


# balanced parentheses -----------------------------------------------------
class Parentheses:
    """A sequence of parentheses (+1 opens, -1 closes) that returns to
    excess zero."""

    def __init__(self, par: np.ndarray):
        self.par = par.astype(np.int64)
        self.excess = np.cumsum(self.par)
        blocks = max(1, -(-len(par) // BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, NONE, np.int64)
        padded[:len(par)] = self.excess
        self.least = np.full(2 * self.leaves, NONE, np.int64)  # a heap: node i over 2 i and 2 i + 1
        self.least[self.leaves:] = padded.reshape(self.leaves, BLOCK).min(axis=1)
        for i in range(self.leaves.bit_length() - 2, -1, -1):
            level = self.least[2 << i:4 << i]
            self.least[1 << i:2 << i] = np.minimum(level[0::2], level[1::2])
        pair = np.zeros(len(par), np.int64)
        pair[:-1] = (self.par[:-1] == 1) & (self.par[1:] == -1)
        self.pairs = np.concatenate([[0], np.cumsum(pair)])

    def _scan(self, start: np.ndarray, end: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place in [start, end) whose excess is ``goal``, or -1."""
        out = np.full(len(start), -1, np.int64)
        waiting = np.flatnonzero(start < end)
        at = start.copy()
        while len(waiting):
            hit = self.excess[at[waiting]] == goal[waiting]
            out[waiting[hit]] = at[waiting[hit]]
            waiting = waiting[~hit]
            at[waiting] += 1
            waiting = waiting[at[waiting] < end[waiting]]
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The place where each opening parenthesis is closed."""
        goal = self.excess[opens] - 1
        block = opens // BLOCK
        out = self._scan(opens + 1, np.minimum((block + 1) * BLOCK, len(self.par)), goal)
        far = np.flatnonzero(out < 0)
        node, goals = block[far] + self.leaves, goal[far]
        up = np.arange(len(far))
        while len(up):  # climb until a right neighbour falls so low
            found = (node[up] & 1 == 0) & (self.least[node[up] | 1] <= goals[up])
            node[up] = np.where(found, node[up] | 1, node[up] >> 1)
            up = up[~found]
        down = np.flatnonzero(node < self.leaves)
        while len(down):
            left = node[down] * 2
            node[down] = np.where(self.least[left] <= goals[down], left, left + 1)
            down = down[node[down] < self.leaves]
        start = (node - self.leaves) * BLOCK
        out[far] = self._scan(start, np.minimum(start + BLOCK, len(self.par)), goals)
        return out

    def leaf_pairs(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        return self.pairs[closes + 1] - self.pairs[opens]


class Paths:
    """Sorted distinct paths of a shard. ``p1``, ``p2``, ``w`` hold their
    levels one after the other (level 0 is the layer's top), ``size`` the
    levels of each; ``ends`` has for each path what enters at its last
    level: members, least conversation, leaves, savings, children, and
    whether the trie goes on below."""

    ENDS = ("m", "cid", "leaves", "saved", "children", "below")

    def __init__(self, size: np.ndarray, p1: np.ndarray, p2: np.ndarray, w: np.ndarray, ends: dict[str, np.ndarray]):
        self.size, self.p1, self.p2, self.w, self.ends = size, p1, p2, w, ends

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Paths:
        def whole(name):
            return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

        keys = batch.column(batch.schema.get_field_index("keys"))
        size = keys.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = keys.flatten()
        w = batch.column(batch.schema.get_field_index("ws")).flatten().to_numpy(zero_copy_only=False)
        ends = {c: whole(c).astype(np.int64) for c in cls.ENDS}
        return cls(size, flat.field("p1").to_numpy(zero_copy_only=False),
                   flat.field("p2").to_numpy(zero_copy_only=False), w, ends)

    @classmethod
    def joined(cls, parts: list[Paths]) -> Paths:
        def cat(name):
            return np.concatenate([getattr(p, name) for p in parts])
        return cls(cat("size"), cat("p1"), cat("p2"), cat("w"),
                   {c: np.concatenate([p.ends[c] for p in parts]) for c in cls.ENDS})

    def edge(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """The keys along the first or last path."""
        at = slice(len(self.p1) - int(self.size[-1]), None) if last else slice(0, int(self.size[0]))
        return self.p1[at], self.p2[at]

    def nodes(self, shared_before: int, shared_after: int) -> dict[str, np.ndarray]:
        """The shard's part of each of its nodes. ``shared_before`` levels of
        the first path are also on the path before it, ``shared_after`` of
        the last on the path after it."""
        size, count = self.size, len(self.size)
        first = np.cumsum(size) - size
        level = np.arange(len(self.p1)) - np.repeat(first, size)
        # a key stands for all that is above it, so equal levels are a prefix
        before = np.repeat(np.concatenate([[0], first[:-1]]), size) + level
        with_before = level < np.repeat(np.concatenate([[0], size[:-1]]), size)
        before = np.where(with_before, before, 0)
        same = with_before & (self.p1[before] == self.p1) & (self.p2[before] == self.p2)
        common = np.add.reduceat(same.astype(np.int64), first)
        common[0] = 0
        runs = np.zeros(2 * count + 1, np.int64)
        runs[2:2 * count:2] = size[:-1] - common[1:]
        runs[1::2] = size - common
        runs[-1] = size[-1]
        par = np.repeat(np.resize(np.array([-1, 1]), 2 * count + 1), runs)
        trie = Parentheses(par)
        opens = np.flatnonzero(par == 1)
        closes = trie.findclose(opens)

        new = level >= np.repeat(common, size)
        level, p1, p2, w = level[new], self.p1[new], self.p2[new], self.w[new]
        total = len(level)
        rank = np.arange(total)
        after = rank + (closes - opens + 1) // 2
        owned = np.ones(total, bool)
        owned[:min(shared_before, int(size[0]))] = False
        end = np.cumsum(size - common) - 1  # the node where each path ends

        def at_ends(values):
            out = np.zeros(total, np.int64)
            out[end] = values
            return out

        def over_subtree(values):
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[after] - sums[rank]

        goes_on = self.ends["below"].astype(bool).copy()
        goes_on[-1] |= shared_after >= size[-1]
        no_leaf = np.zeros(total, np.int64)
        no_leaf[end] = goes_on & (after[end] == end + 1)
        n = over_subtree(at_ends(self.ends["m"]))
        saved = over_subtree(n * w - owned * w + at_ends(self.ends["saved"]))
        leaves = trie.leaf_pairs(opens, closes) + over_subtree(at_ends(self.ends["leaves"]) - no_leaf)
        children, cid, parent = at_ends(self.ends["children"]), np.full(total, NONE, np.int64), np.full(total, -1)
        cid[end] = self.ends["cid"]
        by_level = np.argsort(level, kind="stable")
        cuts = np.searchsorted(level[by_level], np.arange(int(level.max()) + 2))
        rows = [by_level[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for depth in range(len(rows) - 1, 0, -1):
            here = rows[depth]
            parent[here] = rows[depth - 1][np.searchsorted(rows[depth - 1], here) - 1]
            np.add.at(children, parent[here], owned[here])
            np.minimum.at(cid, parent[here], cid[here])
        inner = parent >= 0
        return {"level": level, "p1": p1, "p2": p2, "q1": np.where(inner, p1[parent], 0),
                "q2": np.where(inner, p2[parent], 0), "n": n, "cid": cid, "children": children,
                "leaves": leaves, "saved": saved}


def _shared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    n = min(len(a[0]), len(b[0]))
    return int(((a[0][:n] == b[0][:n]) & (a[1][:n] == b[1][:n])).sum())


# one layer ----------------------------------------------------------------
def _layer(paths: DataFrame, base: int, shard_nodes: int) -> DataFrame:
    """The nodes at depth ``base`` (the tops) and below of ``paths`` (keys,
    ws and the columns of ``Paths.ENDS``)."""
    sorted_paths = reliable_checkpoint(paths.repartitionByRange("keys").sortWithinPartitions("keys"))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                part = Paths.read(batch)
                first, last = first or part.edge(False), part.edge(True)
        if first:
            columns = [pa.array([TaskContext.get().partitionId()], pa.int64()),
                       *(pa.array([x.astype(np.int64)], pa.list_(pa.int64())) for x in (*first, *last))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "a1", "a2", "b1", "b2"])

    # two paths for each range, each of at most LAYER + 1 keys
    schema = "part long, a1 array<long>, a2 array<long>, b1 array<long>, b2 array<long>"
    ranges = sorted((r.part, (np.array(r.a1), np.array(r.a2)), (np.array(r.b1), np.array(r.b2)))
                    for r in sorted_paths.select("keys", "ws", *Paths.ENDS).mapInArrow(edges, schema).collect())
    shared = [_shared(x[2], y[1]) for x, y in zip(ranges, ranges[1:])]
    before = dict(zip([r[0] for r in ranges], [0, *shared]))
    after = dict(zip([r[0] for r in ranges], [*shared, 0]))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[Paths] = []
        shared_before = before.get(part, 0)

        def flush(shared_after):
            out = Paths.joined(held).nodes(shared_before, shared_after)
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in out.values()], names=list(out))

        for batch in batches:
            if not batch.num_rows:
                continue
            paths = Paths.read(batch)
            if sum(len(p.p1) for p in held) >= shard_nodes:
                meet = _shared(held[-1].edge(True), paths.edge(False))
                yield flush(meet)
                held, shared_before = [], meet
            held.append(paths)
        if held:
            yield flush(after.get(part, 0))

    names = ("level", "p1", "p2", "q1", "q2", "n", "cid", "children", "leaves", "saved")
    parts = sorted_paths.mapInArrow(shards, ", ".join(f"{c} long" for c in names))
    # a spine node has one part in each of its shards
    return (parts.groupBy((F.col("level") + base).alias("depth"), "p1", "p2")
            .agg(F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.sum("n").alias("n"), F.min("cid").alias("cid"),
                 F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


# sequences ----------------------------------------------------------------
def _running(rows: DataFrame, column, by: str, names: dict[str, str]) -> DataFrame:
    """``rows`` (conv, part, ...) with running aggregates over each
    conversation in the order (part, ``by``): within a part by a window,
    carried on from the totals of the parts before. ``names`` maps the new
    columns to those aggregated by ``column``."""
    totals = rows.groupBy("conv", "part").agg(*[column(c).alias(f"_{n}") for n, c in names.items()])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv", "part", *[F.coalesce(column(f"_{n}").over(earlier), F.lit(0).cast("long")).alias(f"_{n}")
                                             for n in names])
    own = Window.partitionBy("conv", "part").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("*", *[column(c).over(own).alias(n) for n, c in names.items()]).join(totals, ["conv", "part"])


def turns(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation: conv, part, pos (0, 1, ...), two
    hashes and the number of words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", F.asc_nulls_first("turn"), "t1", "t2", "row"]
    dealt = reliable_checkpoint(rows.repartitionByRange(*order)).withColumn("part", F.spark_partition_id().cast("long"))
    in_part = Window.partitionBy("conv", "part").orderBy(*order[1:])
    counts = dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (dealt.withColumn("pos", F.row_number().over(in_part).cast("long") - 1).join(offsets, ["conv", "part"])
            .select("conv", "part", (F.col("pos") + F.col("offset")).alias("pos"), "t1", "t2", "w"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv, d, w, the node's key p1, p2,
    its parent's q1, q2, and whether it is the last) and the conversations
    that have none (conv)."""
    own = reliable_checkpoint(turns(conversations))
    conv = F.col("conv")
    heads = (own.where((conv % GROUP == 0) & (F.col("pos") < HEADS - 1)).groupBy(conv.alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "w"))).alias("head")))
    convs = own.groupBy("conv").agg(F.count(F.lit(1)).alias("n_own")).select(
        "conv", "n_own", (conv - conv % GROUP).alias("base"),
        (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int").alias("h"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.expr("coalesce(slice(head, 1, h), array())"))
    convs = reliable_checkpoint(convs.select(
        "conv", "h", "head", F.size("head").alias("k"),
        (F.size("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).cast("long").alias("length")))
    tail = own.join(convs.drop("head"), "conv").where("pos >= h").select(
        "conv", "part", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("d"), "t1", "t2", "w", "length")
    head = convs.select("conv", "length", F.explode("head").alias("t")).select(
        "conv", F.lit(-1).cast("long").alias("part"), (F.col("t.pos") + 1).alias("d"), "t.t1", "t.t2", "t.w", "length")
    rows = head.union(tail.select(head.columns)).select(
        "conv", "part", "d", "w", (F.col("d") == F.col("length")).alias("last"),
        F.xxhash64("t1", "t2", "d").alias("g1"), F.xxhash64(F.lit(1), "d", "t2", "t1").alias("g2"))
    rows = _running(rows, F.bit_xor, "d", {"r1": "g1", "r2": "g2"})
    p1, p2 = (F.col(f"r{i}").bitwiseXOR(F.col(f"_r{i}")) for i in (1, 2))
    return reliable_checkpoint(rows.select(
        "conv", "d", "w", "last", p1.alias("p1"), p2.alias("p2"),
        p1.bitwiseXOR(F.col("g1")).alias("q1"), p2.bitwiseXOR(F.col("g2")).alias("q2"))), convs.where("length = 0").select("conv")


def _digests(ends: DataFrame) -> DataFrame:
    """The SHA-256 of each node's ascending, comma-joined members that end
    there (``ends``: a row for each conversation)."""
    block = F.floor(F.col("conv") / BLOCK_IDS).cast("long").alias("block")
    lists = ends.groupBy(*NODE, block).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = lists.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(done)
        if node:
            yield _rows([(*node, state.hexdigest())])

    def _rows(done):
        columns = list(zip(*done)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]),
                                           pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])

    return dealt.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame, layer: int = LAYER, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id,
    turn, role, text): conv_id (the least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    rows, turnless = rebuilt(conversations)
    zero = F.lit(0).cast("long")
    ends = reliable_checkpoint(rows.where("last").select("conv", F.col("d").alias("depth"), "p1", "p2").union(
        turnless.select("conv", zero, zero, zero)))
    if ends.isEmpty():
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, "
                                         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    rows = rows.withColumn("j", F.floor((F.col("d") - 1) / layer).cast("long"))
    deepest = rows.agg(F.max("j")).first()[0] or 0
    done, chains, tops = [], None, None
    if deepest:  # chains of one conversation below a cut
        alone = (rows.where((F.col("d") - 1) % layer == 0).where("j > 0").groupBy("j", "q1", "q2")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n = 1")
                 .groupBy("conv").agg(F.min("j").alias("from")))
        rows = reliable_checkpoint(rows.join(alone, "conv", "left"))
        chain = F.col("from").isNotNull() & (F.col("j") >= F.col("from"))
        one = F.lit(1).cast("long")
        done.append(rows.where(chain).select(
            F.col("d").alias("depth"), "p1", "p2", "q1", "q2", one.alias("n"), F.col("conv").alias("cid"),
            F.when(F.col("last"), 0).otherwise(1).cast("long").alias("children"), one.alias("leaves"),
            zero.alias("saved")))
        chains = rows.where(F.col("d") - 1 == F.col("from") * layer).select(
            (F.col("d") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), one.alias("n"),
            F.col("conv").alias("cid"), one.alias("children"), one.alias("leaves"), zero.alias("saved"))
        rows = rows.where(~chain)
        deepest = rows.agg(F.max("j")).first()[0] or 0
    members = ends.groupBy(*NODE).agg(F.count(F.lit(1)).alias("m"), F.min("conv").alias("conv"))
    chosen = rows.join(members.select("conv", "m"), "conv")  # of equal conversations the first
    top = F.min(F.struct("d", F.col("q1").alias("p1"), F.col("q2").alias("p2")))
    steps = F.sort_array(F.collect_list(F.struct("d", "p1", "p2", "w")))
    paths = (chosen.groupBy("conv", "j").agg(steps.alias("steps"), top.alias("top"),
                                             F.max(F.when(F.col("last"), F.col("m"))).alias("m"))
             .select("j", F.expr("concat(array(struct(top.p1, top.p2)), transform(steps, s -> struct(s.p1, s.p2)))")
                     .cast("array<struct<p1: long, p2: long>>").alias("keys"),
                     F.expr("concat(array(0L), transform(steps, s -> s.w))").alias("ws"),
                     F.coalesce("m", zero).alias("m"),
                     F.when(F.col("m").isNotNull(), F.col("conv")).otherwise(F.lit(int(NONE))).alias("cid")))
    root = members.where("depth = 0").select(
        zero.alias("j"), F.expr("array(struct(0L, 0L))").cast("array<struct<p1: long, p2: long>>").alias("keys"),
        F.expr("array(0L)").alias("ws"), "m", F.col("conv").alias("cid"))
    paths = paths.union(root)
    if chains is not None:
        paths = reliable_checkpoint(paths)
    for j in range(deepest, -1, -1):
        mine = paths.where(F.col("j") == j).drop("j")
        if chains is None:
            mine = mine.select("keys", "ws", "m", "cid", zero.alias("leaves"), zero.alias("saved"),
                               zero.alias("children"), zero.alias("below"))
        else:  # conversations that part below a cut have one path above it
            depth = (F.size("keys") - 1 + j * layer).cast("long")
            mine = mine.groupBy(depth.alias("depth"), F.element_at("keys", -1).alias("end")).agg(
                F.max("keys").alias("keys"), F.max("ws").alias("ws"), F.sum("m").alias("m"), F.min("cid").alias("cid"))
            below = chains if tops is None else chains.union(tops)
            mine = mine.select("*", "end.p1", "end.p2").join(
                below.select(*NODE, *[F.col(c).alias(f"_{c}") for c in ("n", "cid", "children", "leaves", "saved")]),
                list(NODE), "left")
            mine = mine.select(
                "keys", "ws", (F.col("m") + F.coalesce("_n", zero)).alias("m"), F.least("cid", "_cid").alias("cid"),
                *[F.coalesce(f"_{c}", zero).alias(c) for c in ("leaves", "saved", "children")],
                F.col("_n").isNotNull().cast("long").alias("below"))
        nodes = _layer(mine, j * layer, shard_nodes)
        if j:
            nodes = reliable_checkpoint(nodes)
            tops = nodes.where(F.col("depth") == j * layer).select(chains.columns)
        done.append(nodes.where(F.col("depth") > j * layer) if j else nodes)
    nodes = done[0].select(*NODE, "q1", "q2", "n", "cid", "children", "leaves", "saved")
    for part in done[1:]:
        nodes = nodes.union(part.select(nodes.columns))
    nodes = reliable_checkpoint(nodes)
    least = ends.agg(F.min("conv")).first()[0]
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"),
                                              F.col("p2").alias("q2"), F.col("cid").alias("parent"))
    # the root, parent of a large part of all nodes, needs no join
    with_parent = nodes.where("depth > 1").join(parents, ["depth", "q1", "q2"]).select(*nodes.columns, "parent").union(
        nodes.where("depth <= 1").select("*", F.when(F.col("depth") == 1, F.lit(least)).cast("long")))
    return (with_parent.join(_digests(ends), list(NODE), "left").select(
        F.col("cid").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
