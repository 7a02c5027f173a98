"""Chat formatting with cumulative-snapshot collapse, in DataFrame
operations alone.

A chat is often logged again after every reply, so that earlier logs are
prefixes of later ones. Each turn has a hash of its place, role and text;
the running XOR of two independent 64-bit hashes identifies every prefix
of a conversation. Equal conversations become one (the least conv_id); an
anti-join against the prefixes of longer conversations retains the
maximal ones; only their texts are gathered and rendered.

Only hashes travel up to that point, and the prefixes are made distinct
before they are shuffled, so a first turn that a third of all
conversations share is one row a task.

Defined results: turns are ordered by ``turn`` (nulls last), turns that
tie by a hash of role and text; a null role or text is part of a turn's
identity and rendered as empty; a null conv_id is one conversation;
repeated rows are repeated turns; other columns are ignored. Markers in
the texts are defused (``<|`` becomes ``< |``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.session import reliable_checkpoint


def _hash(seed: int):
    return F.xxhash64(F.lit(seed), F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def _order():
    return [F.col("turn").asc_nulls_last(), F.col("c1"), F.col("c2")]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, idx, n, p1, p2): for each turn of a conversation of ``n``
    turns the hash of its first ``idx`` turns."""
    own = turns.select("conv_id", "turn", _hash(1).alias("c1"), _hash(2).alias("c2"))
    at = Window.partitionBy("conv_id").orderBy(*_order())
    running = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = own.withColumn("idx", F.row_number().over(at))
    rows = rows.select("*", F.xxhash64("idx", "c1").alias("h1"), F.xxhash64("c2", "idx").alias("h2"))
    return rows.select(
        "conv_id", "idx", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"),
        F.bit_xor("h1").over(running).alias("p1"), F.bit_xor("h2").over(running).alias("p2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): one conversation of each content, with
    the number of equal ones, unless its turns begin a longer one."""
    hashes = reliable_checkpoint(prefix_hashes(turns))
    whole = hashes.where("idx = n").groupBy("n", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    begun = hashes.where("idx < n").select(F.col("idx").cast("long").alias("n"), "p1", "p2").distinct()
    return whole.join(begun, ["n", "p1", "p2"], "left_anti").select(
        "conv_id", F.col("n").alias("n_turns"), "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation of ``turns`` (conv_id, turn, role,
    text): conv_id, n_turns, n_copies and ``rendered``."""
    kept = maximal_conversations(turns)
    safe = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))
    own = turns.select(
        "conv_id", F.struct(F.col("turn").isNull().alias("last"), "turn", _hash(1).alias("c1"), _hash(2).alias("c2"),
                            F.concat(F.lit("<|"), safe("role"), F.lit("|>\n"), safe("text"), F.lit("<|end|>\n"))
                            .alias("line")).alias("t"))
    chosen = own.join(kept.select(F.col("conv_id").alias("kept_id")),
                      F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"]), "")
    lines = chosen.groupBy("conv_id").agg(text.alias("rendered"))
    return (kept.join(lines.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")))
            .select("conv_id", "n_turns", "n_copies", "rendered"))
