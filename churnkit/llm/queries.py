"""The registered queries of the text operators and their DuckDB SQL.

Each ``opN_<name>`` applies its operator to the whole of its table and
derives the contract's digest columns from the operator's own output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm import (
    bin_slack, bpe, chat, edit_fingerprint, embedding_dedup, lexical, line_dedup, packing, prefix_trie, quality, simhash,
    substring_dedup, toxicity)
from churnkit.llm.common import table

#: the folder of the public tokenizers' files, on every machine
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[key] = fn
        if sql:
            _SQL[key] = sql
        return fn
    return deco


def text_sha(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, n, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)),
common AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.n, l.line, c.holder IS NOT NULL AND l.doc_id <> c.holder AS gone
  FROM lines l LEFT JOIN common c ON l.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op1_best_fit_packing")
def op1(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op2_substring_dedup")
def op2(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op4_bpe")
def op4(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@register("op5_embedding_near_dedup")
def op5(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


CHAT_SQL = """
WITH logged AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn) AS turns FROM conversations GROUP BY conv_id),
one AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM logged GROUP BY turns),
begun AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM one))
SELECT conv_id, len(turns) AS n_turns, n_copies,
       array_to_string(list_transform(turns, lambda t: '<|' || replace(coalesce(t.role, ''), '<|', '< |') || '|>' || chr(10)
                       || replace(coalesce(t.text, ''), '<|', '< |') || '<|end|>' || chr(10)), '') AS rendered
FROM one WHERE turns NOT IN (SELECT turns FROM begun)
"""


@register("op6_chat_formatting", CHAT_SQL)
def op6(spark, sf_dir):
    return chat.render(table(spark, sf_dir, "conversations"))


@register("op7_simhash_near_dedup")
def op7(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op8_document_fingerprints")
def op8(spark, sf_dir):
    return edit_fingerprint.fingerprint_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op9_line_dedup", LINE_SQL)
def op9(spark, sf_dir):
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", text_sha("text").alias("kept_sha256"))


@register("op10_quality_classifier")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register("op11_packing")
def op11(spark, sf_dir):
    return bin_slack.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


# CRC-32 by bits: each byte is followed by seven zeros, each step shifts by one bit
TRIE_SQL = r"""
WITH logged AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
dealt AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda ch: [ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda acc, x: CASE WHEN (xor(acc, x) & 1) = 1 THEN xor(xor(acc, x) >> 1, 3988292384) ELSE xor(acc, x) >> 1 END),
    4294967295) % 4 AS h FROM logged),
built AS (
  SELECT d.conv_id, list_concat(coalesce(b.turns[1:d.h], []), d.turns[d.h + 1:]) AS turns
  FROM dealt d LEFT JOIN logged b ON b.conv_id = d.conv_id - d.conv_id % 20),
member AS (
  SELECT conv_id, depth, turns[1:depth] AS node, turns[1:depth - 1] AS parent, depth = len(turns) AS ends,
         CASE WHEN depth > 0 THEN len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built)),
node AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY depth, node),
family AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
above AS (
  SELECT n.node[1:k] AS node, k AS depth, (f.n_children IS NULL)::BIGINT AS leaf, (n.n_convs - 1) * n.words AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM node) n LEFT JOIN family f ON f.depth = n.depth AND f.node = n.node),
subtree AS (SELECT depth, node, sum(leaf) AS n_leaves, sum(saved) AS saved FROM above GROUP BY depth, node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN subtree s ON s.depth = n.depth AND s.node = n.node
LEFT JOIN family f ON f.depth = n.depth AND f.node = n.node
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.parent
"""


@register("op12_conversation_prefix_trie", TRIE_SQL)
def op12(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


SEARCH_SQL = r"""
WITH asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
total AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM held),
long AS (SELECT doc_id, 50 + (50 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m FROM held, total GROUP BY doc_id),
counted AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY doc_id, term),
weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, total GROUP BY term),
scored AS (
  SELECT a.item_id, c.doc_id, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * l.m)))::BIGINT AS score
  FROM asked a JOIN counted c ON c.term = a.term JOIN weighed w ON w.term = a.term JOIN long l ON l.doc_id = c.doc_id
  GROUP BY a.item_id, c.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


@register("op13_ranked_lexical_search", SEARCH_SQL)
def op13(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
