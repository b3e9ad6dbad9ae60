"""One query for each operator over its whole table, and SQL where it can be expressed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstrata.llm import (
    decontamination,
    exact_dedup,
    html_extraction,
    lexical_search,
    pieces,
    pii,
    prefix_trie,
    quality,
    quotes,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from shopstrata.llm.common import held_out, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a document and a benchmark item of which it holds an exact or edited copy."""
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), carry=["doc_id"])
    return found.select("row.doc_id", "item_id", "similarity", "seeds", "first_word", "end_word")


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op2_exact_dedup"] = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS kept,
       sha256(content) AS text_sha256
FROM plain
"""


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced."""
    found = pii.replaced(table(spark, folder, "documents"), b"surrogate key of this corpus", carry=["doc_id"])
    return found.select("row.doc_id", "text", "n_entities")


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's bytes that a document with a smaller id does not already have."""
    found = suffix_dedup.without_repeats(table(spark, folder, "documents"), kept=False)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "fingerprint", "component_id")


@query
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, folder, "pages")
    found = html_extraction.extracted(pages, html_extraction.fit(pages), carry=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", "n_chars")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """A vocabulary file of the installed public tokenizers, under the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and decoded text, as digests."""
    found = pieces.encode(table(spark, folder, "documents"), model_path(), carry=["doc_id"], keep=())
    return found.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score."""
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    found = quality.scored(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity score."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    found = toxicity.scored(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


@query
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every message without its quotes, with what it quotes and its place among the replies; the given messages, made to quote each other."""
    messages = written(quotes.with_quotes(table(spark, folder, "conversations")), "quoting")
    found = quotes.linked(messages, carry=["conv_id", "turn", "role"])
    return found.select(
        "row.conv_id", "row.turn", "row.role", "own_text", "n_quotes", "deepest", "n_linked", "reply_to", "root", "quoted_from", "reply_order"
    )


@query
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of tokens."""
    found = token_counts.counted(table(spark, folder, "documents"), model_path("byte_bpe_50k.json"), carry=["doc_id"])
    return found.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


ORACLE["op12_ranked_search"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), counts AS (
  SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term
), lengths AS (
  SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term, docs
), items AS (
  SELECT row_number() OVER () AS item, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM benchmark
), asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items
), scored AS (
  SELECT item, item_id, row, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row), totals
  GROUP BY item, item_id, row
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie over the rebuilt conversations."""
    turns = prefix_trie.numbered(table(spark, folder, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns)).drop("node")


ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n,
         xor(list_reduce(
           list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(crc, byte)),
           4294967295::BIGINT), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id
), taken AS (
  SELECT convs.*, least(h, coalesce(b.n, 0)) AS taken FROM convs LEFT JOIN (SELECT conv_id AS base, n FROM convs) b USING (base)
), rebuilt AS (
  SELECT c.conv_id, t.pos - c.h + c.taken AS pos, t.role, t.text FROM taken c JOIN turns t USING (conv_id) WHERE t.pos > c.h
  UNION ALL
  SELECT c.conv_id, t.pos, t.role, t.text FROM taken c JOIN turns t ON t.conv_id = c.base WHERE t.pos <= c.h
), whole AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS seq
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), paths AS (
  SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM whole
), keyed AS (
  SELECT conv_id, depth, len(seq) = depth AS ended, seq[1:depth] AS node FROM paths
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, strlen(node[depth].text) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM keyed GROUP BY node, depth
), family AS (
  SELECT n.node, count(c.node) AS n_children FROM nodes n LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node GROUP BY n.node
), below AS (
  SELECT a.node, sum((d.n_convs - 1) * coalesce(d.bytes, 0))::BIGINT AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM nodes a JOIN nodes d ON d.depth >= a.depth AND d.node[1:a.depth] = a.node JOIN family f ON f.node = d.node GROUP BY a.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN family USING (node) JOIN below USING (node)
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""
