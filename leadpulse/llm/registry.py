"""Registered queries of the corpus operators, with SQL where it can express
them. Each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm import (fingerprints, langid, minhash, mixing, packing, periodic, prefix_trie,
                           secret_scan, sharding, simhash, topk, toxicity, warc)
from leadpulse.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(spark, vectors, F.col("vec_id") % 100 == 0)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(spark, table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents and pages; the text model learns from the
    documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(spark, docs.where(~toxicity.held_out(F.col("doc_id"))))
    rows = langid.evidence_rows(docs, table(spark, sf_dir, "pages"))
    return langid.identify(spark, rows, model)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(spark, table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(spark, table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"),
                                  str(public_tokenizers.path(TOKENIZER)))


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same packing with loss on the last answers alone, so that all three limits bind."""
    return packing.pack_conversations(spark, table(spark, sf_dir, "conversations"),
                                      str(public_tokenizers.path(TOKENIZER)))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(spark, table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.opening_trie(spark, table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pivot_topk, op2_mix_sources, op3_fingerprints, op4_simhash, op5_language_id,
        op6_toxicity, op7_secret_scan, op8_packing, op9_warc, op10_sharding, op11_minhash,
        op12_periodic_runs, op13_prefix_trie, pack_conversations)
}

ORACLE_SQL: dict[str, str] = {
    "op1_pivot_topk": """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON c.r <> q.r AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), o AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS owner FROM p
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1
         AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN 'revisit'
       ELSE 'response' END AS record_type,
  CASE WHEN owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM o
""",
    "op13_prefix_trie": """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), seqs AS (
  SELECT conv_id, list({'role': role, 'txt': txt} ORDER BY pos) AS s FROM own GROUP BY conv_id
), crc AS (
  SELECT conv_id, s, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                      lambda c: ascii(c)::BIGINT)),
      lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i:
        xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 6 AS h
  FROM seqs
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:c.h], c.s[c.h + 1:]) AS s
  FROM crc c LEFT JOIN seqs b ON b.conv_id = c.conv_id - c.conv_id % 100
), entries AS (
  SELECT conv_id, d, s[1:d] AS prefix, s[1:d - 1] AS up, len(s) = d AS ends
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT prefix, any_value(up) AS up, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
         (count(*) - 1) * coalesce(length(prefix[min(d)].txt), 0) AS saved
  FROM entries GROUP BY prefix
), childs AS (
  SELECT up AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), below AS (
  SELECT v.prefix[1:a] AS prefix, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(v.saved) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes) v
  LEFT JOIN childs c ON c.prefix = v.prefix
  GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth,
       CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs,
       coalesce(c.n, 0) AS n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.prefix = n.prefix
LEFT JOIN nodes p ON p.prefix = n.up
LEFT JOIN childs c ON c.prefix = n.prefix
""",
}
