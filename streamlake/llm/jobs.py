"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, exact_dedup, minhash, mining, mixing, packing, quality, suffix_dedup, token_counts,
               url_filter, warc, whitening)
from .common import load_table, prepare



WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: (verdict, host, path prefix)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.match(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fit AS (SELECT page_id, rh || rp AS rule, rules.verdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k, host, path
  FROM parts LEFT JOIN rules ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE k = 1
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(load_table(spark, sf_dir, "documents", "doc_id", "text"))


OP3_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w
    AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load_table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.fit(docs, load_table(spark, sf_dir, "labels")))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op6_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(load_table(spark, sf_dir, "documents", "doc_id", "text"), WORD_BPE)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.group(load_table(spark, sf_dir, "documents", "doc_id", "text")).drop("key")


def op9_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(load_table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_RANKS,
                                       public_tokenizers.PATTERN, sections=token_counts.sentences)


#: a conversation that consists of control strings
TRAP = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    trap = spark.createDataFrame(TRAP, turns.schema)
    return chat.read_back(chat.format_windows(turns.unionByName(trap), BYTE_RANKS, public_tokenizers.PATTERN))


def op11_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(load_table(spark, sf_dir, "pages", "page_id", "url", "html")).drop("intact")


OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT page_id, strlen(t) AS n, sha1(t) AS h, max(page_id) OVER w AS top,
    row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) AS k FROM p WINDOW w AS (PARTITION BY t))
SELECT page_id, n AS payload_bytes, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to
FROM g
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH r AS (SELECT row_number() OVER () AS uid, vec_id AS id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid AS au, a.id AS anchor_id, r.uid, r.id, a.label = r.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r ON a.id % 100 = 0 AND a.uid <> r.uid),
p AS (SELECT *, row_number() OVER (PARTITION BY au ORDER BY score DESC, id NULLS LAST, uid) AS k FROM s WHERE same),
n AS (SELECT p.au, p.anchor_id, p.k, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.au, p.k ORDER BY s.score DESC, s.id NULLS LAST, s.uid) AS rank
  FROM p JOIN s ON p.au = s.au AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score WHERE p.k <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


_QUERIES = {"op1_url_filter": op1_url_filter, "op2_source_mixing": op2_source_mixing,
            "op3_exact_dedup": op3_exact_dedup, "op4_quality_classifier": op4_quality_classifier,
            "op5_nearest_neighbours": op5_nearest_neighbours, "op6_sequence_packing": op6_sequence_packing,
            "op7_repeated_spans": op7_repeated_spans, "op8_near_duplicates": op8_near_duplicates, "op9_section_tokens": op9_section_tokens,
            "op10_chat_windows": op10_chat_windows, "op11_warc_archives": op11_warc_archives,
            "op12_hard_negatives": op12_hard_negatives, "op13_embedding_whitening": op13_embedding_whitening}
_SQL = {"op1_url_filter": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op11_warc_archives": OP11_SQL,
        "op12_hard_negatives": OP12_SQL}


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    run.__name__ = query.__name__
    return run


def queries() -> dict:
    return {name: _prepared(q) for name, q in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
