"""Queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.llm import langid, toxicity
from lakesieve.llm.bpe import encode_texts
from lakesieve.llm.embedding_dedup import near_vectors
from lakesieve.llm.exact_dedup import exact_groups
from lakesieve.llm.jaccard import jaccard_components
from lakesieve.llm.mixing import pareto_mix
from lakesieve.llm.substring_dedup import repeats
from lakesieve.llm.token_files import read_shards, write_shards
from lakesieve.llm.warc import decide, merge_index, read_archives, write_archives

BPE_MULTI = "byte_bpe_multi_50k.tiktoken"
BPE_50K = "byte_bpe_50k.json"
"""Names in public_tokenizers; a path may stand in their place."""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOXICITY = {"low_quality": "1 - quality", "toxic": "toxic"}
"""The chain over what the labels tell: unwanted quality, then toxicity, which sees the former's probability."""


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, _table(spark, sf_dir, "labels"), TOXICITY)
    return toxicity.classify(docs, chain).withColumnRenamed("id", "doc_id")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_vectors(_table(spark, sf_dir, "embeddings"), least=0.93)
    return got.withColumnsRenamed({"id": "vec_id", "component": "component_id"})


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).withColumnRenamed("id", "doc_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(_table(spark, sf_dir, "documents"), window=35).withColumnRenamed("id", "doc_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_groups(_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    got = encode_texts(_table(spark, sf_dir, "documents"), BPE_MULTI, PATTERN, with_ids=False, digests=True)
    return got.withColumnRenamed("id", "doc_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = write_archives(decide(_table(spark, sf_dir, "pages")))
    got = read_archives(merge_index(runs))
    return got.select(F.col("id").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers").alias("refers_to"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(_table(spark, sf_dir, "documents"), BPE_50K))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard_components(_table(spark, sf_dir, "documents"), n=3, num=9, den=10)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pareto_mix(_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(n, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.n)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, min(c) AS component_id, min(c) = vec_id AS kept
FROM v JOIN r ON r.n = v.vec_id GROUP BY vec_id
"""

OP4_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM s),
r AS (SELECT doc_id, i FROM h WHERE g IN (SELECT g FROM h GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
e AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, CASE WHEN js IS NULL THEN w ELSE list_select(w, list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(js, x))) END AS kept
      FROM d LEFT JOIN e USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""

OP5_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP7_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS m FROM p WHERE n >= 1000 GROUP BY h)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN g.m IS NOT NULL AND g.m <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.m IS NOT NULL AND g.m <> p.page_id THEN g.m END AS refers_to
FROM p LEFT JOIN g ON p.n >= 1000 AND p.h = g.h
"""

OP10_SQL = """
WITH RECURSIVE base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
s1 AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM s0),
s2 AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / w AS ratio FROM s1),
s3 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0.0) AS left_words, sum(w) OVER () - coalesce(sum(w) OVER o, 0.0) AS left_w
       FROM s2 WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, first_value(left_words / left_w) OVER (ORDER BY CASE WHEN left_words / left_w <= ratio THEN 0 ELSE 1 END, ratio, source NULLS LAST) AS lv FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN lv * w < cap THEN lv * w ELSE cap END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS share FROM s5),
s7 AS (SELECT *, floor(share) AS whole, share - floor(share) AS p, target - floor(share) * source_size AS rest FROM s6),
r0 AS (SELECT b.doc_id, b.source, b.size, s.source_size, s.target, s.whole, s.p, s.rest,
              CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds
       FROM base b JOIN s7 s ON b.source IS NOT DISTINCT FROM s.source),
r1 AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS mid FROM r0)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN p > 0 AND mid <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM r1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_toxicity": op1_toxicity, "op2_embedding_dedup": op2_embedding_dedup, "op3_language_id": op3_language_id, "op4_substring_dedup": op4_substring_dedup, "op5_exact_dedup": op5_exact_dedup, "op6_byte_bpe": op6_byte_bpe, "op7_warc": op7_warc, "op8_token_files": op8_token_files, "op9_ngram_jaccard": op9_ngram_jaccard, "op10_pareto_mix": op10_pareto_mix}


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op5_exact_dedup": OP5_SQL, "op7_warc": OP7_SQL, "op10_pareto_mix": OP10_SQL}
