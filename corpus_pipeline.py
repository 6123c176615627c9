"""Cleaning a corpus: what is toxic goes, then exact and near copies; sources are mixed to weights; texts become token ids.

Each stage takes (spark, docs, sf_dir), works on all of docs, and returns the
columns of documents, extra ones too, whatever their names; the last returns
doc_id, n_tokens and ids. A stage's result is written and read again before the next.

Defined results
---------------
null text          no toxicity; the empty text among exact copies; no near copy; size 0
                   in the mix, which takes it as often as its source's other documents; no tokens
null doc_id        never preferred as the one that stays, never a near copy, mixed like any other
null source        a source of its own
repeated rows      one of equal rows stays; rows of one doc_id with different texts are
                   one document to the near copies: they stay or go together
ties               of exact copies the largest doc_id stays, of near ones the smallest
very long texts    read whole by every stage
empty table        empty result
"""

from __future__ import annotations

from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.llm import toxicity as tox
from lakesieve.llm.bpe import encode_texts
from lakesieve.llm.common import cut, named
from lakesieve.llm.exact_dedup import CAPITALS, exact_groups
from lakesieve.llm.jaccard import jaccard_components
from lakesieve.llm.mixing import pareto_mix
from lakesieve.llm.registry import BPE_MULTI, TOXICITY

ORACLE_SQL = None


def _row(docs: DataFrame) -> Column:
    """All columns in one, so that none can clash with those that a stage adds."""
    return F.struct(*[named(c) for c in docs.columns]).alias("row")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on this stage's own input, holds toxic go."""
    chain = tox.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXICITY)
    kept = tox.classify(docs, chain, keep=tuple(docs.columns)).where(~F.col("toxic"))
    return kept.select(*[named(f"keep_{c}").alias(c) for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays; of repeated rows one."""
    found = cut(exact_groups(docs).where("kept").select("id", "sha256"), "kept")
    rows = docs.select(_row(docs), F.col("doc_id").alias("_id"))
    many = cut(docs.groupBy(F.col("doc_id").alias("m")).agg(F.count("*").alias("c")).where("c > 1").select("m"), "many")
    # A doc_id of one row tells the row; where there are more, the text tells which.
    once = rows.join(many, F.expr("_id <=> m"), "left_anti").join(found, F.expr("_id <=> id"), "left_semi")
    text = F.sha2(F.translate(F.coalesce("row.text", F.lit("")), CAPITALS, CAPITALS.lower()).cast("binary"), 256)
    more = rows.join(many, F.expr("_id <=> m"), "left_semi").withColumn("_sha", text)
    more = more.join(found, F.expr("_id <=> id and _sha = sha256"), "left_semi").dropDuplicates(["_id", "_sha"])
    return once.select("row.*").unionByName(more.select("row.*"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 or more over five-word shingles connect, the one with the smallest doc_id stays."""
    gone = jaccard_components(docs, n=5, num=4, den=5).where("id <> component").select("id")
    gone = cut(gone.distinct(), "gone")
    return docs.select(_row(docs), F.col("doc_id").alias("_id")).join(gone, F.expr("_id = id"), "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    got = pareto_mix(docs.select("doc_id", "text", "source", _row(docs)), keep=("row",))
    return got.where("copies > 0").select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_texts(docs, BPE_MULTI, PATTERN, lean=True).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_jaccard", near_dedup), ("mixing", mixing), ("byte_bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
