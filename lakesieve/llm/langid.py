"""Language identification by nearest centroids.

A text is the L2-normalised TF-IDF vector of its hashed byte 1- to 3-grams. Each
language has several centroids, found by spherical k-means over its training
texts. A text gets the language of the centroid with the largest cosine; it is
rejected where its distance (1 - cosine) is over that centroid's radius.

The classifier is fitted on a bounded sample: `per_language` texts of each
language at most, picked by a hash of the id. Predictions read whole texts.

Defined results
---------------
null text or no letter   `und`, score 0, rejected
nothing to learn from    `und`, score 0, rejected
null lang                not learned from, but predicted like any other
null id                  not learned from, not held out
repeated rows            one output row per input row; of rows that share an id one is learned from
ties of centroids        the first language by name, the first of its centroids
empty table              empty result
other columns            ignored
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import ship

DIMS_BITS = 12
DIMS = 1 << DIMS_BITS
STEP = 1 << 20
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 33 else b for b in range(256))
_DROP = bytes(b for b in range(33, 128) if not chr(b).isalpha())
"""ASCII capitals become small, white space a space; ASCII digits and marks are left out."""
_LETTER = regex.compile(r"\p{L}")


def counts(data: bytes) -> np.ndarray:
    """Hashed byte n-gram counts of a whole text, in steps of bounded memory."""
    out = np.zeros(DIMS, np.int64)
    data = data.translate(_FOLD, _DROP)
    for i in range(0, max(1, len(data)), STEP):
        a = np.frombuffer(data[max(0, i - 2) : i + STEP], np.uint8).astype(np.uint32)
        new = i and 2
        for n in (1, 2, 3):
            code = a[: len(a) - n + 1] if n <= len(a) else a[:0]
            for k in range(1, n):
                code = code * np.uint32(257) + a[k : len(a) - n + 1 + k]
            code = (code + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(32 - DIMS_BITS)
            out += np.bincount(code[max(0, new - n + 1) :], minlength=DIMS)
    return out


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (np.log1p(c) * idf).astype(np.float32)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm == 0, 1, norm)


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray
    centers: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, cosine, rejected; for rows of counts."""
        sim = vectors(c, self.idf) @ self.centers.T
        best = sim.argmax(1)
        score = np.clip(sim[np.arange(len(best)), best], 0, 1).astype(np.float64)
        return self.owner[best], score, 1 - score > self.radius[best]


def fit(c: np.ndarray, langs: list[str], clusters: int = 4, rounds: int = 12, slack: float = 1.25) -> Centroids | None:
    if not len(langs):
        return None
    idf = np.log((1 + len(c)) / (1 + (c > 0).sum(0))) + 1
    x, names = vectors(c, idf), sorted(set(langs))
    centers, owner, radius = [], [], []
    for k, lang in enumerate(names):
        own = x[[y == lang for y in langs]]
        mine = [own.mean(0)]
        while len(mine) < min(clusters, len(own)):  # the text farthest from all so far starts the next
            mine.append(own[(own @ np.array(mine).T).max(1).argmin()])
        m = np.array(mine)
        for _ in range(rounds):
            m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            near = (own @ m.T).argmax(1)
            m = np.array([own[near == j].mean(0) if (near == j).any() else m[j] for j in range(len(m))])
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        sim = own @ m.T
        near, far = sim.argmax(1), 1 - sim.max(1)
        for j in range(len(m)):
            if (near == j).any():
                centers.append(m[j])
                owner.append(k)
                radius.append(min(1.0, float(np.quantile(far[near == j], 0.99)) * slack))
    return Centroids(names, np.array(owner), np.array(centers, np.float32), np.array(radius), idf)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def _count_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [counts(x or b"") for x in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": b.column("lang"), "h": b.column("h"), "counts": pa.array([np.minimum(g, 2**31 - 1).astype("<i4").tobytes() for g in got], pa.binary())})

    return rows.mapInArrow(run, "lang string, h long, counts binary")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 800, clusters: int = 4, languages: int = 500) -> Centroids | None:
    """Fitted on at most per_language texts of each language, of rows that aren't held out.

    The `languages` languages with the most rows are learned (of equally many, the
    first by name), so that what is collected and broadcast is bounded even where
    lang is free text. Of rows that share an id and a language, one is learned from.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    seen = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not seen:
        return None
    limit = [(r["lang"], math.ceil(min(1.0, per_language / r["count"]) * (1 << 30))) for r in seen]
    # `languages` rows at most: what is broadcast does not grow with the texts
    limits = spark.createDataFrame(limit, "lang string, most long")
    picked = rows.withColumn("h", F.expr(f"pmod(xxhash64(id), {1 << 30})")).join(F.broadcast(limits), "lang").where("h < most and text is not null")
    picked = picked.groupBy("lang", "id", "h").agg(F.min(F.struct(F.xxhash64("text").alias("k"), F.col("text").alias("text"))).alias("one"))
    got = sorted(_count_rows(picked.select("one.text", "lang", "h")).collect(), key=lambda r: (r["lang"], r["h"], bytes(r["counts"])))
    own: dict[str, list] = {}
    for r in got:
        own.setdefault(r["lang"], []).append(np.frombuffer(bytes(r["counts"]), "<i4"))
    pairs = [(lang, c) for lang, cs in own.items() for c in cs[:per_language]]
    return fit(np.array([c for _, c in pairs]), [lang for lang, _ in pairs], clusters) if pairs else None


def identify(docs: DataFrame, model: Centroids | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score, rejected of every document."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                data = part.column("text").to_pylist()
                ok = np.array([bool(m and t and _LETTER.search(t)) for t in data], bool)
                pred, score, far = ["und"] * len(data), np.zeros(len(data)), np.ones(len(data), bool)
                if at := np.flatnonzero(ok).tolist():
                    lang, s, f = m.predict(np.array([counts(data[k].encode()) for k in at]))
                    score[at], far[at] = s, f
                    for k, j in zip(at, lang, strict=True):
                        pred[k] = m.languages[j]
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "held_out": part.column("held_out"), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score), "rejected": pa.array(far)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
