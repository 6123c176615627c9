"""Toxicity by a classifier chain of linear models.

The categories are predicted in order. Each model sees the text's features and
the probabilities of the categories before it; in training these come from
out-of-fold predictions, so that a later model learns from what an earlier one
says about texts it was not fitted on.

Features are whether a word, or its first 3 to 6 letters, occurs in the text,
hashed to 131,072 bits; each model keeps the `keep` bits that tell its classes
apart best. The chain is fitted on `sample` labelled documents at most, picked by
a hash of the id: what reaches the driver is 16 KiB at most for each. Predictions read
whole texts.

Defined results
---------------
null, empty or wordless text   probabilities 0, not toxic
no usable labels, or one class that category's probability is its rate, 0 without labels
null label                     that row is not learned from
null id                        predicted like any other, never learned from
repeated rows                  one output row per input row; repeated labels count once (the largest)
empty table                    empty result
other columns                  ignored
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import named, ship, some_rows

BITS = 1 << 17
TRIM = ".,;:!?|%&$#*()[]{}\"'«»“”¡¿-_"


def word_bits(word: str) -> list[int]:
    """Hashes of a lower-case word and of its beginnings."""
    w = word.strip(TRIM)
    if not w:
        return []
    return [zlib.crc32(f"={w}".encode()) % BITS, *(zlib.crc32(f"^{w[:n]}".encode()) % BITS for n in (3, 4, 5, 6) if len(w) > n)]


def text_bits(text: str | None) -> bytes:
    """All of a text's bits, packed: 16 KiB at most, a few after compression."""
    out = np.zeros(BITS, np.uint8)
    for w in set((text or "").lower().split()):
        out[word_bits(w)] = 1
    return zlib.compress(np.packbits(out).tobytes(), 1)


@dataclass
class Found:
    """Which bits are set in which of n texts."""

    n: int
    row: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Found:
        bits = [np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(t), np.uint8))).astype(np.int32) for t in texts]
        row = np.repeat(np.arange(len(bits), dtype=np.int32), [len(b) for b in bits])
        return cls(len(bits), row, np.concatenate(bits) if bits else np.zeros(0, np.int32))

    def only(self, rows: np.ndarray) -> Found:
        mine = rows[self.row]
        return Found(int(rows.sum()), (np.cumsum(rows) - 1)[self.row[mine]], self.bit[mine])

    def columns(self, bits: np.ndarray) -> np.ndarray:
        at = np.full(BITS, -1)
        at[bits] = np.arange(len(bits))
        at = at[self.bit]
        x = np.zeros((self.n, len(bits)), np.float32)
        x[self.row[at >= 0], at[at >= 0]] = 1
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic regression over some bits and the earlier categories' probabilities."""

    bits: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, found: Found, before: np.ndarray) -> np.ndarray:
        return _sigmoid(found.columns(self.bits) @ self.weights + before @ self.earlier + self.bias)


def fit_linear(found: Found, before: np.ndarray, y: np.ndarray, keep: int = 512, rounds: int = 150, l2: float = 0.5, least: float = 4.0) -> Linear:
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    none = np.zeros(0, np.int64)
    if not n1 or not n0:
        rate = 0.0 if not len(y) else n1 / len(y)
        return Linear(none, np.zeros(0, np.float32), np.zeros(before.shape[1], np.float32), 30.0 if rate == 1 else -30.0)
    on = np.bincount(found.bit, minlength=BITS)
    on1 = np.bincount(found.bit[y[found.row] == 1], minlength=BITS)
    share = on / len(y)
    apart = np.abs(on1 / n1 - (on - on1) / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    apart[(on < 3) | (on == len(y))] = 0
    bits = np.sort(np.argsort(-apart, kind="stable")[:keep])
    bits = bits[apart[bits] > least]  # standard errors
    x = np.hstack([found.columns(bits), before.astype(np.float32), np.ones((len(y), 1), np.float32)])
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    w[-1] = np.log(n1 / n0)
    decay = np.full(x.shape[1], l2)
    decay[-1] = 0
    for t in range(1, rounds + 1):  # Adam, full batch
        g = x.T @ (_sigmoid(x @ w.astype(np.float32)) - y).astype(np.float32) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(bits, w[: len(bits)].astype(np.float32), w[len(bits) : -1].astype(np.float32), float(w[-1]))


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    threshold: float


def fit_chain(found: Found, labels: np.ndarray, fold: np.ndarray, categories: list[str], folds: int = 5) -> Chain:
    """labels: a 0/1 column for each category. The threshold of the last is the one with the best F1 out of fold."""
    before = np.zeros((found.n, 0), np.float32)
    models = []
    for c in range(len(categories)):
        y = labels[:, c].astype(np.float64)
        out = np.zeros(len(y), np.float32)
        for k in range(folds):
            test = fold % folds == k
            if test.any() and not test.all():
                out[test] = fit_linear(found.only(~test), before[~test], y[~test]).predict(found.only(test), before[test])
        models.append(fit_linear(found, before, y))
        before = np.hstack([before, out[:, None]])
    threshold, y = 0.5, labels[:, -1] if len(labels) else np.zeros(0)
    if y.sum():
        p = before[:, -1]
        tried = [(2 * (y[p >= t].sum()) / max(1, (p >= t).sum() + y.sum()), t) for t in np.linspace(0.5, 0.9, 17)]
        threshold = float(max(tried)[1])
    return Chain(categories, models, threshold)


class Scorer:
    """The chain over texts, word by word; what a word turns on is found once while it is in use."""

    def __init__(self, chain: Chain, limit: int = 200_000):
        self.chain, self.limit = chain, limit
        self.used = np.unique(np.concatenate([m.bits for m in chain.models] or [np.zeros(0, np.int64)]))
        self.at = np.full(BITS, -1)
        self.at[self.used] = np.arange(len(self.used))
        self.columns = [np.searchsorted(self.used, m.bits) for m in chain.models]
        self.words: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> list[float]:
        found = set((text or "").lower().split())
        if not found:
            return [0.0] * len(self.chain.models)
        on: set[int] = set()
        words, some = self.words, False
        for w in found:
            bits = words.get(w)
            if bits is None:
                all_bits = word_bits(w)
                bits = words[w] = (tuple(k for k in self.at[all_bits].tolist() if k >= 0), bool(all_bits))
            if bits[0]:
                on.update(bits[0])
            some = some or bits[1]
        if len(words) > self.limit:
            words.clear()
        if not some:
            return [0.0] * len(self.chain.models)
        x = np.zeros(len(self.used), np.float32)
        x[list(on)] = 1
        p: list[float] = []
        for m, cols in zip(self.chain.models, self.columns, strict=True):
            p.append(float(_sigmoid(np.float64(x[cols] @ m.weights + np.array(p) @ m.earlier + m.bias))))
        return p


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", sample: int = 5000) -> Chain:
    """categories: name -> SQL expression over the label columns that is 1 where the category applies, in chain order."""
    spark = docs.sparkSession
    ship(spark)
    names = list(categories)
    rows = labels.select(F.col(id_col).alias("_id"), *[F.expr(e).cast("int").alias(n) for n, e in categories.items()])
    rows = rows.where(" and ".join(f"`{n}` is not null" for n in ["_id", *names])).groupBy("_id").agg(*[F.max(n).alias(n) for n in names])
    # At most `sample` rows whatever the size of the labels: this bounds what is broadcast and what is collected.
    rows = rows.orderBy(F.xxhash64(F.col("_id")), "_id").limit(sample)
    known = spark.createDataFrame(rows.collect(), rows.schema)
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = pa.array([text_bits(t) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_pydict({"h": b.column("h"), **{n: b.column(n) for n in names}, "bits": bits})

    # Of rows that share an id, the text with the least hash is learned from: one row an id, `sample` at most.
    picked = picked.groupBy("_id", *names).agg(F.min(F.struct(F.xxhash64("text").alias("k"), F.col("text").alias("text"))).alias("one"))
    picked = picked.select("one.text", F.xxhash64("_id").alias("h"), *names)
    got = picked.mapInArrow(run, "h long, " + ", ".join(f"`{n}` int" for n in names) + ", bits binary").collect()
    got.sort(key=lambda r: (r["h"], bytes(r["bits"])))
    y = np.array([[r[n] for n in names] for r in got], np.float64).reshape(-1, len(names))
    fold = np.array([r["h"] % 5 for r in got], np.int64)
    return fit_chain(Found.of([bytes(r["bits"]) for r in got]), y, fold, names)


def classify(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, p_<category> for each, toxic (the last category at its threshold) of every document, and the columns of keep as keep_<column>."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]
    others = [c for c in keep if c != text_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[named(c).alias(f"keep{k}") for k, c in enumerate(others)])
    carried = [f for f in rows.schema.fields if f.name != "text" or text_col in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value)
        for b in some_rows(batches):
            p = np.array([score(t) for t in b.column("text").to_pylist()], np.float64).reshape(-1, len(names))
            out = {f.name: b.column(f.name) for f in carried} | {n: pa.array(p[:, k]) for k, n in enumerate(names)}
            yield pa.RecordBatch.from_pydict(out | {"toxic": pa.array(p[:, -1] >= shared.value.threshold)})

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + [f"`{n}` double" for n in names] + ["`toxic` boolean"])
    out = rows.mapInArrow(run, schema)
    return out.select("id", *[F.col(f"`{n}`") for n in names], "toxic", *[F.col("text" if c == text_col else f"keep{others.index(c)}").alias(f"keep_{c}") for c in keep])
