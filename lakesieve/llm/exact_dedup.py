"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its bytes read as a number to base 256, modulo a prime:
``H(ab) = H(a) * 256^len(b) + H(b)``. Chunks of a huge document are therefore
hashed apart, in tasks of their own, and combined by length-shifted arithmetic. Equal
fingerprints are only candidates: they are compared chunk by chunk with the row
that would stay, and whatever differs is grouped anew.

Defined results
---------------
null text            counts as the empty text
null id              a row like any other; never preferred as the one that stays
repeated rows        one output row per input row, ``kept`` on one of them only
empty table          empty result
other columns        ignored
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import build_filter, cut, filter_hits, ship, some_rows

MODULUS = 10**30 + 57
CHUNK = 1 << 20
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def combine(a: int, b: int, b_len: int, modulus: int = MODULUS) -> int:
    """Fingerprint of a text from those of its two parts."""
    return (a * pow(256, b_len, modulus) + b) % modulus


def fingerprint(data: bytes, modulus: int = MODULUS, chunk: int = CHUNK) -> int:
    """Fingerprint of data, chunk by chunk."""
    if len(data) <= chunk:
        return int.from_bytes(data, "big") % modulus
    total = 0
    view = memoryview(data)
    for i in range(0, len(data), chunk):
        part = view[i : i + chunk]
        total = combine(total, int.from_bytes(part, "big") % modulus, len(part), modulus)
    return total


def _normal(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """bytes.lower() changes A-Z only."""
    return [(x or b"").lower() for x in column.cast(pa.binary()).to_pylist()]


def _key(fp: int) -> bytes:
    return fp.to_bytes(16, "big")


def _short(fp: int) -> int:
    """63 bits of a fingerprint, for the filter."""
    return (fp * 0x9E3779B97F4A7C15 >> 7) & ((1 << 63) - 1)


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _huge_chunks(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> DataFrame:
    """id, n_bytes, sha256, part and piece: the chunks of normalised texts over `chunk` bytes, cut without Python."""
    rows = _columns(docs, id_col, text_col).where(F.octet_length("text") > chunk)
    rows = rows.withColumn("data", F.translate("text", CAPITALS, CAPITALS.lower()).cast("binary"))
    rows = rows.select("id", F.length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("sha256"), "data")
    rows = rows.withColumn("part", F.explode(F.expr(f"sequence(0, cast((n_bytes - 1) div {chunk} as int))")))
    return rows.select("id", "n_bytes", "sha256", "part", F.expr(f"substring(data, part * {chunk} + 1, {chunk})").alias("piece"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, modulus: int = MODULUS, chunk: int = CHUNK) -> DataFrame:
    """id, n_bytes, fp, sha256 and short hash of each normalised text, and n, the rows that share all of these.

    A text of more than `chunk` bytes is dealt to the tasks in chunks, which are
    hashed apart; a row for each chunk then carries its number, length and hash to
    where they are combined.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in some_rows(batches):
            data = _normal(b.column("text"))
            fps = [fingerprint(x, modulus, chunk) for x in data]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(x) for x in data], pa.int64()), pa.array(map(_key, fps), pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()), pa.array(map(_short, fps), pa.int64())],
                names=["id", "n_bytes", "fp", "sha256", "short"],
            )

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_key(fingerprint(x, modulus, chunk)) for x in b.column("piece").to_pylist()]
            lengths = pa.array([len(x) for x in b.column("piece").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "n_bytes", "sha256", "part")], lengths, pa.array(fps, pa.binary())], names=["id", "n_bytes", "sha256", "part", "length", "fp"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = []
            for parts in b.column("parts").to_pylist():
                total = 0
                for p in parts:
                    total = combine(total, int.from_bytes(p["fp"], "big"), p["length"], modulus)
                fps.append(total)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), pa.array(map(_key, fps), pa.binary()), b.column("sha256"), pa.array(map(_short, fps), pa.int64()), b.column("n")], names=["id", "n_bytes", "fp", "sha256", "short", "n"])

    small = _columns(docs, id_col, text_col).where(F.octet_length("text") <= chunk)
    small = small.mapInArrow(whole, f"id {kind}, n_bytes long, fp binary, sha256 string, short long")
    small = small.groupBy("id", "n_bytes", "fp", "sha256", "short").agg(F.count("*").alias("n"))
    huge = _huge_chunks(docs, id_col, text_col, chunk).repartition("id", "sha256", "part")
    huge = huge.mapInArrow(one, f"id {kind}, n_bytes long, sha256 string, part int, length long, fp binary")
    # 20 bytes and a bit for each chunk; rows that repeat a text repeat its chunks
    huge = huge.groupBy("id", "n_bytes", "sha256").agg(F.array_sort(F.collect_set(F.struct("part", "length", "fp"))).alias("parts"), F.count_if(F.col("part") == 0).alias("n"))
    return small.unionByName(huge.mapInArrow(joined, f"id {kind}, n_bytes long, fp binary, sha256 string, short long, n long"))


def _candidate_chunks(docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, bitmap: bytes, modulus: int, chunk: int) -> DataFrame:
    """Chunks of the texts whose fingerprint may be shared."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in some_rows(batches):
            data, ids = _normal(b.column("text")), b.column("id")
            fps = [fingerprint(x, modulus, chunk) for x in data]
            hits = np.flatnonzero(filter_hits(shared.value, np.array([_short(x) for x in fps], np.int64)))
            rows = hits.tolist()
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(hits)), pa.array([len(data[i]) for i in rows], pa.int64()), pa.array([_key(fps[i]) for i in rows], pa.binary()), pa.array([0] * len(rows), pa.int32()), pa.array([data[i] for i in rows], pa.binary())],
                names=["id", "n_bytes", "fp", "part", "piece"],
            )

    small = _columns(docs, id_col, text_col).where(F.octet_length("text") <= chunk).mapInArrow(run, f"id {kind}, n_bytes long, fp binary, part int, piece binary")
    of = classes.where(F.col("n_bytes") > chunk).select(F.col("id").alias("_id"), F.col("sha256").alias("_sha"), "fp")
    huge = _huge_chunks(docs, id_col, text_col, chunk).join(of, F.expr("id <=> _id and sha256 = _sha"))
    return small.unionByName(huge.select("id", "n_bytes", "fp", "part", "piece"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = MODULUS, chunk: int = CHUNK) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, sha256, n_bytes.

    Of equal texts (ASCII case aside) the largest id stays.
    """
    ship(docs.sparkSession)
    classes = cut(fingerprints(docs, id_col, text_col, modulus, chunk).withColumn("level", F.lit(0)), "exact")
    key = ["fp", "n_bytes", "level"]
    found = None
    while True:
        groups = classes.groupBy(*key).agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("m"), F.first("short").alias("short"))
        shared = cut(groups.where("m > 1"), "shared")
        if found is None:  # what is compared again later is among these
            found = cut(_candidate_chunks(docs, id_col, text_col, classes, build_filter(shared.select("short")), modulus, chunk), "pieces")
            pieces = found.withColumn("level", F.lit(0))
        else:  # texts that met with an equal fingerprint but differ: each has its level by now
            mine = classes.select(*[F.col(c).alias(f"_{c}") for c in ("id", *key)])
            pieces = found.join(mine, F.expr("id <=> _id and fp = _fp and n_bytes = _n_bytes")).select(*found.columns, F.col("_level").alias("level"))
        theirs = shared.select(*[F.col(c).alias(f"_{c}") for c in (*key, "keep_id")])
        stays = pieces.join(theirs, F.expr("id <=> _keep_id and fp = _fp and n_bytes = _n_bytes and level = _level"))
        stays = cut(stays.groupBy(*key, "part").agg(F.first("piece").alias("its")), "stays")
        # A plain equi-join between two exchanges: the engine splits a hot group, whose other side is one row a chunk.
        against = pieces.join(stays, [*key, "part"])
        differ = cut(against.where("piece != its").select("id", *key).distinct(), "differ")
        if differ.isEmpty():
            break
        moved = differ.select(*[F.col(c).alias(f"_{c}") for c in ("id", *key)])
        on = F.expr("id <=> _id and fp = _fp and n_bytes = _n_bytes and level = _level")
        classes = cut(classes.join(moved, on, "left").select("id", "n_bytes", "fp", "sha256", "short", "n", F.expr("level + if(_level is null, 0, 1) as level")), "exact")
    rows = classes.join(shared.select(*key, "keep_id", "group_size"), key, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    out = rows.select("id", keep.alias("keep_id"), F.coalesce("group_size", "n").alias("group_size"), "sha256", "n_bytes", F.explode(F.expr("sequence(1L, n)")).alias("copy"))
    return out.select("id", "keep_id", "group_size", F.expr("id <=> keep_id and copy = 1").alias("kept"), "sha256", "n_bytes")
