"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.session import ship  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run without ASCII white space; bytes.split() splits UTF-8 alike."""

def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Only in local mode, where the driver and the executors are one process, is a
    temporary one chosen where that is unset; on a cluster, each executor would
    write to its own disk.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + os.path.join(tempfile.gettempdir(), f"lakesieve-{spark.sparkContext.applicationId}")
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def named(column: str) -> Column:
    """A top-level column by its very name, which may hold dots and backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and a
    lost executor costs nothing before this point."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, mb: float = 0.0, each_mb: float = 32.0) -> int:
    """Partitions for mb of data: the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(mb / each_mb) + 1)


def size_mb(df: DataFrame) -> float:
    """Catalyst's estimate of df's size, in MB, without reading it; where it has none (rows from the driver), 0."""
    mb = float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) / 1e6
    return mb if mb < 1e9 else 0.0


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def some_rows(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what is made of one is small; what they held is given back at the end."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    give_back()


def give_back() -> None:
    """Memory that Arrow and the C library hold free goes back to the system: a Python worker outlives its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


# A fixed-size filter over hashes: at most 2^26 bits (8 MiB) whatever the data.
FILTER_BITS = 1 << 26
_BITS = 1 << 15  # of one row of Spark's bitmaps


def build_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """Bits set at hash mod bits for each value of the only (long) column.

    Aggregated as bitmaps on the executors; what reaches the driver is bits/8
    bytes at most, so broadcasting it is bounded at any scale. A fuller filter
    only lets more rows through to the exact step behind it.
    """
    (c,) = hashes.columns
    at = hashes.where(F.col(c).isNotNull()).select(F.expr(f"pmod(`{c}`, {bits}) + 1").alias("b"))
    got = at.groupBy(F.expr("bitmap_bucket_number(b)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("m"))
    out = np.zeros(bits // 8, np.uint8)
    for k, m in got.collect():  # bits / 32768 rows of 4 KiB at most
        out[(k - 1) * _BITS // 8 : k * _BITS // 8] |= np.frombuffer(bytes(m), np.uint8)
    return out.tobytes()


def filter_hits(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (int64) may be in build_filter's set."""
    bits = np.frombuffer(bitmap, np.uint8)
    at = np.mod(hashes.astype(np.int64), len(bits) * 8)
    return (bits[at >> 3] >> (at & 7)) & 1 == 1
