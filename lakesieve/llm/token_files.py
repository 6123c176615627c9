"""Token ids in binary shards with Elias-Fano document boundaries.

Documents are dealt by ranges of their ids and sorted within each; a shard holds
one range: MAGIC, the concatenated ids (two or four bytes each, little-endian),
a footer, the footer's length (8 bytes) and MAGIC again. The footer has a JSON
head and two Elias-Fano sequences: where each document starts, and the documents'
own ids. A shard is written as a stream; only boundaries are held.

Defined results
---------------
null or empty text   the end id alone
null id              before all other ids
repeated rows        each is a document of its own; equal ids stand by their texts
empty table          no shards, empty result
other columns        ignored
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesieve.llm.common import cut, new_path, parts, ship, size_mb
from lakesieve.llm.elias_fano import EliasFano
from lakesieve.llm.pieces import PieceCache, by_volume

MAGIC = b"LSTOKEN1"
RUN = 50  # pieces that the library is given at once


class LibraryEncoder:
    """The tokenizers library, each piece encoded once.

    Texts that hold an added token's string go to the library as a whole.
    """

    def __init__(self, path: str, limit: int = 350_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.pieces = PieceCache(self._pieces, self.width, limit)
        # Pieces stand for themselves under the byte-level pattern alone.
        config = json.loads(self.library.to_str())
        pre = config["pre_tokenizer"] or {}
        self.apart = config["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        # A byte-level token has a character for each of its bytes.
        self.bytes_of = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes_of[i] = len(token)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 1000):
            for e in self.library.encode_batch_fast(texts[i : i + 1000], add_special_tokens=False):
                yield array(self.code, e.ids).tobytes()

    def _pieces(self, pieces: list[str]) -> Iterator[bytes]:
        """Pieces that a space and no other begins or ends go to the library RUN at once, as one text, which is cheaper."""
        joins = not any(" " in a for a in self.added)
        runs = [pieces[i : i + RUN] for i in range(0, len(pieces), RUN)]
        for i in range(0, len(runs), 20):
            some = runs[i : i + 20]
            one = [joins and all(p[0] == " " and not p[-1].isspace() for p in run) for run in some]
            got = iter(self._encode(["".join(run) for run, o in zip(some, one, strict=True) if o]))
            for run, o in zip(some, one, strict=True):
                yield from (o and self._apart(run, next(got))) or self._encode(run)

    def _apart(self, run: list[str], data: bytes) -> list[bytes] | None:
        """The ids of pieces that were encoded as one text; None if a token crosses from one to the next."""
        ends = np.cumsum(list(map(len, map(str.encode, run))))
        after = np.cumsum(self.bytes_of[np.frombuffer(data, self.width)])
        at = np.searchsorted(after, ends)
        if after[-1] != ends[-1] or (after[at] != ends).any():
            return None
        edges = [0, *((at + 1) * self.width.itemsize).tolist()]
        return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds between texts)."""
        whole = [k for k, t in enumerate(texts) if not self.apart or any(a in t for a in self.added)]
        return self.pieces.ids(texts, dict(zip(whole, self._encode([texts[k] for k in whole]), strict=True)))


@lru_cache(2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


class ShardWriter:
    def __init__(self, out, width: np.dtype):
        self.out, self.width = out, np.dtype(width)
        self.ends: list[int] = [0]
        self.ids: list[int] = []
        self.nulls = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, data: bytes) -> None:
        self.out.write(data)
        self.ends.append(self.ends[-1] + len(data) // self.width.itemsize)
        if doc_id is None:
            self.nulls += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> None:
        least = self.ids[0] if self.ids else 0
        head = json.dumps({"width": self.width.itemsize, "nulls": self.nulls, "least": least}).encode()
        ids = np.array([i - least for i in self.ids], np.uint64)
        footer = len(head).to_bytes(8, "little") + head + EliasFano.encode(np.array(self.ends, np.uint64)).to_bytes() + EliasFano.encode(ids).to_bytes()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class Shard:
    """Random and sequential access to a shard."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - 16)
        tail = file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token shard")
        n = int.from_bytes(tail[:8], "little")
        file.seek(size - 16 - n)
        footer = file.read(n)
        m = int.from_bytes(footer[:8], "little")
        head = json.loads(footer[8 : 8 + m])
        self.bounds, at = EliasFano.from_bytes(footer, 8 + m)
        self.ids, _ = EliasFano.from_bytes(footer, at)
        self.width, self.nulls, self.least = np.dtype(f"<u{head['width']}"), head["nulls"], head["least"]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.ids[i - self.nulls] + self.least

    def tokens(self, i: int) -> np.ndarray:
        a, b = self.bounds[i], self.bounds[i + 1]
        self.file.seek(len(MAGIC) + a * self.width.itemsize)
        return np.frombuffer(self.file.read((b - a) * self.width.itemsize), self.width)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start and ids of each document, in order."""
        ends = self.bounds.all().astype(np.int64)
        names = [None] * self.nulls + [int(x) + self.least for x in self.ids.all()]
        self.file.seek(len(MAGIC))
        for name, a, b in zip(names, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield name, a, np.frombuffer(self.file.read((b - a) * self.width.itemsize), self.width)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", shard_mb: float = 64.0) -> DataFrame:
    """Writes the shards; returns their list: path, first_id, n_docs, n_ids, base (ids in all shards before)."""
    spark = docs.sparkSession
    ship(spark)
    folder = new_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = parts(spark, size_mb(docs), shard_mb)
    rows = rows.repartitionByRange(n, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakesieve.llm.bpe import _place

        enc = library_encoder(_place(vocabulary))
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        # A name of its own for each attempt: what a lost attempt left is in no list.
        path = f"{base}/{uuid.uuid4().hex}.tok"
        out = writer = None
        end = b"" if end_id is None else np.array([end_id], enc.width).tobytes()
        for b in batches:
            ids, strings = b.column("id").to_pylist(), b.column("text").to_pylist()
            for run in by_volume(list(range(len(strings))), map(len, strings)):
                flat, bounds = enc.encode([strings[i] for i in run])
                if writer is None:
                    out = fs.open_output_stream(path, compression=None, buffer_size=1 << 20)
                    writer = ShardWriter(out, enc.width)
                for i, a, z in zip(run, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    writer.add(ids[i], flat[a:z].tobytes() + end)
        if writer:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path.rsplit('/', 1)[1]}"], "first_id": pa.array([writer.ids[0] if not writer.nulls else None], pa.int64()), "n_docs": pa.array([len(writer.ends) - 1], pa.int64()), "n_ids": pa.array([writer.ends[-1]], pa.int64())})

    shards = cut(rows.mapInArrow(run, "path string, first_id long, n_docs long, n_ids long"), "shards")
    before = W.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of every document, from the files."""
    spark = shards.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    shard, rows = Shard(f, f.size()), []
                    for name, start, ids in shard.documents():
                        rows.append((name, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    return shards.select("path", "base").repartition(parts(spark)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
