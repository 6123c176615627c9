"""Removal of word sequences that occur more than once, by fixed-block anchors.

A window of `window` words holds at least one whole block of
``(window + 1) // 2`` words that starts at a multiple of this length. So the
non-overlapping blocks of every text are the index, and every rolling window of a
block's length probes it. A block that is found elsewhere is an anchor. Around
each anchor, the words that a repeat through it can span are looked at window by
window: runs of windows that start somewhere else too make up the maximal exact
repeats, and their words are removed.

Hashes are exchanged in packed arrays. A task settles what repeats among its own
texts and sends each hash once, so that a passage that fills the corpus costs a
task one entry. Probes carry 32 bits next to their bucket: a chance hit only costs
a look. Windows carry 128 bits, two hashes of different bases: among n windows near
anchors, different ones agree by chance about n^2 / 2^129 times, also at 10^13 windows.

Defined results
---------------
null, empty or wordless text   no words, nothing removed, kept text empty
fewer words than the window    nothing removed
null id                        its windows count, its row has a null id
repeated rows                  each is a text of its own: they repeat each other; one output row per input row
empty table                    empty result
other columns                  ignored
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import build_filter, cut, filter_hits, give_back, parts, ship, size_mb
from lakesieve.llm.shingles import SECOND, windows

FLUSH = 1 << 21  # words that a task hashes before it packs what it has
LOOK = 1 << 19  # windows, which carry two hashes and their places, likewise


class Exchange:
    """Packs hashes of places by bucket, and finds which of them stand in more than one place.

    A place is (group, text, position); places that nobody asks about are probes.
    Where `more` is given, a second hash of each place, both must agree.
    """

    def __init__(self, buckets: int, groups: int, short: bool):
        self.buckets, self.groups, self.short = buckets, groups, short
        self.kind = np.dtype("<u4" if short else "<u8")

    def pack(self, hashes: np.ndarray, asked: np.ndarray, text: np.ndarray, pos: np.ndarray, more: np.ndarray | None = None) -> Iterator[tuple[int, int, bytes]]:
        """(kind, key, data): 0 unasked and 1 asked entries by bucket, 2 answers that are known here, by group."""
        if not len(hashes):
            return
        order = np.argsort(hashes, kind="stable") if more is None else np.lexsort((more, hashes))
        h, ask, text, pos = hashes[order], asked[order], text[order], pos[order]
        differs = np.diff(h, prepend=h[0] ^ np.uint64(1)) != 0
        if more is not None:
            more = more[order]
            differs |= np.diff(more, prepend=more[0]) != 0
        new = np.flatnonzero(differs)
        times = np.diff(np.append(new, len(h)))
        many = np.repeat(times > 1, times)
        yield from answers(text[many & ask], pos[many & ask], self.groups)
        # One entry a hash; a bit says whether it stands in several places here.
        one, ask_one = new, ask[new] & (times == 1)
        bucket = (h[one] >> np.uint64(40)).astype(np.int64) % self.buckets
        value = (h[one] & np.uint64(0xFFFFFFFF)).astype("<u4") if self.short else h[one]
        second = value[:0] if more is None else more[one]
        by = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[by], np.arange(self.buckets + 1))
        for k in range(self.buckets):
            own = by[ends[k] : ends[k + 1]]
            if not len(own):
                continue
            twice, a = times[own] > 1, ask_one[own]
            other = own if more is not None else own[:0]
            plain = value[own[~a]]
            yield 0, k, len(plain).to_bytes(8, "little") + plain.tobytes() + second[other[~a[: len(other)]]].tobytes() + np.packbits(twice[~a]).tobytes()
            if a.any():
                at = one[own][a]
                yield 1, k, value[own[a]].tobytes() + second[other[a[: len(other)]]].tobytes() + text[at].astype("<i8").tobytes() + pos[at].astype("<i4").tobytes()

    def settle(self, rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        """Answers for the asked entries of one bucket that stand in another place too."""
        w, two = self.kind.itemsize, 0 if self.short else 8
        plain, weight, asked, text, pos = [], [], [], [], []
        for kind, data in rows:
            n = int.from_bytes(data[:8], "little") if kind == 0 else len(data) // (w + two + 12)
            at = 8 if kind == 0 else 0
            hashes = (np.frombuffer(data, self.kind, n, at), np.frombuffer(data, "<u8", n if two else 0, at + n * w if two else 0))
            at += n * (w + two)
            if kind == 0:
                plain.append(hashes)
                weight.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=at))[:n] + np.uint8(1))
            else:
                asked.append(hashes)
                text.append(np.frombuffer(data, "<i8", n, at))
                pos.append(np.frombuffer(data, "<i4", n, at + n * 8))
        if not asked:
            return
        found = (_times_of_one if self.short else _times_of_two)(asked, plain, weight) > 1
        yield from answers(np.concatenate(text)[found], np.concatenate(pos)[found], self.groups)


def _times_of_one(asked: list[tuple], plain: list[tuple], weight: list[np.ndarray]) -> np.ndarray:
    """How often each asked hash stands among all; the plain ones, by far the most, are looked up part by part."""
    mine = np.concatenate([h for h, _ in asked])
    of = np.unique(mine)
    total = np.bincount(np.searchsorted(of, mine), minlength=len(of))
    for (v, _), c in zip(plain, weight, strict=True):
        at = np.searchsorted(of, v)
        at[at == len(of)] = 0
        hit = of[at] == v
        total += np.bincount(at[hit], c[hit], minlength=len(of)).astype(total.dtype)
    return total[np.searchsorted(of, mine)]


def _times_of_two(asked: list[tuple], plain: list[tuple], weight: list[np.ndarray]) -> np.ndarray:
    """How often each asked pair of hashes stands among all."""
    first, second = (np.concatenate([h[k] for h in asked + plain]) for k in (0, 1))
    n = sum(len(h) for h, _ in asked)
    times = np.concatenate([np.ones(n, np.int64), *weight])
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.add.reduceat(times[order], new), np.diff(np.append(new, len(order)))) if len(order) else 0
    return out[:n]


def answers(text: np.ndarray, pos: np.ndarray, groups: int) -> Iterator[tuple[int, int, bytes]]:
    """Places as (2, group, bytes) for each group of texts."""
    if not len(text):
        return
    group = text % groups
    order = np.lexsort((pos, text, group))
    group, text, pos = group[order], text[order], pos[order]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(group)), strict=True):
        yield 2, int(group[a]), text[a:b].astype("<i8").tobytes() + pos[a:b].astype("<i4").tobytes()


def _places(blobs: list[bytes]) -> dict[int, np.ndarray]:
    """Positions by text."""
    if not blobs:
        return {}
    sizes = [len(d) // 12 for d in blobs]
    text = np.concatenate([np.frombuffer(d, "<i8", n) for d, n in zip(blobs, sizes, strict=True)])
    pos = np.concatenate([np.frombuffer(d, "<i4", n, n * 8) for d, n in zip(blobs, sizes, strict=True)])
    order = np.lexsort((pos, text))
    text, pos = text[order], pos[order]
    first = np.flatnonzero(np.diff(text, prepend=-1))
    return {int(text[a]): pos[a:b] for a, b in zip(first, np.append(first[1:], len(text)), strict=True)}


def near_anchors(n_words: int, anchors: np.ndarray, block: int, window: int) -> np.ndarray:
    """Starts of the windows that hold an anchored block."""
    reach = window - block
    starts = (anchors[:, None] * block + np.arange(-reach, 1)[None, :]).ravel()
    return np.unique(starts[(starts >= 0) & (starts <= n_words - window)])


def cover(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words the windows at these starts cover."""
    step = np.zeros(n_words + 1, np.int64)
    step[starts] += 1
    np.subtract.at(step, np.minimum(starts + window, n_words), 1)
    return np.cumsum(step[:-1]) > 0


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _through(packed: DataFrame, exchange: Exchange) -> DataFrame:
    """Entries by bucket -> answers (group, data), in the shared folder."""

    def settle(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True))
        known = [(2, g, d) for (kind, d), g in zip(rows, table.column("grp").to_pylist(), strict=True) if kind == 2]
        out = known + list(exchange.settle([r for r in rows if r[0] < 2]))
        give_back()
        return pa.table({"grp": pa.array([g for _, g, _ in out], pa.int32()), "data": pa.array([d for _, _, d in out], pa.binary())})

    # Answers that are known already pass along; they are dealt by their own number.
    return cut(packed.groupBy("bucket").applyInArrow(settle, "grp int, data binary"), "answers")


def _packed(rows: list[tuple[int, int, bytes]], buckets: int) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        kind, key, data = zip(*rows[i : i + 64], strict=True)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(kind, pa.int32()), "bucket": pa.array([k if t < 2 else k % buckets for t, k in zip(kind, key, strict=True)], pa.int32()), "grp": pa.array([k if t == 2 else -1 for t, k in zip(kind, key, strict=True)], pa.int32()), "data": pa.array(data, pa.binary())})


def repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (and kept, the text that is left) of every document."""
    spark = docs.sparkSession
    ship(spark)
    block = (window + 1) // 2
    mb = size_mb(docs)
    # Texts come together by groups of about 8 MB: what a group sends is an array a bucket, so groups follow the data alone.
    buckets, groups = parts(spark, mb), max(2 * spark.sparkContext.defaultParallelism, int(mb / 8) + 1)
    kind = docs.schema[id_col].dataType.simpleString()
    # Texts are known by a hash of id and text: equal rows share it, which is no harm, for they repeat each other.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.expr(f"shiftrightunsigned(xxhash64(`{id_col}`, `{text_col}`), 1)").alias("name"))

    # 1: which blocks of which texts stand elsewhere too
    anchors_by = Exchange(buckets, groups, short=True)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate([x for _, x in held])
            pos = np.concatenate([np.arange(len(x)) for _, x in held])
            text = np.repeat(np.array([n for n, _ in held], np.int64), [len(x) for _, x in held])
            yield from _packed(list(anchors_by.pack(h, pos % block == 0, text, pos // block)), buckets)
            held.clear()

        for b in batches:
            for name, data in zip(b.column("name").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = (data or b"").split()
                if len(words) >= window:
                    held.append((name, windows(words, block)))
                    total += len(words)
                    if total >= FLUSH:
                        yield from flush()
                        total = 0
        if held:
            yield from flush()

    anchors = _through(rows.mapInArrow(probe, "kind int, bucket int, grp int, data binary"), anchors_by)

    # The texts that have an anchor, by a filter of bounded size; all others are done.
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("data").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(data, "<i8", len(data) // 12)))], names=["name"])

    shared = spark.sparkContext.broadcast(build_filter(anchors.mapInArrow(names, "name long")))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = pa.array(filter_hits(shared.value, b.column("name").to_numpy()))
            b = b.filter(hit)
            yield b.append_column("grp", pa.array(b.column("name").to_numpy() % groups, pa.int32()))

    texts = rows.mapInArrow(some, f"id {kind}, text string, name long, grp int")

    # 2: which windows around the anchors stand elsewhere too
    windows_by = Exchange(buckets, groups, short=False)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        at = _places(right.column("data").to_pylist())
        out: list[tuple[int, int, bytes]] = []
        held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        total = 0

        def flush() -> None:
            h, more, pos = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
            text = np.repeat(np.array([x[0] for x in held], np.int64), [len(x[3]) for x in held])
            out.extend(windows_by.pack(h, np.ones(len(h), bool), text, pos, more))
            held.clear()

        for name, data in zip(left.column("name").to_pylist(), left.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if name in at:
                words = (data or b"").split()
                starts = near_anchors(len(words), at[name], block, window)
                held.append((name, windows(words, window)[starts], windows(words, window, SECOND)[starts], starts))
                total += len(starts)
                if total >= LOOK:
                    flush()
                    total = 0
        if held:
            flush()
        parts_ = list(_packed(out, buckets))
        give_back()
        return pa.Table.from_batches(parts_) if parts_ else pa.table({"kind": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "grp": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})

    found = texts.groupBy("grp").cogroup(anchors.groupBy("grp")).applyInArrow(look, "kind int, bucket int, grp int, data binary")
    starts = _through(found, windows_by)

    # 3: their words go
    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def result(ids, texts_: list[bytes], covers) -> dict:
        n, gone, sha, kept = [], [], [], []
        for data, starts_ in zip(texts_, covers, strict=True):
            words = (data or b"").split()
            left = words
            if starts_ is not None and len(starts_):
                out = cover(len(words), np.unique(starts_), window)
                left = [words[i] for i in np.flatnonzero(~out).tolist()]
            n.append(len(words))
            gone.append(len(words) - len(left))
            sha.append(_digest(left))
            if with_text:
                kept.append(b" ".join(left).decode())
        cols = {"id": ids, "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        return cols | ({"kept": pa.array(kept, pa.string())} if with_text else {})

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(~filter_hits(shared.value, b.column("name").to_numpy())))
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                data = part.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_pydict(result(part.column("id"), data, [None] * len(data)))

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        at = _places(right.column("data").to_pylist())
        data = left.column("text").cast(pa.binary()).to_pylist()
        return pa.table(result(left.column("id"), data, [at.get(x) for x in left.column("name").to_pylist()]))

    return rows.mapInArrow(done, schema).unionByName(texts.groupBy("grp").cogroup(starts.groupBy("grp")).applyInArrow(remove, schema))
