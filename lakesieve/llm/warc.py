"""WARC archives with an externally merged capture index.

Each task writes one archive of gzip members and the sorted run of its captures
(URL key, timestamp, id, place). The runs are dealt by ranges of the key, and
each range is merged from its slices of the k runs by a loser tree, which gives
globally ordered capture histories. The index then says where to read.

Defined results
---------------
null payload         empty; null url: the empty url; null date: the default one
null id              a capture like any other; never what a revisit refers to
equal payloads       of `least` bytes or more: the largest id is the response, others
                     revisit it; of repeated rows with that id one is the response
empty table          no archives, empty result
other columns        ignored
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import cut, new_path, parts, ship, size_mb

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: one site's captures stand together."""
    try:
        at = urlsplit(url.strip())
        host = (at.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (at.path or "/").lower() + (f"?{at.query.lower()}" if at.query else "")


class LoserTree:
    """Merges k sorted iterators: each step replays one leaf's path of log2(k) matches."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._replay(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """Whether a goes first; an exhausted run goes last, ties by the run's number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            held = self.losers[node]
            if held < 0:  # the first to come waits for its opponent
                self.losers[node] = winner
                return
            if self._beats(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while (head := self.heads[best := self.losers[0]]) is not None:
            yield head
            self.heads[best] = next(self.runs[best], None)
            self._replay(best)


def _record(kind: str, name: str, url: str, date: str, digest: str, payload: bytes, n: int, refers: str | None) -> bytes:
    block = HTTP % len(payload) + payload if kind == "response" else b""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Payload-Length", str(n))]
    if refers is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers}>")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else block


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000, date_col: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """id, url, date, payload, n, digest, kind, refers of every page; date_col: when it was captured, `date` where there is none."""
    when = F.coalesce(F.date_format(F.col(date_col), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(date)) if date_col else F.lit(date)
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), when.alias("date"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("n", F.length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    small = cut(p.select("id", "digest", "n").where(F.col("n") >= least), "digests")
    groups = cut(small.groupBy("digest", "n").agg(F.max("id").alias("refers"), F.count("*").alias("c")).where("c > 1").drop("c"), "payloads")
    # Where all is decided by small rows, the payloads move once and by their ids, so that no payload is a hot key.
    later = small.join(groups, ["digest", "n"]).select("id", "digest", "n", "refers").distinct()
    later = cut(later, "decided").select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("n").alias("_n"), "refers")
    rows = p.join(later, F.expr("id <=> _id and digest = _digest and n = _n"), "left")
    revisit = F.col("refers").isNotNull() & ~F.col("id").eqNullSafe(F.col("refers"))
    return rows.select("id", "url", "date", "payload", "n", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("refers")).alias("refers"))


def write_archives(decided: DataFrame, level: int = 1) -> DataFrame:
    """Writes one archive a task; returns the runs: key, date, id, path, offset, length, in each run's order."""
    spark = decided.sparkSession
    ship(spark)
    folder = new_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        path = f"{base}/{uuid.uuid4().hex}.warc.gz"  # each attempt's own: what a lost one left is in no index
        captures, out, offset = [], None, 0
        for b in batches:
            for name, url, date, payload, n, digest, kind, refers in zip(*[b.column(c).to_pylist() for c in ("id", "url", "date", "payload", "n", "digest", "kind", "refers")], strict=True):
                out = out or fs.open_output_stream(path, compression=None, buffer_size=1 << 20)
                packer = zlib.compressobj(level, wbits=31)
                data = packer.compress(_record(kind, "" if name is None else str(name), url, date, digest, payload, n, None if refers is None else str(refers))) + packer.flush()
                out.write(data)
                captures.append((url_key(url), date, name, offset, len(data)))
                offset += len(data)
        if out:
            out.close()
            captures.sort(key=lambda c: (c[0], c[1], c[2] is not None, c[2] or 0))
            uri = f"{folder}/{path.rsplit('/', 1)[1]}"
            for i in range(0, len(captures), 10_000):
                key, when, name, at, length = zip(*captures[i : i + 10_000], strict=True)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key), "date": pa.array(when), "id": pa.array(name, pa.int64()), "path": pa.array([uri] * len(key)), "offset": pa.array(at, pa.int64()), "length": pa.array(length, pa.int64())})

    return cut(decided.mapInArrow(run, "key string, date string, id long, path string, offset long, length long"), "runs")


def merge_index(runs: DataFrame) -> DataFrame:
    """The runs as one index, ordered by key, date and id over all partitions; also the range's number and the place in it."""
    n = parts(runs.sparkSession, size_mb(runs))
    order = [F.col("key"), F.col("date"), F.col("id").asc_nulls_first(), F.col("path"), F.col("offset")]
    dealt = runs.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[list[pa.RecordBatch]] = []
        before, part = None, 0
        for b in batches:
            rows, first = _captures(b), 0
            part = b.column("part")[0].as_py() if b.num_rows else part
            for i, row in enumerate(rows):
                # A run goes on while its archive is the same and nothing falls back: what was sorted is never sorted again.
                if before is None or row[4] != before[4] or row < before:
                    if runs and i > first:
                        runs[-1].append(b.slice(first, i - first))
                    runs.append([])
                    first = i
                before = row
            if runs and b.num_rows > first:
                runs[-1].append(b.slice(first))
        rows = []
        for k, row in enumerate(LoserTree([_walk(r) for r in runs])):
            rows.append((row[0], row[1], row[3] if row[2] else None, *row[4:], part, k))
            if len(rows) == 10_000:
                yield _index(rows)
                rows = []
        if rows:
            yield _index(rows)

    return dealt.mapInArrow(merge, "key string, date string, id long, path string, offset long, length long, part int, place long")


def _captures(b: pa.RecordBatch) -> list[tuple]:
    """A batch's captures as what they are ordered by: key, date, whether there is an id, the id, path, offset; and length."""
    columns = [b.column(c).to_pylist() for c in ("key", "date", "id", "path", "offset", "length")]
    return [(key, date, name is not None, name or 0, path, offset, length) for key, date, name, path, offset, length in zip(*columns, strict=True)]


def _walk(run: list[pa.RecordBatch], step: int = 64) -> Iterator[tuple]:
    """A run's captures, a few at a time: the rest stays packed."""
    for b in run:
        for i in range(0, b.num_rows, step):
            yield from _captures(b.slice(i, step))


def _index(rows: list[tuple]) -> pa.RecordBatch:
    key, date, name, path, offset, length, part, place = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"key": pa.array(key, pa.string()), "date": pa.array(date, pa.string()), "id": pa.array(name, pa.int64()), "path": pa.array(path, pa.string()), "offset": pa.array(offset, pa.int64()), "length": pa.array(length, pa.int64()), "part": pa.array(part, pa.int32()), "place": pa.array(place, pa.int64())})


def read_archives(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every capture of the index, from its archive: id, url, n, digest, kind, refers, part, place (and payload)."""
    rows = index.select("path", "offset", "length", "part", "place").repartition(parts(index.sparkSession), "path").sortWithinPartitions("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, f = None, None
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("id", "url", "n", "digest", "kind", "refers", "part", "place", "payload")}
            for path, offset, length, part, place in zip(*[b.column(c).to_pylist() for c in ("path", "offset", "length", "part", "place")], strict=True):
                if path != open_path:
                    if f:
                        f.close()
                    fs, at = pafs.FileSystem.from_uri(path)
                    f, open_path = fs.open_input_file(at), path
                fields, payload = parse_record(zlib.decompress(f.read_at(length, offset), wbits=31))
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                kind = fields["warc-type"]
                n = int(fields["payload-length"])
                if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {fields['warc-record-id']} in {path} is damaged")
                for k, v in (("id", _name(fields["warc-record-id"])), ("url", fields["warc-target-uri"]), ("n", n), ("digest", digest), ("kind", kind), ("refers", _name(fields.get("warc-refers-to", ""))), ("part", part), ("place", place), ("payload", payload if with_payload else None)):
                    out[k].append(v)
            types = {"id": pa.int64(), "url": pa.string(), "n": pa.int64(), "digest": pa.string(), "kind": pa.string(), "refers": pa.int64(), "part": pa.int32(), "place": pa.int64(), "payload": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items() if with_payload or k != "payload"})
        if f:
            f.close()

    return rows.mapInArrow(run, "id long, url string, n long, digest string, kind string, refers long, part int, place long" + ", payload binary" * with_payload)


def _name(uri: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri)
    return int(found[1]) if found else None


def read_file(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of an archive's bytes, without an index."""
    at = io.BytesIO(data).getbuffer()
    while len(at):
        d = zlib.decompressobj(wbits=31)
        record = d.decompress(at)
        yield parse_record(record)
        at = at[len(at) - len(d.unused_data) :]
