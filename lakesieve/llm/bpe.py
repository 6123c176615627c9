"""Byte-level BPE by prefix dynamic programming.

For every prefix of a pre-token there is exactly one last token with which a
valid encoding of the prefix can end: the one that is compatible with the last
token of the prefix before it. Two neighbours are compatible if merging their
bytes by rank gives them back, which undoing their own merges tells. The table
of these last tokens is all there is to store: appending bytes extends it, an
edit recomputes it from the place of the edit until it falls in step again, and
walking it backwards gives the encoding.

Defined results
---------------
null or empty text   no tokens
very long texts      linear in the text; nothing is cut off
repeated rows        one output row per input row
empty table          empty result
other columns        ignored
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import give_back, ship, some_rows
from lakesieve.llm.pieces import PieceCache, by_volume, split_plainly


CACHE = 150_000  # pre-tokens that are held with their ids; four times as many pairs of neighbours
LEAN = 30_000  # likewise, where little memory is left


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixBPE:
    """Encodes single pre-tokens by their prefixes' last tokens.

    An automaton over the beginnings of tokens tells which tokens a prefix ends
    with: its state is the prefix's longest end that some token begins with.
    """

    def __init__(self, ranks: dict[bytes, int], pairs: int = 4 * CACHE):
        self.ranks, self.pairs = ranks, pairs
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._begin = {t[:n] for t in ranks for n in range(len(t) + 1)}
        self._state: dict[bytes, int] = {b"": 0}  # numbers of the states that were met
        self._bytes: list[bytes] = [b""]
        self._ends: list[tuple[tuple[int, int], ...]] = [()]  # lengths and ids of the tokens that a state ends with, longest first
        self._next: dict[int, int] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._sound: dict[int, bool] = {}  # tokens that their own bytes are encoded as: whether by merges of rising rank
        self._pair: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Merging by rank, for the few bytes of one or two tokens."""
        return self._merge(data, 1)

    def _merge(self, data: bytes, least: int) -> list[int]:
        """Merging by rank until so few tokens are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            best, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def alone(self, token: int) -> bool:
        """Whether the token's bytes are encoded as this token."""
        if token in self._sound:
            return True
        data = self.bytes_of[token]
        if len(data) == 1:
            self._split[token], self._sound[token] = None, True
            return True
        halves = self._merge(data, 2)
        if len(halves) > 2:
            return False
        a, b = halves  # encoded as themselves, too
        self._split[token] = a, b
        rising = all(self.alone(x) and self._sound[x] and (x < token or self._split[x] is None) for x in halves)
        self._sound[token] = rising
        return True

    def follows(self, a: int, b: int) -> bool:
        """Whether b, a token that its bytes are encoded as, can stand after such an a."""
        if len(self._pair) > self.pairs:
            self._pair.clear()
        ok = self._pair[a << 32 | b] = self.fits(a, b)
        return ok

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b by rank gives them back.

        Their merges are undone, the last one first: no two tokens that meet
        between a and b may merge before one of them becomes part of another.
        """
        if not (self._sound[a] and self._sound[b]):
            return self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        ranks, bytes_of, split = self.ranks, self.bytes_of, self._split
        until = 1 << 60
        while ranks.get(bytes_of[a] + bytes_of[b], until) >= until:
            left, right = split[a], split[b]
            if left and (a > b or not right):
                a, until = left[1], a
            elif right:  # of equal merges the left one comes first, so that the right one is undone first
                b, until = right[0], b + 1
            else:
                return True
        return False

    def _step(self, state: int, byte: int) -> int:
        """The state behind one more byte."""
        data = self._bytes[state] + bytes((byte,))
        while data not in self._begin:
            data = data[1:]
        to = self._state.get(data)
        if to is None:
            to = self._state[data] = len(self._bytes)
            self._bytes.append(data)
            found = ((n, self.ranks.get(data[-n:])) for n in range(len(data), 0, -1))
            self._ends.append(tuple((n, t) for n, t in found if t is not None and self.alone(t)))
        if len(self._next) > self.pairs:
            self._next.clear()
        self._next[state << 8 | byte] = to
        return to

    def start(self, data: bytes, end: int) -> int:
        """The state behind data[:end]."""
        state = 0
        for byte in data[max(0, end - self.longest) : end]:
            state = self._step(state, byte)
        return state

    def table(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """last[i]: the last token of data[:i]; last[0] is unused. Given a table of a prefix, extends it."""
        last = last or [-1]
        self.extend(data, len(data), last, [self.start(data, len(last) - 1)])
        return last

    def extend(self, data: bytes, to: int, last: list[int], states: list[int]) -> None:
        """Carries the table of a prefix, and the automaton's states (the last one at least), on to data[:to]."""
        step, ends, pair = self._next, self._ends, self._pair
        state = states[-1]
        for end in range(len(last), to + 1):
            byte = data[end - 1]
            then = step.get(state << 8 | byte)
            state = self._step(state, byte) if then is None else then
            states.append(state)
            for n, token in ends[state]:
                if n == end:
                    break
                before = last[end - n]
                ok = pair.get(before << 32 | token)
                if ok or ok is None and self.follows(before, token):
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")
            last.append(token)

    def walk(self, last: list[int]) -> list[int]:
        out, at = [], len(last) - 1
        while at > 0:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one pre-token. A pre-token that is a token as a whole is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.walk(self.table(data))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Editable:
    """The encoding of one pre-token under appends and edits."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.table(data)

    def ids(self) -> list[int]:
        whole = self.bpe.ranks.get(self.data)
        return [whole] if whole is not None else self.bpe.walk(self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.table(self.data, self.last)

    def edit(self, at: int, remove: int, insert: bytes) -> int:
        """Replace bytes; returns how many entries of the table were computed anew."""
        old, shift = self.last, len(insert) - remove
        self.data = self.data[:at] + insert + self.data[at + remove :]
        last, states = old[: at + 1], [self.bpe.start(self.data, at)]
        same = 0
        for end in range(at + 1, len(self.data) + 1):
            self.bpe.extend(self.data, end, last, states)
            # in step again: all that later entries can look back on is as it was
            same = same + 1 if end > at + len(insert) and last[end] == old[end - shift] else 0
            if same >= self.bpe.longest and end - self.bpe.longest >= at + len(insert):
                self.last = last + old[end - shift + 1 :]
                return end - at
        self.last = last
        return len(last) - at - 1


class TextEncoder:
    """Whole texts: pre-tokens by the pattern, equal pieces encoded once.

    New pre-tokens are taken in alphabetical order, so that each one's table goes
    on from the beginning that it shares with the one before.
    """

    def __init__(self, path: str, pattern: str, limit: int = CACHE):
        self.bpe = PrefixBPE(load_ranks(path), 4 * limit)
        self.pattern = regex.compile(pattern)
        self.width = np.dtype("<u2" if max(self.bpe.bytes_of) < 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.decimal = {i: str(i).encode() for i in self.bpe.bytes_of}
        self.limit = limit
        self.tokens: dict[str, bytes] = {}
        self.pieces = PieceCache(self._pieces, self.width, limit // 3)

    def _pieces(self, pieces: list[str]) -> Iterator[bytes]:
        found = [split_plainly(p) or self.pattern.findall(p) for p in pieces]
        held = self.tokens
        if len(held) > self.limit:
            held.clear()
        ranks, extend, walk = self.bpe.ranks, self.bpe.extend, self.bpe.walk
        before, last, states = b"", [-1], [0]
        long: list[str] = []
        for token in sorted({t for f in found for t in f} - held.keys()):
            data = token.encode()
            whole = ranks.get(data)
            if whole is None:
                same = 0
                for a, b in zip(before, data, strict=False):
                    if a != b:
                        break
                    same += 1
                del last[same + 1 :], states[same + 1 :]
                extend(data, len(data), last, states)
                before = data
                ids = walk(last)
            else:
                ids = [whole]
            held[token] = array(self.code, ids).tobytes()
            if len(token) > 64:
                long.append(token)
        for f in found:
            yield held[f[0]] if len(f) == 1 else b"".join([held[t] for t in f])
        for token in long:
            del held[token]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        flat, bounds = self.pieces.ids(texts)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield flat[a:b]

    def joined(self, ids: list[int]) -> bytes:
        """Decimal ids, joined by commas."""
        return b",".join(map(self.decimal.__getitem__, ids))


@lru_cache(2)
def encoder(path: str, pattern: str, limit: int = CACHE) -> TextEncoder:
    return TextEncoder(path, pattern, limit)


def _place(vocabulary: str) -> str:
    """A vocabulary's path: as given, or by its name in the installed package of public ones."""
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, digests: bool = False, lean: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids (array), or digests of the ids and of what they decode to.

    lean: the same ids with less memory and more time, for jobs whose tasks have done other work before.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(_place(vocabulary), pattern, LEAN if lean else CACHE)
        for b in some_rows(batches):
            strings = [x or "" for x in b.column("text").to_pylist()]
            rows = by_volume(list(range(len(strings))), map(len, strings))
            for run in rows:
                n, ids, sha_ids, sha_text = [], [], [], []
                for got in enc.encode([strings[i] for i in run]):
                    n.append(len(got))
                    if with_ids:
                        ids.append(got.astype(np.int32))
                    if digests:
                        listed = got.tolist()
                        sha_ids.append(hashlib.sha256(enc.joined(listed)).hexdigest())
                        sha_text.append(hashlib.sha256(enc.bpe.decode(listed)).hexdigest())
                cols = {"id": b.column("id").slice(run[0], len(run)), "n_tokens": pa.array(n, pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
                if digests:
                    cols |= {"ids_sha256": pa.array(sha_ids, pa.string()), "decoded_sha256": pa.array(sha_text, pa.string())}
                yield pa.RecordBatch.from_pydict(cols)
            if lean:
                give_back()

    schema = f"id {kind}, n_tokens long" + ", ids array<int>" * with_ids + ", ids_sha256 string, decoded_sha256 string" * digests
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """id, data (binary): the bytes that the ids stand for; null ids give no bytes."""
    ship(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(_place(vocabulary), pattern).bpe
        for b in batches:
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "data": pa.array([bpe.decode(x or []) for x in b.column("ids").to_pylist()], pa.binary())})

    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, data binary")
