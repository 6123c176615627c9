"""Cutting texts where no pre-token of the GPT-2 pattern can cross.

The pattern's matches hold a space that is not their first character only inside
a run of white space. A boundary before a space is therefore safe if the
character before it is no white space, or if it is the run's last character and
text follows. Each piece can then be tokenised by itself, and equal pieces once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUN = re.compile(r"\s (?=\s|\Z)")
_SAFE = re.compile(r"(?<=\S)(?= )|(?<=\s)(?= \S)")
LONG = 256


def split_plainly(piece: str) -> list[str] | None:
    """The pattern's matches of a word, alone or with a comma or full stop behind it; None for all else."""
    word = piece[1:] if piece[:1] == " " else piece
    if word.isalpha():
        return [piece]
    if word[-1:] in (",", ".") and word[:-1].isalpha():
        return [piece[:-1], piece[-1]]
    return None


class PieceCache:
    """Token ids of texts; equal pieces are encoded once for as long as they are in use.

    encode(list of pieces) gives each piece's ids as bytes. At most 2 * limit values
    are held besides those of the texts at hand; pieces over LONG characters are
    never held.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], width: np.dtype, limit: int = 300_000):
        self.encode, self.width, self.limit = encode, np.dtype(width), limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, which are distinct."""
        new, old = self.new, self.old
        out = list(map(new.get, pieces))
        missing = []
        for i, value in enumerate(out):
            if value is None:
                if (value := old.get(pieces[i])) is None:
                    missing.append(i)
                else:
                    new[pieces[i]] = out[i] = value
        for i, value in zip(missing, self.encode([pieces[i] for i in missing]), strict=True):
            out[i] = value
            if len(pieces[i]) <= LONG:
                new[pieces[i]] = value
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return out

    def ids(self, texts: list[str], given: dict[int, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, joined, bounds: text k's are those from bounds[k] to bounds[k + 1]).

        given has ids of texts, by their places, that aren't to be cut.
        """
        if not texts:
            return np.zeros(0, self.width), np.zeros(1, np.int64)
        # What a text begins with is told apart from words behind a space; texts with runs of white space are all beginning.
        heads, plain = [], []
        for k, text in enumerate(texts):
            if given and k in given:
                heads.append([])
                plain.append("")
            elif _RUN.search(text):
                heads.append([p for p in _SAFE.split(text) if p])
                plain.append("")
            else:
                head = text.partition(" ")[0]
                heads.append([head] if head else [])
                plain.append(text)
        known = sorted({p for h in heads for p in h})
        first = dict(zip(known, self.values(known), strict=True))
        begin = [given[k] if given and k in given else b"".join([first[p] for p in h]) for k, h in enumerate(heads)]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        words = split.values.dictionary_encode()
        at = split.offsets.to_numpy()
        codes = words.indices.to_numpy().astype(np.int64)
        rest = np.ones(len(codes), bool)
        rest[at[:-1]] = False
        used = np.flatnonzero(np.bincount(codes[rest], minlength=len(words.dictionary)))
        some = words.dictionary.take(pa.array(used))
        # to_numpy makes Python strings many times faster than to_pylist
        behind = pc.binary_join_element_wise(pa.scalar("", some.type), some, pa.scalar(" ", some.type)).to_numpy(zero_copy_only=False).tolist()
        place = np.zeros(len(words.dictionary), np.int64)
        place[used] = np.arange(len(used))
        codes = place[codes]
        codes[at[:-1]] = len(behind) + np.arange(len(texts))
        values = self.values(behind) + begin
        flat = np.frombuffer(b"".join(values), self.width)
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // self.width.itemsize
        starts = np.cumsum(lengths) - lengths
        n = lengths[codes]
        ends = np.cumsum(n)
        shift = np.repeat(starts[codes] - (ends - n), n)
        return flat[shift + np.arange(len(shift))], np.concatenate([[0], ends[at[1:] - 1]])


def by_volume(items: list, sizes: Iterable[int], most: int = 1 << 21) -> Iterator[list]:
    """Runs of items of at most `most` in all, or of one item."""
    run: list = []
    total = 0
    for item, n in zip(items, sizes, strict=True):
        if run and total + n > most:
            yield run
            run, total = [], 0
        run.append(item)
        total += n
    if run:
        yield run
