"""Hashes of word windows over whole texts."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
SECOND = 0xD1342543DE82EF95
"""Two bases: hashes under both tell windows apart by 128 bits."""
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = 1 << 17  # words hashed at once, which bounds the memory for very long texts
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = 1 << max(16, (n - 1).bit_length())
        held = np.full(size, base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        _powers[base] = held
    return held[:n]


def windows(words: list[bytes], k: int, base: int = BASE) -> np.ndarray:
    """64-bit hash of each run of k words; of fewer words than k, none."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out = [_windows(words[i : i + STEP + k - 1], k, base) for i in range(0, len(words) - k + 1, STEP)]
    return out[0] if len(out) == 1 else np.concatenate(out)


def _windows(words: list[bytes], k: int, base: int) -> np.ndarray:
    # The words joined by spaces; a window's hash is that of its bytes, from sums of byte * base^place.
    data = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * _power(base, len(data)), out=total[1:])
    a, b = starts[: len(words) - k + 1], ends[k - 1 :]
    return mix((total[b] - total[a]) * _power(pow(base, -1, 1 << 64), len(data) + 1)[a] + (b - a).astype(np.uint64))


def shingle_set(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles; of fewer words, of the whole sequence; of none, empty."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(windows(words, min(k, len(words))))
