"""Elias-Fano coding of non-decreasing sequences, with select."""

from __future__ import annotations

import numpy as np

BLOCK = 64  # bytes of the high bits for each entry of the select directory


class EliasFano:
    """n values below a universe u in about n * (2 + log2(u / n)) bits.

    Low bits are packed; high bits are unary: bit (v >> low) + i is set for the
    i-th value v. select finds the i-th set bit by a directory of 32-bit counts,
    one for each BLOCK bytes, so no table of 64-bit offsets is held.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        pad = np.zeros(-(-max(1, len(high)) // BLOCK) * BLOCK, np.uint8)
        pad[: len(high)] = high
        ones = np.bitwise_count(pad).reshape(-1, BLOCK).sum(1)
        self.before = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        if (v[1:] < v[:-1]).any():
            raise ValueError("values must not decrease")
        low_bits = max(0, ((int(v[-1]) + 1) // n).bit_length() - 1)
        low = _pack(v, low_bits)
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) // 8 + 1, np.uint8)
        np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return cls(n, low_bits, low, high)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the i-th set bit of the high part."""
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        bits = np.flatnonzero(np.unpackbits(self.high[block * BLOCK : (block + 1) * BLOCK], bitorder="little"))
        return block * BLOCK * 8 + int(bits[i - int(self.before[block])])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        high = self.select(i) - i
        if not self.low_bits:
            return high
        first = i * self.low_bits
        part = self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes()
        return high << self.low_bits | int.from_bytes(part, "little") >> first % 8 & (1 << self.low_bits) - 1

    def all(self) -> np.ndarray:
        """Every value, as 64-bit numbers."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.n)
        return at.astype(np.uint64) << np.uint64(self.low_bits) | _unpack(self.low, self.low_bits, self.n)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence, and where its bytes end."""
        n, low_bits, a, b = (int(x) for x in np.frombuffer(data, "<u8", 4, at))
        at += 32
        return cls(n, low_bits, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a)), at + a + b


STEP = 1 << 16  # values packed at once; a multiple of 8, so that each step fills whole bytes


def _pack(v: np.ndarray, bits: int) -> np.ndarray:
    out = []
    for i in range(0, len(v) if bits else 0, STEP):
        raw = np.unpackbits(v[i : i + STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append(np.packbits(raw[:, :bits].ravel(), bitorder="little"))
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def _unpack(low: np.ndarray, bits: int, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    for i in range(0, n if bits else 0, STEP):
        m = min(STEP, n - i)
        raw = np.unpackbits(low[i * bits // 8 : -(-(i + m) * bits // 8)], bitorder="little")[: m * bits].reshape(m, bits)
        wide = np.zeros((m, 64), np.uint8)
        wide[:, :bits] = raw
        out[i : i + m] = np.packbits(wide, axis=1, bitorder="little").view("<u8").ravel()
    return out
