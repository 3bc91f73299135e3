"""Elias-Fano encoding of a non-decreasing sequence.

With ``n`` values up to ``u`` each value keeps its low ``log2(u / n)`` bits;
the high parts are a bit string with a one per value, after as many zeros as
the high part says: about ``2 + log2(u / n)`` bits a value. The place of
every 64th one is kept, and a value is found by counting ones from there.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QQBQ")  # values, largest value, low bits, bits of the high part
SAMPLE = 64


def _words(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(bits) // 64) * 64 + 64, dtype=np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view("<u8")


class EliasFano:
    def __init__(self, n: int, largest: int, low_bits: int, high_bits: int, low, high, samples):
        self.n, self.largest, self.low_bits, self.high_bits = n, largest, low_bits, high_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        largest = int(values[-1]) if n else 0
        low_bits = max(0, (largest // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, largest, low_bits, len(high), _words(low), _words(high), ones[::SAMPLE].astype("<u4" if len(high) < 1 << 32 else "<u8"))

    def to_bytes(self) -> bytes:
        return HEAD.pack(self.n, self.largest, self.low_bits, self.high_bits) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_buffer(cls, data: memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at a place, and the place after it."""
        n, largest, low_bits, high_bits = HEAD.unpack_from(data, at)
        at += HEAD.size
        parts = []
        for count, kind in (
            (-(-n * low_bits // 64) + 1, "<u8"), (-(-high_bits // 64) + 1, "<u8"),
            (-(-n // SAMPLE), "<u4" if high_bits < 1 << 32 else "<u8"),
        ):
            parts.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        return cls(n, largest, low_bits, high_bits, *parts), at

    def _select(self, i: np.ndarray) -> np.ndarray:
        """Places of the ones with numbers ``i`` in the high part."""
        place = self.samples[i // SAMPLE].astype(np.int64)
        word, left = place >> 6, (i % SAMPLE).astype(np.int64)
        bits = self.high[word] & (~np.uint64(0) << (place & 63).astype(np.uint64))
        while True:
            ones = np.bitwise_count(bits).astype(np.int64)
            on = np.flatnonzero(left >= ones)
            if not len(on):
                break
            left[on] -= ones[on]
            word[on] += 1
            bits[on] = self.high[word[on]]
        spread = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return (word << 6) + (np.cumsum(spread, axis=1, dtype=np.uint8) == (left + 1)[:, None]).argmax(axis=1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values with numbers ``i`` (at most 2^16 of them at a time are
        unpacked)."""
        i = np.atleast_1d(np.asarray(i, dtype=np.int64))
        out = np.empty(len(i), dtype=np.uint64)
        for a in range(0, len(i), 1 << 16):
            k = i[a : a + (1 << 16)]
            high = (self._select(k) - k).astype(np.uint64)
            first = k * self.low_bits
            word, off = first >> 6, (first & 63).astype(np.uint64)
            low = self.low[word] >> off
            over = np.flatnonzero(off)
            low[over] |= self.low[np.minimum(word[over] + 1, len(self.low) - 1)] << (np.uint64(64) - off[over])
            low &= (np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1)
            out[a : a + (1 << 16)] = high << np.uint64(self.low_bits) | low
        return out
