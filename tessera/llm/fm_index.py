"""FM-index over a sequence of word numbers, in numpy, for many phrases at
a time.

The text is a row of runs with the separator 0 after each; separators count
as different from each other, so suffixes are compared up to the end of
their run only. ``Wavelet`` answers rank queries on the Burrows-Wheeler
transform; the sampled suffix positions are every ``rate``-th and the first
of each run.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits with rank: ones before a position, from block counts and the
    population count of one word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.ones = int(self.before[-1])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        block, off = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[block] & ((np.uint64(1) << off) - np.uint64(1))
        return self.before[block] + np.bitwise_count(below).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class Wavelet:
    """Wavelet matrix: symbols by bits, highest first; each level puts zeros
    before ones and keeps their order."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitRank, int]] = []
        for shift in range(self.depth - 1, -1, -1):
            ones = (seq >> shift & 1).astype(bool)
            bits = BitRank(ones)
            self.levels.append((bits, len(seq) - bits.ones))
            seq = np.concatenate([seq[~ones], seq[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``."""
        lo = np.zeros_like(at)
        for level, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - level) & 1).astype(bool)
            lo1, at1 = bits.rank1(lo), bits.rank1(at)
            lo = np.where(one, zeros + lo1, lo - lo1)
            at = np.where(one, zeros + at1, at - at1)
        return at - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bits, zeros in self.levels:
            one = bits.get(at)
            ones = bits.rank1(at)
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by doubling the compared length until all
    ranks differ. Each 0 of ``text`` is a symbol of its own, smaller than
    all others and ordered by position."""
    n = len(text)
    separators = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    _, rank = np.unique(rank, return_inverse=True)
    step = 1
    while True:
        key = rank.astype(np.int64) * (n + 1)
        if step < n:
            key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        in_order = key[order]
        new[order] = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int, rate: int = 16):
        """``text``: numbers under ``sigma``, 0 only after the end of a run,
        with a 0 at the end."""
        self.n = len(text)
        order = suffix_array(text)
        before = text[order - 1]  # position 0 is preceded by the last separator
        self.wavelet = Wavelet(before, sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        sampled = (order % rate == 0) | (before == 0)
        self.sampled = BitRank(sampled)
        self.samples = order[sampled]

    def _last_to_first(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.wavelet.rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals ``[lo, hi)`` of the suffixes that begin with each
        phrase (rows of ``phrases``, right-aligned)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for back in range(width):
            live = np.flatnonzero((lengths > back) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - back]
            lo[live], hi[live] = self._last_to_first(symbol, lo[live]), self._last_to_first(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        live, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(live):
            known = self.sampled.get(row)
            out[live[known]] = self.samples[self.sampled.rank1(row[known])] + steps
            live, row = live[~known], row[~known]
            if len(live):
                row = self._last_to_first(self.wavelet.access(row), row)
            steps += 1
        return out
