"""An FM-index over a sequence of integer symbols: wavelet matrix, sampled suffix positions.

Symbol 0 separates. No pattern holds it, and every separator is taken as a letter of
its own, so comparing two suffixes ends at the next separator at the latest.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A packed bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        size = (len(bits) // 64 + 1) * 64
        padded = np.zeros(size, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The number of ones before each place."""
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE != 0


class WaveletMatrix:
    """Rank of any symbol, and access, in as many steps as a symbol has bits."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            bits = (symbols >> shift) & 1 == 1
            zeros = symbols[~bits]
            self.levels.append((shift, Bits(bits), len(zeros)))
            symbols = np.concatenate([zeros, symbols[bits]])
        every = np.arange(largest + 1)
        self.first = self._descend(every, np.zeros(len(every), np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._descend(symbol, at) - self.first[symbol]

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions by their suffixes. The last symbol must be a separator.

    Prefix doubling; each round sorts only the suffixes that are still tied.
    """
    size, cut = len(symbols), symbols == 0
    key = np.where(cut, np.cumsum(cut) - 1, np.count_nonzero(cut) + symbols)
    order = np.argsort(key, kind="stable")
    slots, pos, key = np.arange(size), order, key[order]
    rank, step = np.empty(size, np.int64), 1
    while True:
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        order[slots] = pos
        rank[pos] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        slots, pos = slots[~alone], pos[~alone]
        if not len(slots):
            return order
        key = rank[pos] * size + rank[pos + step]
        by = np.argsort(key, kind="stable")
        pos, key, step = pos[by], key[by], 2 * step


class FmIndex:
    """Counts and places of patterns in ``symbols``, which ends with a separator."""

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8):
        symbols = np.asarray(symbols, np.int64)
        order = suffix_order(symbols)
        before = np.concatenate([[0], symbols[:-1]])
        counts = np.bincount(symbols, minlength=largest + 1)
        self.less = np.cumsum(counts) - counts
        self.size = len(symbols)
        self.last = WaveletMatrix(before[order], largest)
        # the start of every run is kept as well, so no walk steps over a separator
        keep = (order % sample == 0) | (before[order] == 0)
        self.kept, self.samples = Bits(keep), order[keep]

    def search(self, patterns: np.ndarray, lengths: np.ndarray):
        """Row ranges of all patterns at once (right-aligned, padded in front)."""
        count, width = patterns.shape
        low, high = np.zeros(count, np.int64), np.full(count, self.size, np.int64)
        low[lengths == 0] = high[lengths == 0] = 0
        live = np.flatnonzero(lengths > 0)
        for back in range(1, width + 1):
            live = live[(lengths[live] >= back) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, width - back]
            ends = np.concatenate([low[live], high[live]])
            ends = self.last.rank(np.concatenate([symbol, symbol]), ends)
            low[live] = self.less[symbol] + ends[: len(live)]
            high[live] = self.less[symbol] + ends[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row: step back until one is sampled."""
        found, at = np.empty(len(rows), np.int64), rows.astype(np.int64)
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            known = self.kept.get(at)
            found[walking[known]] = self.samples[self.kept.rank(at[known])] + steps
            walking, at = walking[~known], at[~known]
            symbol, rank = self.last.get(at)
            at, steps = self.less[symbol] + rank, steps + 1
        return found
