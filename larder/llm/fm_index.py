"""A compressed full-text index over integer symbols: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np

U = np.uint64


class Bits:
    """A bit vector with rank: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, U)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word = i >> 6
        mask = (U(1) << (i & 63).astype(U)) - U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(bits)):
            bit = (values >> shift) & 1 == 1
            zeros = len(bit) - int(bit.sum())
            self.levels.append((shift, Bits(bit), zeros))
            values = np.concatenate([values[~bit], values[bit]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i goes when the values are sorted by symbol as far as its own symbol tells."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> shift) & 1 == 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols; suffixes are sorted by so many.

    Symbols are at least 1; 0 separates texts and ends the sequence.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        symbols = np.asarray(symbols, np.int64)
        if not len(symbols) or symbols[-1]:
            symbols = np.append(symbols, 0)
        self.depth = depth
        self.suffixes = sorted_suffixes(symbols, depth)
        self.top = int(symbols.max())
        counts = np.bincount(symbols, minlength=self.top + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        last = symbols[self.suffixes - 1]
        self.wavelet = WaveletMatrix(last, max(1, self.top.bit_length()))
        every = np.arange(self.top + 1)
        self.origin = self.wavelet.place(every, np.zeros_like(every))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol at the left."""
        shift = self.first[symbol] - self.origin[symbol]
        return shift + self.wavelet.place(symbol, low), shift + self.wavelet.place(symbol, high)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, least: int = 1):
        """How many symbols up to each of ``ends`` in ``text`` occur at least ``least`` times, up to ``depth``.

        Also the intervals of suffixes that begin with those symbols. Symbols unknown to the index are to be -1.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.suffixes), np.int64)
        active = np.arange(len(ends))
        for step in range(self.depth):
            at = ends[active] - step
            active, at = active[at >= 0], at[at >= 0]
            symbol = text[at]
            known = (symbol > 0) & (symbol <= self.top)
            active, symbol = active[known], symbol[known]
            if not len(active):
                break
            a, b = (self.first[symbol], self.first[symbol + 1]) if step == 0 else self.extend(symbol, low[active], high[active])
            more = b - a >= least
            active, a, b = active[more], a[more], b[more]
            low[active], high[active], length[active] = a, b, step + 1
        return length, low, high


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the suffixes, by their first ``depth`` symbols at least; doubling of prefixes."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    reach = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - reach] = rank[reach:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        reach *= 2
        if reach >= depth:
            return order
        new = np.empty(n, np.int64)
        new[0] = 0
        np.cumsum(key[order[1:]] != key[order[:-1]], out=new[1:])
        rank = np.empty(n, np.int64)
        rank[order] = new
