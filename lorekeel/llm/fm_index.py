"""An FM-index over integer symbols: suffix order, wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many positions of the text keep their place; a walk to the next of them takes fewer steps than that.
SAMPLED_EVERY = 32


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order, by doubling the symbols that are compared; the last symbol must be the least, and only there.

    A first sort takes as many symbols as fit in 62 bits; after it only groups that are not told apart go on.
    """
    n, bits = len(symbols), max(1, int(symbols.max(initial=0)).bit_length())
    told = max(1, 62 // bits)
    padded = np.concatenate([symbols, np.zeros(told, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(told):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key)
    rank, at = np.empty(n, np.int64), np.arange(n)
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    while True:
        # a suffix's rank is the first place of its group
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank[order[at]] = first
        alone = new & np.concatenate((new[1:], [True]))
        at = at[~alone]
        if not len(at):
            return order
        rest = order[at]
        key = rank[rest] * (n + 1) + rank[np.minimum(rest + told, n - 1)]
        by = np.argsort(key)
        order[at], key = rest[by], key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        told *= 2


class Bits:
    """A bit vector with rank, in words of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, inside = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << inside) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class FMIndex:
    """The index of one text of symbols; the text must end in its least symbol, which is nowhere else."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_order(symbols)
        self.n, count = len(symbols), np.bincount(symbols)
        self.first = np.concatenate(([0], np.cumsum(count)))  # of each symbol, the first row that starts with it
        bits = max(1, (len(count) - 1).bit_length())
        last = symbols[order - 1]
        self.levels, reverse = [], np.zeros(len(count), np.int64)
        for level in range(bits - 1, -1, -1):
            one = ((last >> level) & 1).astype(bool)
            self.levels.append((level, Bits(one), self.n - int(one.sum())))
            last = np.concatenate((last[~one], last[one]))
            reverse |= ((np.arange(len(count)) >> level) & 1) << (bits - 1 - level)
        # in the last level symbols lie in the order of their reversed bits
        by = np.argsort(reverse)
        start = np.empty(len(count), np.int64)
        start[by] = np.cumsum(count[by]) - count[by]
        self.shift = self.first[:-1] - start
        sampled = order % SAMPLED_EVERY == 0
        self.sampled, self.places = Bits(sampled), order[sampled]

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows that start with ``symbol`` and go on as one of the rows before ``at``, counted from the symbol's first row."""
        for level, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return self.shift[symbol] + at

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one symbol longer."""
        symbol = np.zeros(len(rows), np.int64)
        for level, bits, zeros in self.levels:
            one, ones = bits.get(rows), bits.rank(rows)
            symbol |= one.astype(np.int64) << level
            rows = np.where(one, zeros + ones, rows - ones)
        return self.shift[symbol] + rows

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the rows that start with each pattern, taken from its last symbol backward; negative symbols match nothing."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        fits = (lengths > 0) & (np.where(np.arange(patterns.shape[1]) < lengths[:, None], patterns, 0).min(axis=1, initial=0) >= 0)
        left = np.flatnonzero(fits)
        high[~fits] = 0
        for step in range(1, patterns.shape[1] + 1):
            left = left[(lengths[left] >= step) & (low[left] < high[left])]
            if not len(left):
                break
            symbol = patterns[left, lengths[left] - step]
            low[left], high[left] = self._down(symbol, low[left]), self._down(symbol, high[left])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of ``rows`` start: walks back to a row whose place is kept."""
        found, steps, left = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            kept = self.sampled.get(rows)
            found[left[kept]] = self.places[self.sampled.rank(rows[kept])] + steps
            left, rows, steps = left[~kept], self._back(rows[~kept]), steps + 1
        return found

    def occurrences(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, place) of every occurrence."""
        low, high = self.search(patterns, lengths)
        times = high - low
        which = np.repeat(np.arange(len(patterns)), times)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + low[which]
        return which, self.locate(rows)
