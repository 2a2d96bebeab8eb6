"""An FM-index over a sequence of symbols, in numpy: suffix array, wavelet tree, sampled positions."""

import numpy as np

SAMPLE_EVERY = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of ``symbols`` in the order of the suffixes that start there. The last symbol is the only smallest one."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = _ranks(symbols[order], order)
    width = 1
    while rank[order[-1]] < n - 1:
        behind = np.zeros(n, np.int64)
        behind[:-width] = rank[width:] + 1
        key = rank * (n + 1) + behind
        # Only suffixes that share their rank with another have to be sorted again.
        times = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(times[rank[order]] > 1)
        some = order[open_]
        order[open_] = some[np.argsort(key[some], kind="stable")]
        rank = _ranks(key[order], order)
        width *= 2
    return order


def _ranks(sorted_keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(sorted_keys[1:] != sorted_keys[:-1])))
    return rank


class Bits:
    """A sequence of bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def ones(self, i: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)


class WaveletTree:
    """A wavelet tree stored level by level, from the highest bit of the symbols to the lowest.

    On each level the zeros of the level above come first, so a node is a range of places that the ranks lead to.
    """

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[int, int, Bits]] = []
        for bit in range(int(symbols.max()).bit_length() - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            zeros = len(symbols) - int(ones.sum())
            self.levels.append((bit, zeros, Bits(ones)))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i of the sequence is after the last level, following ``symbol``."""
        for bit, zeros, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> bit) & 1 == 1, zeros + ones, i - ones)
        return i

    def symbol_and_place(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i, and where it is after the last level."""
        symbol = np.zeros(len(i), np.int64)
        for bit, zeros, bits in self.levels:
            one, ones = bits.get(i), bits.ones(i)
            symbol += one.astype(np.int64) << bit
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i


class FMIndex:
    """Counts and locates patterns in ``symbols`` (numbers from 1)."""

    def __init__(self, symbols: np.ndarray):
        text = np.append(symbols.astype(np.int64), 0)
        order = suffix_array(text)
        self.size = len(text)
        last = text[order - 1]
        self.tree = WaveletTree(last)
        counts = np.bincount(text)
        first = np.concatenate(([0], np.cumsum(counts)))[:-1]  # of the suffixes that start with a symbol
        start = self.tree.place(np.arange(len(counts)), np.zeros(len(counts), np.int64))
        self.shift = first - start
        sampled = order % SAMPLE_EVERY == 0
        self.sampled = Bits(sampled)
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that start with each pattern, from its last symbol to its first.

        ``patterns``: a row for each, right-aligned. Rows with a symbol that the text does not have get an empty range.
        """
        n, width = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, self.size, np.int64)
        known = len(self.shift)
        for step in range(width):
            at = np.flatnonzero((lengths > step) & (low < high))
            if not len(at):
                break
            symbol = patterns[at, width - 1 - step]
            there = (symbol > 0) & (symbol < known)
            high[at[~there]] = low[at[~there]]
            at, symbol = at[there], symbol[there]
            low[at] = self.shift[symbol] + self.tree.place(symbol, low[at])
            high[at] = self.shift[symbol] + self.tree.place(symbol, high[at])
        return low, np.maximum(low, high)

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of these ranks start: steps back to the next sampled one."""
        found = np.full(len(suffixes), -1, np.int64)
        at, i, steps = np.arange(len(suffixes)), suffixes.astype(np.int64), 0
        while len(at):
            here = self.sampled.get(i)
            found[at[here]] = self.positions[self.sampled.ones(i[here])] + steps
            at, i = at[~here], i[~here]
            if len(at):
                symbol, place = self.tree.symbol_and_place(i)
                i = self.shift[symbol] + place
                steps += 1
        return found
