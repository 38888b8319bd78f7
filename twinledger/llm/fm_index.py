"""A full-text index over the words of one training shard: Burrows-Wheeler transform, wavelet matrix, sampled suffix positions."""

from __future__ import annotations

import numpy as np

# Every position divisible by this keeps its place in the text, as does the first word of each text.
SAMPLE = 16


def suffix_order(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Suffixes in order, by doubling. A text ends in a symbol that occurs once, so that no two suffixes are equal."""
    n, bits = len(symbols), max(1, int(n_symbols).bit_length())
    depth = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for step in range(depth):
        key <<= bits
        if step < n:
            key[: n - step] |= symbols[step:]
    order = np.argsort(key)
    rank, places, sorted_keys = np.empty(n, np.int64), np.arange(n), key[order]
    while True:
        new = np.empty(len(places), dtype=bool)
        new[:1], new[1:] = True, (sorted_keys[1:] != sorted_keys[:-1])
        rank[order[places]] = np.maximum.accumulate(np.where(new, places, 0))
        open_ = ~new | np.append(~new[1:], False)
        places = places[open_]
        if not len(places):
            return order
        # Suffixes that agree so far hold no end of a text so far, hence there is a symbol at this depth.
        suffixes = order[places]
        keys = (rank[suffixes] << 32) | rank[suffixes + depth]
        by_key = np.argsort(keys)
        order[places], sorted_keys = suffixes[by_key], keys[by_key]
        depth *= 2


class Bits:
    """A bit vector with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-len(bits) // 64) * 8 + 8, np.uint8)
        padded[: len(packed)] = packed
        self.blocks = padded.view(np.uint64)
        self.before = np.zeros(len(self.blocks), np.int64)
        np.cumsum(np.bitwise_count(self.blocks)[:-1], out=self.before[1:])

    def ones(self, places: np.ndarray) -> np.ndarray:
        block = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.blocks[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Counts of any symbol before any place of a sequence, and the symbol at a place, in as many steps as a symbol has bits."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        self.levels = list(range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1))
        self.bits, self.zeros = [], []
        for level in self.levels:
            bit = (sequence >> level) & 1 != 0
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - np.count_nonzero(bit)))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        self.base = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(self.levels, self.bits, self.zeros):
            ones = bits.ones(places)
            places = np.where((symbols >> level) & 1 != 0, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, places) - self.base[symbols]

    def symbol_and_rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbols = np.zeros(len(places), np.int64)
        for bits, zeros in zip(self.bits, self.zeros):
            bit, ones = bits.at(places), bits.ones(places)
            symbols = (symbols << 1) | bit
            places = np.where(bit, zeros + ones, places - ones)
        return symbols, places - self.base[symbols]


class FmIndex:
    """The words of some texts, found by phrases. Words are any 64-bit values; a phrase never reaches over the end of a text."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        texts = len(counts)
        self.vocabulary, found = np.unique(words, return_inverse=True)
        n = len(words) + texts
        ends = np.cumsum(counts) + np.arange(texts)
        self.starts = np.concatenate([[0], ends + 1]).astype(np.int64)
        symbols, is_end = np.zeros(n, np.int64), np.zeros(n, dtype=bool)
        is_end[ends] = True
        symbols[~is_end] = found + 1
        ordered = np.where(is_end, np.cumsum(is_end) - 1, symbols + texts - 1)
        order = suffix_order(ordered, texts + len(self.vocabulary))
        n_symbols = len(self.vocabulary) + 1
        self.wavelets = WaveletMatrix(symbols[order - 1], n_symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        # The ends of texts are one symbol, whose order of occurrence isn't that of suffixes; no walk crosses the first word of a text.
        is_first = np.zeros(n, dtype=bool)
        is_first[self.starts[:-1]] = True
        kept = (order % SAMPLE == 0) | is_first[order]
        self.kept, self.positions = Bits(kept), order[kept]

    def intervals(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases that occur, first and end row of the suffixes that begin with them); all phrases are of one length."""
        if not len(self.vocabulary):
            return (np.zeros(0, np.int64),) * 3
        place = np.minimum(np.searchsorted(self.vocabulary, phrases), len(self.vocabulary) - 1)
        alive = np.flatnonzero((self.vocabulary[place] == phrases).all(axis=1))
        first, end = np.zeros(len(alive), np.int64), np.full(len(alive), self.less[-1])
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = place[alive, column] + 1
            first, end = (self.less[symbols] + self.wavelets.rank(symbols, x) for x in (first, end))
            left = first < end
            alive, first, end = alive[left], first[left], end[left]
        return alive, first, end

    def positions_of(self, rows: np.ndarray) -> np.ndarray:
        """Places, ends of texts counted, of the suffixes in these rows: back to the next sampled position."""
        found, steps = np.empty(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.kept.at(rows)
            found[open_[here]] = self.positions[self.kept.ones(rows[here])] + steps
            open_, rows = open_[~here], rows[~here]
            symbols, before = self.wavelets.symbol_and_rank(rows)
            rows, steps = self.less[symbols] + before, steps + 1
        return found

    def occurrences(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, text, place among all words) of every occurrence."""
        alive, first, end = self.intervals(phrases)
        sizes = end - first
        rows = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        positions = self.positions_of(rows)
        text = np.searchsorted(self.starts, positions, side="right") - 1
        return np.repeat(alive, sizes), text, positions - text
