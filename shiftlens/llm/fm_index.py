"""A compressed FM-index over a collection of word sequences, and matching statistics by backward search.

The Burrows-Wheeler transform of the collection is held as a wavelet tree, level by level in packed bits with counts,
so a rank costs one look-up a level. Backward search extends a match by the word to its left. Where the extension has
no occurrence, the match loses words on its right until it has one: its interval widens to that of its parent, by the
common prefixes of neighbouring suffixes. All streamed sequences take a step at once.
"""

from __future__ import annotations

import numpy as np

from shiftlens.llm.suffix_array import permuted_lcp


class Bits:
    """Packed bits with the count of ones before each 64 of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        upto = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & upto)


class WaveletTree:
    """Symbols by their bits, the highest first; at each level zeros stand before ones in the order of the level above."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        for bit in reversed(range(max(1, (sigma - 1).bit_length()))):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(sigma)
        self.starts = self._place(every, np.zeros(sigma, np.int64))

    def _place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            before = ones.ones(at)
            at = np.where(symbols >> bit & 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._place(symbols, at) - self.starts[symbols]


class Minima:
    """Minima of any range, from those of all ranges whose size is a power of two."""

    def __init__(self, values: np.ndarray):
        n, span, self.table = len(values), 1, [values]
        while 2 * span <= n:
            last, row = self.table[-1], np.full(n, np.iinfo(values.dtype).min, values.dtype)
            row[: n - 2 * span + 1] = np.minimum(last[: n - 2 * span + 1], last[span : n - span + 1])
            self.table.append(row)
            span *= 2
        self.table = np.stack(self.table)

    def between(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        level = np.frexp((after - first).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, first], self.table[level, after - (1 << level)])

    def widened(self, first: np.ndarray, after: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges grown while the value at ``first`` and those before it, and the value at ``after`` and those behind it, reach ``least``."""
        first, after, n = first.copy(), after.copy(), self.table.shape[1]
        for level in reversed(range(len(self.table))):
            span = 1 << level
            at = first - span + 1
            first[(at > 0) & (self.table[level, np.maximum(at, 0)] >= least)] -= span
            fits = after + span <= n
            after[fits & (self.table[level, np.where(fits, after, 0)] >= least)] += span
        return first, after


def sorted_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the length that decides; no two suffixes may be equal."""
    n, length = len(symbols), 1
    rank = symbols.astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[: n - length] = rank[length:] + 1
        keys = rank * (n + 1) + following
        order = np.argsort(keys)
        names = np.cumsum(np.r_[0, np.diff(keys[order]) != 0])
        if names[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = names
        length *= 2


class FMIndex:
    """Sequences of words, each owned by a document; matches count up to ``longest`` words."""

    def __init__(self, sequences: list[list], owners: np.ndarray, longest: int):
        self.longest, self.words = longest, {}
        name = self.words
        coded = [[name.setdefault(word, len(name) + 1) for word in words] for words in sequences]
        sizes = np.array([len(words) + 1 for words in sequences])
        ends = np.cumsum(sizes) - 1
        text = np.zeros(int(sizes.sum()), np.int64)  # 0 ends a sequence
        is_word = np.ones(len(text), bool)
        is_word[ends] = False
        text[is_word] = np.fromiter((code for codes in coded for code in codes), np.int64, int(is_word.sum()))
        self.sequences = [np.array(codes, np.int64) for codes in coded]
        told_apart = text + len(sequences) - 1
        told_apart[ends] = np.arange(len(sequences))
        order = sorted_suffixes(told_apart)
        sigma = len(name) + 1
        self.tree = WaveletTree(text[order - 1], sigma)
        self.smaller = np.cumsum(np.bincount(text, minlength=sigma)) - np.bincount(text, minlength=sigma)
        common = permuted_lcp(told_apart, order)[0][order]
        self.size = len(text)
        self.common = np.append(common, -1).astype(np.int32)
        self.common[0] = -1
        self.shared = Minima(self.common[:-1])
        self.owner = Minima(np.repeat(owners, sizes)[order])
        cuts = np.flatnonzero(self.common < longest)
        group = np.searchsorted(cuts, np.arange(self.size), "right")
        self.full_first, self.full_after = cuts[group - 1], cuts[group]

    def codes(self, words: list) -> np.ndarray:
        """Words as symbols; 0, which no match holds, for words that are not in the index."""
        return np.array([self.words.get(word, 0) for word in words], np.int64)

    def matches(self, streamed: list[np.ndarray], before: np.ndarray, least: int = 1) -> list[np.ndarray]:
        """Matching statistics of each streamed sequence, given as ``codes``.

        At each place: how many words from there on, up to ``longest``, stand in a sequence whose owner is below the
        streamed sequence's ``before``. A sequence is left, with 0 at its places to come, when so few of them remain
        that no match there can reach ``least`` words.
        """
        sizes = np.array([len(s) for s in streamed], np.int64)
        starts = np.cumsum(sizes) - sizes
        symbols = np.concatenate([*streamed, np.zeros(0, np.int64)])
        found = np.zeros(len(symbols), np.int32)
        at = starts + sizes - 1
        first, after = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.size)
        depth = np.zeros(len(sizes), np.int32)
        active = np.flatnonzero(sizes > 0)
        while len(active):
            symbol, low, high = symbols[at[active]], first[active], after[active]
            ranks = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = np.split(np.concatenate([self.smaller[symbol]] * 2) + ranks, 2)
            fits = (high > low) & (symbol > 0)
            fits[fits] = self.owner.between(low[fits], high[fits]) < before[active[fits]]
            longer = active[fits]
            first[longer], after[longer] = low[fits], high[fits]
            depth[longer] += 1
            beyond = longer[depth[longer] > self.longest]
            first[beyond], after[beyond] = self.full_first[first[beyond]], self.full_after[first[beyond]]
            depth[beyond] = self.longest
            failed = active[~fits]
            ended, shorter = failed[depth[failed] == 0], failed[depth[failed] > 0]
            shared = np.maximum(self.common[first[shorter]], self.common[after[shorter]])
            some, none = shorter[shared > 0], shorter[shared <= 0]
            first[some], after[some] = self.shared.widened(first[some], after[some], shared[shared > 0])
            first[none], after[none] = 0, self.size
            depth[shorter] = np.maximum(shared, 0)
            moved = np.concatenate([longer, ended])
            found[at[moved]] = depth[moved]
            at[moved] -= 1
            remain = at[active] - starts[active] + 1
            active = active[(remain > 0) & (remain + depth[active] >= least)]
        return np.split(found, starts[1:]) if len(sizes) else []
