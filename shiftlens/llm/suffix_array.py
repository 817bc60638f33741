"""Suffix arrays by induced sorting, and the permuted longest common prefixes that go with them.

Suffixes are smaller (S) or larger (L) than the next one. The leftmost S suffixes of each run (LMS) are sorted:
their substrings by induction, and, where substrings repeat, the string of their names by recursion. From them one
pass to the right induces all L suffixes and one to the left all S suffixes. Over bytes a pass takes whole buckets
at a time; over the many names of a recursion it goes entry by entry.
"""

from __future__ import annotations

import numpy as np

BUCKETS = 512


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last symbol is the smallest one and occurs once."""
    step = np.sign(np.diff(s))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    decides = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.ones(len(s), bool)
    smaller[:-1] = np.append(step, 1)[decides] > 0
    return smaller


def _by_symbol(s: np.ndarray, at: np.ndarray, lists: list[list[np.ndarray]]) -> None:
    if not len(at):
        return
    symbols = s[at]
    order = np.argsort(symbols, kind="stable")
    at, symbols = at[order], symbols[order]
    starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    for first, after in zip(starts, np.append(starts[1:], len(at)), strict=True):
        lists[symbols[first]].append(at[first:after])


def _sweep(s: np.ndarray, wanted: np.ndarray, lists: list[list[np.ndarray]], extra: list[np.ndarray], order: range) -> list[np.ndarray]:
    """Induce the suffixes of the wanted type, bucket after bucket; ``extra`` is scanned after a bucket's own."""
    done = [np.empty(0, np.int64)] * len(lists)
    for symbol in order:
        waves, wave = [], np.concatenate(lists[symbol] or [done[symbol]])
        while len(wave):  # a run of one symbol induces into its own bucket
            waves.append(wave)
            before = wave[wave > 0] - 1
            wave = before[wanted[before] & (s[before] == symbol)]
        done[symbol] = np.concatenate(waves) if waves else done[symbol]
        before = np.concatenate([done[symbol], extra[symbol]])
        before = before[before > 0] - 1
        _by_symbol(s, before[wanted[before] & (s[before] != symbol)], lists)
    return done


def _induce_buckets(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    given: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    _by_symbol(s, lms, given)
    starts = [np.concatenate(g) if g else np.empty(0, np.int64) for g in given]
    large = _sweep(s, ~smaller, [[] for _ in range(sigma)], starts, range(sigma))
    small = _sweep(s, smaller, [[] for _ in range(sigma)], [x[::-1] for x in large], range(sigma - 1, 0, -1))
    small[0] = np.array([len(s) - 1])
    return np.concatenate([part for symbol in range(sigma) for part in (large[symbol], small[symbol][::-1])])


def _induce_entries(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    ends = np.cumsum(np.bincount(s, minlength=sigma))
    text, is_small, out = s.tolist(), smaller.tolist(), [-1] * len(s)
    tail = ends.tolist()
    for at in reversed(lms.tolist()):
        tail[text[at]] -= 1
        out[tail[text[at]]] = at
    head = [0, *ends[:-1].tolist()]
    for at in out:
        if at > 0 and not is_small[at - 1]:
            symbol = text[at - 1]
            out[head[symbol]] = at - 1
            head[symbol] += 1
    tail = ends.tolist()
    for place in range(len(out) - 1, -1, -1):
        at = out[place]
        if at > 0 and is_small[at - 1]:
            symbol = text[at - 1]
            tail[symbol] -= 1
            out[tail[symbol]] = at - 1
    return np.array(out)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Equal names for equal LMS substrings, in the order of ``ordered``."""
    length = np.zeros(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    differs = length[a] != length[b]
    active, offset = np.flatnonzero(~differs), 0
    while len(active):
        unlike = s[a[active] + offset] != s[b[active] + offset]
        differs[active[unlike]] = True
        offset += 1
        active = active[~unlike]
        active = active[length[a[active]] > offset]
    return np.cumsum(np.r_[0, differs])


def _sorted_suffixes(s: np.ndarray, sigma: int) -> np.ndarray:
    if len(s) == 1:
        return np.zeros(1, np.int64)
    smaller = _types(s)
    induce = _induce_buckets if sigma <= BUCKETS else _induce_entries
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        is_lms = np.zeros(len(s), bool)
        is_lms[lms] = True
        ordered = induce(s, smaller, lms, sigma)
        ordered = ordered[is_lms[ordered]]
        names = _names(s, lms, ordered)
        if names[-1] + 1 < len(lms):
            by_place = np.empty(len(s), np.int64)
            by_place[ordered] = names
            ordered = lms[_sorted_suffixes(by_place[lms], int(names[-1]) + 1)]
        lms = ordered
    return induce(s, smaller, lms, sigma)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order; symbols are small integers from 0."""
    s = np.append(np.asarray(symbols, np.int64) + 1, 0)
    return _sorted_suffixes(s, int(s.max()) + 1)[1:]


def permuted_lcp(symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start, the length that its suffix shares with the one before it in the order, and that one's start.

    Lengths fall by one from a start to the next as long as both suffixes move on together; only the others are
    compared symbol by symbol. The first suffix shares nothing, its neighbour is -1.
    """
    n = len(symbols)
    s = np.append(np.asarray(symbols, np.int64), -1)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    if n > 1:
        follows[1:] = (before[:-1] >= 0) & (before[1:] == before[:-1] + 1) & (s[: n - 1] == s[before[:-1]])
    heads = np.flatnonzero(~follows)
    shared = np.zeros(n, np.int64)
    active = heads[before[heads] >= 0]
    while len(active):
        a, b = active + shared[active], before[active] + shared[active]
        active = active[(s[a] == s[b]) & (a < n) & (b < n)]
        shared[active] += 1
    head = heads[np.cumsum(~follows) - 1]
    return shared[head] - (np.arange(n) - head), before
