"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-bucket array operations.

Suffixes are classified as S (smaller than the next) or L; the leftmost S suffixes of each run (LMS) are
sorted by the substrings between them, named, and where names repeat the reduced string of names is sorted
in turn by the same steps (of names that occur once only those that end a repeated run are kept). The order
of all other suffixes is then induced bucket by bucket: over bytes, what
a bucket contributes to later ones is one stable scatter; over names, whose buckets are many and small, each
suffix places its predecessor.
"""

from __future__ import annotations

from array import array

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True for S-type suffixes; the last symbol is a unique smallest sentinel."""
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    rises = np.concatenate((t[differs] < t[differs + 1], [True]))
    return rises[np.searchsorted(differs, np.arange(n))]


def _scatter(t: np.ndarray, at: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append suffixes to the buckets of their first symbols, keeping their order."""
    if not len(at):
        return
    symbols = t[at]
    order = np.argsort(symbols, kind="stable")
    at, symbols = at[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for part in np.split(at, cuts):
        buckets[t[part[0]]].append(part)


def _induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sigma: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """L and S suffixes by bucket, each in order, from LMS suffixes given in order."""
    none = np.zeros(0, np.int32)
    seeds: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    _scatter(t, lms, seeds)
    own = [np.concatenate(s) if s else none for s in seeds]
    waiting: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    large = []
    for c in range(sigma):
        front = np.concatenate(waiting[c]) if waiting[c] else none
        placed = [front]
        while len(front):
            before = front[front > 0] - 1
            before = before[~is_s[before]]
            same = t[before] == c
            _scatter(t, before[~same], waiting)
            front = before[same]
            placed.append(front)
        large.append(np.concatenate(placed))
        seed = own[c]
        _scatter(t, seed[seed > 0] - 1, waiting)
    waiting = [[] for _ in range(sigma)]
    small = [none] * sigma
    for c in reversed(range(sigma)):
        front = np.concatenate(waiting[c]) if waiting[c] else none  # from the right end of the bucket
        placed = [front]
        while len(front):
            before = front[front > 0] - 1
            before = before[is_s[before]]
            same = t[before] == c
            _scatter(t, before[~same], waiting)
            front = before[same]
            placed.append(front)
        small[c] = np.concatenate(placed)[::-1]
        back = large[c][::-1]
        back = back[back > 0] - 1
        _scatter(t, back[is_s[back]], waiting)
    small[0] = np.array([len(t) - 1], np.int32)
    return large, small


def _sort_substrings(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, names in that order) of the LMS substrings, each up to the next LMS suffix: names are equal for equal ones.

    Symbols count with their types, L below S, so no substring is another's prefix. A word of symbols at a step,
    for those that aren't told apart yet.
    """
    pairs = 2 * t.astype(np.int64) + is_s
    bits = int(pairs.max()).bit_length()
    per = 63 // bits
    pairs = np.concatenate((pairs, np.zeros(per, np.int64)))
    ends = np.append(lms[1:], lms[-1])

    def words(at: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for k in range(per):
            out = (out << bits) | np.where(at + k <= end, pairs[np.minimum(at + k, len(t))], 0)
        return out

    first = words(lms, ends)
    order = np.argsort(first, kind="stable")
    key = first[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    depth, places = per, np.arange(len(lms))
    while True:
        group = np.cumsum(fresh[places])  # places are whole groups
        several = np.bincount(group)[group] > 1
        places, group = places[several], group[several]
        going = lms[order[places]] + depth <= ends[order[places]]  # alike so far, so of a group all go on or none
        places, group = places[going], group[going]
        if not len(places):
            return order, np.cumsum(fresh) - 1
        who = order[places]
        key = words(lms[who] + depth, ends[who])
        inner = np.lexsort((key, group))
        order[places], key = who[inner], key[inner]
        fresh[places[1:]] |= key[1:] != key[:-1]
        depth += per


def _induce_each(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS suffixes in order: one step a suffix."""
    n = len(t)
    sizes = np.bincount(t)
    ends = np.cumsum(sizes)
    symbols = t[lms]
    by_symbol = np.argsort(symbols, kind="stable")
    left = np.bincount(symbols, minlength=len(sizes))
    place = np.arange(len(lms)) - np.repeat(np.cumsum(left) - left, left)
    seeded = np.full(n, n, np.int64)  # n: no suffix yet
    seeded[np.repeat(ends - left, left) + place] = lms[by_symbol]
    # the symbol before each suffix where that makes an L (or S) suffix, else -1; none before 0 and n
    to_l, to_s = (np.concatenate(([-1], np.where(is_s[:-1] == s, t[:-1], -1), [-1])) for s in (False, True))
    to_l, to_s, sa, head, tail = (array("i", x.astype(np.int32).tobytes()) for x in (to_l, to_s, seeded, ends - sizes, ends - 1))
    for i in sa:  # grows to the right of where it is read
        c = to_l[i]
        if c >= 0:
            h = head[c]
            sa[h] = i - 1
            head[c] = h + 1
    for i in reversed(sa):
        c = to_s[i]
        if c >= 0:
            h = tail[c]
            sa[h] = i - 1
            tail[c] = h - 1
    return np.frombuffer(sa, np.int32)


def _sorted_lms(t: np.ndarray, is_s: np.ndarray) -> np.ndarray:
    """LMS suffixes in order: their substrings are sorted and named, and a string with repeated names is sorted in turn."""
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    order, named = _sort_substrings(t, is_s, lms)
    if named[-1] + 1 == len(lms):
        return lms[order]
    names = np.zeros(len(lms), np.int64)
    names[order] = named
    repeated = np.bincount(named)[names] > 1
    # comparisons end at a name that occurs once, so what follows one can't matter before the next repeated name
    kept = np.flatnonzero(repeated | np.concatenate(([False], repeated[:-1])))
    own = np.concatenate((np.unique(names[kept], return_inverse=True)[1] + 1, [0]))
    is_s = _types(own)
    of = kept[_induce_each(own, is_s, _sorted_lms(own, is_s))[1:]]
    order[np.flatnonzero(repeated[order])] = of[repeated[of]]
    return lms[order]


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of t: symbols 1..sigma-1 followed by one final 0."""
    if len(t) == 1:
        return np.zeros(1, np.int32)
    is_s = _types(t)
    large, small = _induce(t, is_s, _sorted_lms(t, is_s), sigma)
    return np.concatenate([part for c in range(sigma) for part in (large[c], small[c])])


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with its predecessor in ``sa``, by text position.

    A suffix whose left neighbour symbol equals its predecessor's has one less than the suffix before it;
    only the others are compared, a word of symbols at a step. Symbols must fit 16 bits.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    kind = np.uint8 if int(t.max()) < 256 else np.uint16
    per_word = 8 // np.dtype(kind).itemsize
    data = np.zeros(n + per_word, kind)
    data[:n] = t
    at = np.arange(n)
    left = np.where(before > 0, t[np.maximum(before - 1, 0)].astype(np.int32), -1)
    follows = np.concatenate(([False], left[1:] == t[:-1])) & (before > 0)
    heads = np.flatnonzero(~follows & (before >= 0))
    words = np.lib.stride_tricks.sliding_window_view(data, per_word)
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    common = np.zeros(n, np.int64)
    live, depth = heads, 0
    while len(live):
        room = (np.maximum(live, before[live]) + depth) < n
        live = live[room]
        x = words[live + depth] ^ words[before[live] + depth]
        equal = x == 0
        ended = live[~equal]
        low = x[~equal] & (~x[~equal] + np.uint64(1))
        common[ended] = depth + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // (64 // per_word)
        live = live[equal]
        common[live] = depth + per_word
        depth += per_word
    last = np.maximum.accumulate(np.where(~follows, at, 0))
    return np.maximum(common[last] - (at - last), 0)
