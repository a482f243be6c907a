"""Suffix arrays by induced sorting, and the common prefixes of neighbours, on numpy arrays."""

from __future__ import annotations

import numpy as np

#: Texts are induced bucket by bucket where they have no more letters than this, or many suffixes for each; other texts,
#: as deeper recursions tend to be, are sorted by rank doubling.
_LETTERS, _PER_BUCKET = 300, 256


def _classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type); the last position, the sentinel, is S."""
    n = len(t)
    s = np.zeros(n, bool)
    s[:-1] = t[:-1] < t[1:]
    s[-1] = True
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    # equal neighbours take the type of the end of their run
    ends = np.flatnonzero(differs)
    return s[ends][np.searchsorted(ends, np.arange(n))]


def _induce(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """All suffixes sorted by their first differing LMS substrings, from LMS positions given in order."""
    n = len(t)
    sa = np.full(n, -1, np.int32)
    chars = t[lms]
    counts = np.bincount(chars, minlength=len(heads))
    first = np.cumsum(counts) - counts
    order = np.argsort(chars, kind="stable")
    within = np.arange(len(lms)) - first[chars[order]]
    sa[tails[chars[order]] - counts[chars[order]] + within] = lms[order]
    used = np.flatnonzero(heads < tails)

    def place(found: np.ndarray, at: np.ndarray, upward: bool) -> None:
        if not len(found):
            return
        c = t[found]
        o = np.argsort(c, kind="stable")
        c, found = c[o], found[o]
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        sizes = np.diff(np.r_[starts, len(c)])
        offset = np.arange(len(c)) - np.repeat(starts, sizes)
        if upward:
            sa[at[c] + offset] = found
            at[c[starts]] += sizes
        else:
            sa[at[c] - 1 - offset] = found
            at[c[starts]] -= sizes

    # L-type suffixes, from the smallest bucket up; a bucket's own new entries form the next wave
    at = heads.copy()
    for c in used:
        low = heads[c]
        wave_from = low
        while at[c] > wave_from:
            wave_to = at[c]
            before = sa[wave_from:wave_to] - 1
            before = before[before >= 0]
            before = before[(~s_type[before]) & (t[before] == c)]
            sa[wave_to : wave_to + len(before)] = before
            at[c] += len(before)
            wave_from = wave_to
        block = sa[low : tails[c]]
        before = block[block > 0] - 1
        place(before[(~s_type[before]) & (t[before] > c)], at, True)
    # S-type suffixes, from the largest bucket down; the LMS entries were only needed above
    at = tails.copy()
    ends_of_l = heads + np.bincount(t[~s_type], minlength=len(heads))
    for c in used[::-1]:
        high = tails[c]
        wave_from = high
        while at[c] < wave_from:
            wave_to = at[c]
            before = sa[wave_to:wave_from][::-1] - 1
            before = before[before >= 0]
            before = before[s_type[before] & (t[before] == c)]
            sa[wave_to - len(before) : wave_to] = before[::-1]
            at[c] -= len(before)
            wave_from = wave_to
        block = np.concatenate([sa[at[c] : high][::-1], sa[heads[c] : ends_of_l[c]][::-1]])
        before = block[block > 0] - 1
        place(before[s_type[before] & (t[before] < c)], at, False)
    return sa


def _doubling(t: np.ndarray) -> np.ndarray:
    """Suffix array by rank doubling, from three symbols on where they fit in one word."""
    n = len(t)
    rank, size = t.astype(np.int64) + 1, int(t.max()) + 2
    width = 1
    if size < 2**21:
        rank = np.r_[rank, 0, 0]
        rank = (rank[:-2] * size + rank[1:-1]) * size + rank[2:]
        width = 3
    following = np.zeros(n, np.int64)
    while True:
        order = np.argsort(rank)
        key = rank[order]
        new = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        following[:] = 0
        if width < n:
            following[:-width] = rank[width:] + 1
        rank = rank * (n + 2) + following
        width *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` (non-negative integers, ended by a unique smallest 0) in order."""
    n = len(t)
    if n >= 2**31:
        raise ValueError("a text of 2 GB or more is to be cut into shards")
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    size = int(t.max()) + 1
    if size > max(_LETTERS, min(n // _PER_BUCKET, 2**16)):
        return _doubling(t)
    t = t.astype(np.uint16, copy=False)  # the smaller the text, the more of it is in the processor's cache
    s_type = _classify(t)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = s_type[1:] & ~s_type[:-1]
    counts = np.bincount(t, minlength=size)
    tails = np.cumsum(counts)
    heads = tails - counts
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) < 2:
        return _induce(t, s_type, lms, heads, tails)
    rough = _induce(t, s_type, lms, heads, tails)
    ordered = rough[is_lms[rough]]
    # name the LMS substrings: equal neighbours share a name
    nth = np.empty(n, np.int32)
    nth[lms] = np.arange(len(lms))
    ends = np.r_[lms[1:], n - 1]
    length = ends - lms + 1
    a, b = ordered[:-1], ordered[1:]
    la, lb = length[nth[a]], length[nth[b]]
    same = la == lb
    open_, step = np.flatnonzero(same), 0
    while len(open_):
        x, y = a[open_] + step, b[open_] + step
        equal = (t[x] == t[y]) & (s_type[x] == s_type[y])
        same[open_[~equal]] = False
        step += 1
        open_ = open_[equal & (step < la[open_])]
    names = np.cumsum(np.r_[0, ~same])
    reduced = np.empty(len(lms), np.int64)
    reduced[nth[ordered]] = names
    deeper = np.empty(len(lms), np.int64)
    if names[-1] == len(lms) - 1:
        deeper[reduced] = np.arange(len(lms))
    else:
        deeper = suffix_array(reduced)
    return _induce(t, s_type, lms[deeper], heads, tails)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: at each text position, what its suffix shares with its predecessor in ``sa``, up to ``most``."""
    n = len(t)
    # several symbols at a time: words of up to seven, compared whole, then the first difference is looked for
    bits, per = (9, 7) if int(t.max()) < 510 else (62, 1)
    padded = np.concatenate([t.astype(np.uint64) + np.uint64(1), np.zeros(most + per, np.uint64)])
    word = np.zeros(n + most, np.uint64)
    for k in range(per):
        word |= padded[k : k + n + most] << np.uint64(bits * k)
    out = np.zeros(n, np.int32)
    live, other = sa[1:].astype(np.int64), sa[:-1].astype(np.int64)
    order = np.argsort(live)  # in text order
    live, other = live[order], other[order]
    for at in range(0, most, per):
        differ = word[live + at] ^ word[other + at]
        stop = differ != 0
        if stop.any():
            low = differ[stop] & (~differ[stop] + np.uint64(1))  # the lowest bit that differs
            out[live[stop]] = np.minimum(at + np.log2(low.astype(np.float64)).astype(np.int64) // bits, most)
            live, other = live[~stop], other[~stop]
        if not len(live):
            break
    out[live] = most
    return out
