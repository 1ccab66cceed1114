"""A suffix array by induced sorting, in vector steps, and permuted common prefixes up to a given length.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour; a leftmost-smaller (LMS) position is an S after an L.  LMS
substrings are sorted by inducing from their first characters and named, and
the string of names is sorted in turn; from the order of the LMS suffixes, L
suffixes are induced bucket by bucket upwards and S suffixes downwards, each
bucket's share in as many vector steps as its longest run of one character.

The caller compares only ``depth`` characters, so the recursion on names ends
once a name's string covers them: suffixes that agree so far may come in any
order, but always side by side.
"""

from __future__ import annotations

import numpy as np


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last is larger (than the empty suffix)."""
    n = len(t)
    differs = np.flatnonzero(np.append(t[1:] != t[:-1], True))  # the ends of runs
    at_end = np.zeros(n, bool)
    at_end[:-1] = t[:-1] < t[1:]
    return np.repeat(at_end[differs], np.diff(differs, prepend=-1))


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """The order of all suffixes from that of ``lms`` (LMS positions by first character, sorted as far as is known)."""
    n = len(t)
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    seeds = np.split(lms, np.cumsum(np.bincount(t[lms], minlength=size))[:-1])
    none = np.empty(0, np.int64)

    def scatter(found: np.ndarray, into: list) -> None:
        """Append positions to their characters' buckets, in order."""
        c = t[found]
        found = found[np.argsort(c, kind="stable")]
        count = np.bincount(c, minlength=size)
        at = 0
        for c in np.flatnonzero(count).tolist():
            into[c].append(found[at:at + count[c]])
            at += count[c]

    def spread(src: np.ndarray, into: list, want_smaller: bool) -> None:
        left = src[src > 0] - 1
        left = left[smaller[left] == want_smaller]
        if len(left):
            scatter(left, into)

    scatter(np.array([n - 1]), large)  # the one before the empty suffix, always L
    done: list[np.ndarray] = []
    for c in range(size):
        i = 0
        while i < len(large[c]):  # grows while a run of c is followed to its left
            spread(large[c][i], large, False)
            i += 1
        done.append(np.concatenate(large[c]) if large[c] else none)
        spread(seeds[c], large, False)
    small: list[list[np.ndarray]] = [[] for _ in range(size)]
    out: list[np.ndarray] = [none] * (2 * size)
    for c in range(size - 1, -1, -1):
        i = 0
        while i < len(small[c]):  # pieces are kept from the right end of the bucket inwards
            spread(small[c][i], small, True)
            i += 1
        out[2 * c + 1] = np.concatenate(small[c])[::-1] if small[c] else none
        out[2 * c] = done[c]
        spread(done[c][::-1], small, True)
    return np.concatenate(out)


def _named(t: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Names (ranks) of the LMS substrings in text order, and how many there are; equal substrings share a name."""
    n, m = len(t), len(lms)
    end = np.append(lms[1:], n - 1)  # each reaches up to the next one's first character
    length = np.empty(n, np.int64)
    length[lms] = end - lms + 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = (length[a] == length[b]) & (b + length[b] <= n)
    open_ = np.flatnonzero(same)
    k = 0
    while len(open_):  # compare character by character those that agree so far
        x, y = a[open_] + k, b[open_] + k
        equal = t[x] == t[y]
        same[open_[~equal]] = False
        open_ = open_[equal]
        k += 1
        open_ = open_[length[a[open_]] > k]
    rank = np.empty(m, np.int64)
    rank[0] = 0
    rank[1:] = np.cumsum(~same)
    names = np.empty(n, np.int64)
    names[sorted_lms] = rank
    return names[lms], int(rank[-1]) + 1


def _sort_names(names: np.ndarray, cover: int) -> np.ndarray:
    """The order of the suffixes of a string of names by their first ``cover`` names.

    The recursion: pairs of names are named anew, which doubles what a name covers, until all are different or
    ``cover`` is reached.
    """
    rank, reach = names.copy(), 1
    order = np.argsort(rank)
    while reach < cover:
        new = np.append(True, rank[order[1:]] != rank[order[:-1]])
        if new.all():
            break
        follower = np.full(len(rank), -1, np.int64)
        if reach < len(rank):
            follower[:-reach] = rank[reach:]
        key = rank * (int(rank.max()) + 2) + follower + 1
        order = np.argsort(key)
        changed = np.append(False, key[order[1:]] != key[order[:-1]])
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.cumsum(changed)
        reach *= 2
    return order


def suffix_array(t: np.ndarray, size: int, depth: int) -> np.ndarray:
    """All suffixes of the bytes ``t`` (each below ``size``) by at least their first ``depth``."""
    t = np.asarray(t, np.uint8)
    n = len(t)
    if n < 2:
        return np.arange(n)
    smaller = classify(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        first = _induce(t, smaller, lms[np.argsort(t[lms], kind="stable")], size)
        by_substring = first[is_lms[first]]
        names, _ = _named(t, by_substring, lms)
        # an LMS substring spans two characters or more up to the next one
        lms = lms[_sort_names(names, depth // 2 + 2)]
    return _induce(t, smaller, lms, size)


def permuted_prefixes(t: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position of ``order`` after the first: its common prefix with the one before it, up to ``most``.

    Permuted: worked out in order of text position, so that neighbouring comparisons read neighbouring text, eight
    characters at a time.  The bound that each value is at least its left neighbour's less one is not used: it holds
    for a full order of all suffixes, while ``order`` has the windows' only and leaves those open that agree over
    ``most``.
    """
    n, m = len(t), len(order)
    if m < 2:
        return np.zeros(max(m - 1, 0), np.int64)
    word = np.zeros(n + most + 8, np.uint64)
    word[:n] = t
    for k in (1, 2, 4):  # the next eight characters of each place in one number
        word[:-k] |= word[k:] << np.uint64(8 * k)
    by = np.argsort(order[1:], kind="stable")
    at, before = order[1:][by], order[:-1][by]
    got = np.zeros(m - 1, np.int64)
    open_ = np.arange(m - 1)
    k = 0
    while len(open_) and k < most:
        equal = word[at[open_] + k] == word[before[open_] + k]
        stop = open_[~equal]
        x = word[at[stop] + k] ^ word[before[stop] + k]
        got[stop] = k + (np.log2((x & (~x + np.uint64(1))).astype(float)).astype(np.int64) >> 3)
        open_ = open_[equal]
        k += 8
    got[open_] = most
    got = np.minimum(got, most)
    out = np.empty(m - 1, np.int64)
    out[by] = got
    return out
