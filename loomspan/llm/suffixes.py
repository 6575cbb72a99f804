"""Suffix arrays by induced sorting, in numpy.

The induced sort walks buckets of equal first byte; inside one bucket all
suffixes that are known so far are handled together, and those that they induce in
the same bucket make the next round, so the number of vector steps is the number
of buckets plus the longest run of one byte.  Suffixes need only be right to a
given depth here, so the recursion on the leftmost-smaller (LMS) substrings' names
ends when each name stands for that many bytes or all differ.
"""

from __future__ import annotations

import numpy as np

from loomspan.llm import textcore


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S type); the last is L,
    as the end of the text counts as smallest."""
    n = len(s)
    up = np.zeros(n, bool)
    if n < 2:
        return up
    change = np.flatnonzero(s[:-1] != s[1:])
    rises = s[change] < s[change + 1]
    # the type of a run of equal bytes is that of its last byte
    k = np.searchsorted(change, np.arange(n))
    inside = k < len(change)
    up[inside] = rises[k[inside]]
    return up


def _push(buckets: list[list[np.ndarray]], s: np.ndarray, at: np.ndarray) -> None:
    if not len(at):
        return
    first = s[at]
    order = np.argsort(first, kind="stable")
    first, at = first[order], at[order]
    cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
    for part in np.split(at, cuts):
        buckets[s[part[0]]].append(part)


def induce(s: np.ndarray, up: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that the given order of LMS suffixes induces."""
    n, alphabet = len(s), range(256)
    stars: list[list[np.ndarray]] = [[] for _ in alphabet]
    larger: list[list[np.ndarray]] = [[] for _ in alphabet]
    smaller: list[list[np.ndarray]] = [[] for _ in alphabet]
    _push(stars, s, lms)
    if n and not up[n - 1]:
        larger[s[n - 1]].append(np.array([n - 1]))  # what the empty suffix induces
    for c in alphabet:
        cur, done = _join(larger[c]), []
        while len(cur):
            done.append(cur)
            prev = cur[cur > 0] - 1
            prev = prev[~up[prev]]
            same = s[prev] == c
            _push(larger, s, prev[~same])
            cur = prev[same]
        larger[c] = done
        for part in stars[c]:
            prev = part[part > 0] - 1
            _push(larger, s, prev[~up[prev]])
    for c in reversed(alphabet):
        # scanned from the right: first what is in the S part, then the L part
        cur, done = _join(smaller[c]), []
        while len(cur):
            done.append(cur)
            prev = cur[cur > 0] - 1
            prev = prev[up[prev]]
            same = s[prev] == c
            _push(smaller, s, prev[~same])
            cur = prev[same]
        smaller[c] = done
        for part in reversed(larger[c]):
            part = part[::-1]
            prev = part[part > 0] - 1
            _push(smaller, s, prev[up[prev]])
    out = []
    for c in alphabet:
        out += [*larger[c], *(x[::-1] for x in reversed(smaller[c]))]
    return _join(out)


def _join(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of the bytes ``s`` ordered by their first ``depth`` bytes at least."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    up = suffix_types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = up[1:] & ~up[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) < 2:
        return induce(s, up, lms)
    # LMS substrings in order, then named: equal ones get equal names
    by_substring = induce(s, up, lms)
    by_substring = by_substring[is_lms[by_substring]]
    end = np.empty(n, np.int64)
    end[lms] = np.append(lms[1:] + 1, n)
    size = np.minimum(end[by_substring] - by_substring, depth)
    shared = textcore.common_prefixes(s, by_substring[:-1], by_substring[1:], depth)
    name = np.empty(n, np.int64)
    name[by_substring] = np.cumsum(np.append(0, (size[1:] != size[:-1]) | (shared < size[1:])))
    rank = name[lms]
    # names of 1, 2, 4, ... LMS substrings; each adds two bytes at least
    covered, m = 1, len(lms)
    while 2 * covered < depth and rank.max() + 1 < m:
        after = np.zeros(m, np.int64)
        after[:-covered] = rank[covered:] + 1 if covered < m else 0
        key = rank * (m + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
        covered *= 2
    return induce(s, up, lms[np.argsort(rank, kind="stable")])


def permuted_common_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """At each text position in ``order`` (a suffix array or a part of one in its
    order), the length of the prefix that its suffix shares with the one before it in
    the order, up to ``most``; 0 at the first and outside ``order``."""
    out = np.zeros(len(s), np.int64)
    if len(order) > 1:
        out[order[1:]] = textcore.common_prefixes(s, order[:-1], order[1:], most)
    return out
