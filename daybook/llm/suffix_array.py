"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classed as smaller (S) or larger (L) than the one after them. The
leftmost S of each run, with the characters up to the next such place, is a
substring to be named: sorting those substrings by induction gives their names,
the suffixes of the text of names are sorted, and the order of the named places
induces that of all L, then of all S suffixes.

A text over few characters is induced bucket by bucket: all that a bucket holds
so far is one array, and what it induces is dealt to later buckets in order. A
text of names has too many buckets for that and is sorted by prefix doubling, in
O(n log n) array operations for each of at most log n rounds.
"""

from __future__ import annotations

import numpy as np

#: Up to this many characters, induction goes bucket by bucket.
FEW = 1024


def _smaller(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last place is the unique lowest character."""
    step = np.sign(np.diff(s.astype(np.int64)))
    decided = np.flatnonzero(step)
    following = decided[np.searchsorted(decided, np.arange(len(step)))]
    return np.append(step[following] > 0, True)


def _dealt(places: np.ndarray, chars: np.ndarray, queues: dict[int, list]) -> None:
    """Append places to the queues of their characters, in order."""
    if not len(places):
        return
    order = np.argsort(chars, kind="stable")
    places, chars = places[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    starts = [0, *cuts.tolist(), len(places)]
    for char, a, b in zip(chars[starts[:-1]].tolist(), starts, starts[1:], strict=False):
        queues.setdefault(char, []).append(places[a:b])


def _induced_by_bucket(s: np.ndarray, small: np.ndarray, named: np.ndarray) -> np.ndarray:
    first = s[named]
    order = np.argsort(first, kind="stable")
    ends = np.searchsorted(first[order], np.arange(int(s.max()) + 2))
    named = named[order]
    chars = range(int(s.max()) + 1)
    larger: dict[int, list] = {}
    for c in chars:
        parts = larger.setdefault(c, [])
        at = 0
        while at < len(parts):  # a bucket induces into itself for runs of its character
            before = parts[at][parts[at] > 0] - 1
            before = before[~small[before]]
            _dealt(before, s[before], larger)
            at += 1
        before = named[ends[c] : ends[c + 1]]
        before = before[before > 0] - 1
        _dealt(before, s[before], larger)
    smaller: dict[int, list] = {}
    result: list[np.ndarray] = []
    for c in reversed(chars):
        parts = smaller.setdefault(c, [])
        if c == 0:
            parts.insert(0, np.array([len(s) - 1]))
        at = 0
        while at < len(parts):
            before = parts[at][parts[at] > 0] - 1
            before = before[small[before]]
            _dealt(before, s[before], smaller)
            at += 1
        tail = np.concatenate(larger[c])[::-1] if larger[c] else named[:0]
        before = tail[tail > 0] - 1
        before = before[small[before]]
        _dealt(before, s[before], smaller)
        result += [*parts, tail]
    return np.concatenate(result)[::-1]


def _doubled(s: np.ndarray) -> np.ndarray:
    """The suffix array by prefix doubling: groups of suffixes that agree so far are
    sorted by the groups of what follows, only as long as they have several members."""
    order = np.argsort(s, kind="stable")
    ordered = s[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.empty(len(s), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    left = np.flatnonzero(~(new & np.append(new[1:], True)))
    step = 1
    while len(left):
        # The last value is the only 0, so suffixes still in a group reach beyond ``step``.
        places = order[left]
        key = rank[places] * len(s) + rank[places + step]
        by = np.argsort(key)
        places, key = places[by], key[by]
        order[left] = places
        new = np.append(True, key[1:] != key[:-1])
        rank[places] = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
        left = left[~(new & np.append(new[1:], True))]
        step *= 2
    return order


def _names(s: np.ndarray, places: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings that start at ``ordered``; equal ones share theirs."""
    length = np.zeros(len(s), dtype=np.int64)
    length[places[:-1]] = np.diff(places) + 1
    length[places[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    at = 0
    while len(left):
        equal = s[a[left] + at] == s[b[left] + at]
        same[left[~equal]] = False
        at += 1
        left = left[equal & (length[a[left]] > at)]
    return np.append(0, np.cumsum(~same))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes of ``s``, whose last value is 0 and the only 0."""
    if len(s) == 1:
        return np.zeros(1, dtype=np.int64)
    if int(s.max()) >= FEW:
        return _doubled(s)
    small = _smaller(s)
    is_named = small.copy()
    is_named[0] = False
    is_named[1:] &= ~small[:-1]
    places = np.flatnonzero(is_named)
    order = _induced_by_bucket(s, small, places)
    ordered = order[is_named[order]]
    names = _names(s, places, ordered)
    if names[-1] + 1 < len(places):
        text = np.zeros(len(s), dtype=np.int64)
        text[ordered] = names
        ordered = places[suffix_array(text[places])]
    return _induced_by_bucket(s, small, ordered)


def permuted_prefixes(
    data: np.ndarray, order: np.ndarray, left: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the suffix sorted before it and their common prefix.

    ``data`` are bytes, ``order`` the suffix array of ``len(data)`` places and
    ``left`` the bytes up to the end of a place's own string, beyond which no
    prefix counts. Where the characters before both suffixes agree, the prefix
    is that of the place before less one, so only the others are compared.
    """
    n = len(data)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    places = np.arange(n)
    known = before >= 0
    most = np.where(known, np.minimum(left, left[before]), 0)
    follows = known & (before > 0) & (places > 0)
    follows &= data[places - 1] == data[before - 1]
    # A string's first byte starts anew, as does one whose match starts a string.
    follows &= (left[places - 1] == left + 1) & (left[before - 1] == left[before] + 1)
    follows[1:] &= before[1:] == before[:-1] + 1
    start = np.flatnonzero(~follows)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    common = np.zeros(n, dtype=np.int64)
    active = start[most[start] > 0]
    at = 0
    while len(active):
        x = np.ascontiguousarray(words[active + at]).view(np.uint64)[:, 0]
        y = np.ascontiguousarray(words[before[active] + at]).view(np.uint64)[:, 0]
        differ = x ^ y
        done = differ != 0
        lowest = differ[done] & (~differ[done] + np.uint64(1))
        common[active[done]] = at + np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
        at += 8
        common[active[~done]] = at
        active = active[~done]
        active = active[most[active] > at]
    common = np.minimum(common, most)
    origin = np.maximum.accumulate(np.where(follows, 0, places))
    return before, np.maximum(common[origin] - (places - origin), 0)
