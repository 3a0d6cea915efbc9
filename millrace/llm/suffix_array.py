"""Suffix arrays by induced sorting, in whole numpy arrays, and permuted common prefixes.

Suffixes are L (larger than the next suffix) or S; an S after an L is a leftmost S (LMS). The substrings
between LMS places are sorted by inducing: buckets of equal first characters are walked once upwards to
place the L suffixes before the ones walked, and once downwards for the S suffixes. Equal substrings get
equal names, the names form a shorter text whose suffixes are sorted the same way, and their order
induces the whole array in linear work. A bucket is handled as arrays: its places, then the places
induced from them in the same bucket, and so on. That pays while buckets are large; a text of names with so many
of them that buckets hold under 256 places on average is sorted by doubling the length of compared
prefixes instead, up to `depth` names.
"""

from __future__ import annotations

import numpy as np


def is_small(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last character must be a unique smallest."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    small = np.empty(n, bool)
    small[n - 1] = True
    rises = text[change] < text[change + 1]
    small[: n - 1] = np.repeat(rises, np.diff(np.concatenate(([-1], change))))
    return small


def _chunks(places: np.ndarray, chars: np.ndarray, out: list[list[np.ndarray]]) -> None:
    """Appends places to the bucket of their character, in order."""
    if not len(places):
        return
    order = np.argsort(chars, kind="stable")
    places, chars = places[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    edges = [0, *cuts.tolist(), len(places)]
    for a, b in zip(edges, edges[1:]):
        out[chars[a]].append(places[a:b])


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, in the order that the LMS places `seeds` (sorted within their buckets) induce."""
    none = np.zeros(0, np.int64)
    chars = text[seeds]
    order = np.argsort(chars, kind="stable")
    grouped, edges = seeds[order], np.searchsorted(chars[order], np.arange(size + 1))
    larges: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size):
        if not larges[c] and edges[c] == edges[c + 1]:
            continue
        walk = np.concatenate(larges[c]) if larges[c] else none
        done = []
        while len(walk):
            done.append(walk)
            before = walk[walk > 0] - 1
            before = before[~small[before]]
            char = text[before]
            same = char == c
            _chunks(before[~same], char[~same], larges)
            walk = before[same]
        larges[c] = [np.concatenate(done)] if done else []
        walk = grouped[edges[c] : edges[c + 1]]
        before = walk[walk > 0] - 1
        before = before[~small[before]]
        _chunks(before, text[before], larges)
    smalls: list[list[np.ndarray]] = [[] for _ in range(size)]
    smalls[text[-1]].append(np.array([len(text) - 1]))  # the end is smaller than everything
    for c in range(size - 1, -1, -1):
        walk = np.concatenate(smalls[c]) if smalls[c] else none
        done = []
        while len(walk):
            done.append(walk)
            before = walk[walk > 0] - 1
            before = before[small[before]]
            char = text[before]
            same = char == c
            _chunks(before[~same], char[~same], smalls)
            walk = before[same]
        smalls[c] = [np.concatenate(done)[::-1]] if done else []
        for part in larges[c]:
            walk = part[::-1]
            before = walk[walk > 0] - 1
            before = before[small[before]]
            _chunks(before, text[before], smalls)
    return np.concatenate([part for c in range(size) for part in (*larges[c], *smalls[c])])


def _words(text: np.ndarray) -> np.ndarray:
    """The four characters from each place on, as one number (characters below 2^16; zeros after the end)."""
    padded = np.concatenate((text, np.zeros(4, text.dtype))).astype(np.uint64)
    n = len(text)
    return (padded[:n] << np.uint64(48)) | (padded[1 : n + 1] << np.uint64(32)) | (padded[2 : n + 2] << np.uint64(16)) | padded[3 : n + 3]


def _equal(words: np.ndarray, text: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Are the substrings of these lengths at a and b equal?"""
    equal = np.ones(len(a), bool)
    live, at, n = np.arange(len(a)), 0, len(text)
    while len(live):
        x, y, left = a[live] + at, b[live] + at, lengths[live] - at
        whole = left >= 4
        same = words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)]
        for k in range(3):
            part = ~whole & (left > k)
            if part.any():
                same_char = text[np.minimum(x + k, n - 1)] == text[np.minimum(y + k, n - 1)]
                same = np.where(part, same_char if k == 0 else same & same_char, same)
        same = same | (left <= 0)
        equal[live[~same]] = False
        live = live[same & (left > 4)]
        at += 4
    return equal


def by_doubling(names: np.ndarray, depth: int | None) -> np.ndarray:
    """The order of suffixes of `names` (ranks from 0), by their first `depth` names at least (all, if None)."""
    n, reach = len(names), 1
    rank = names.astype(np.int64)
    while True:
        after = np.full(n, 0, np.int64)
        if reach < n:
            after[: n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        reach *= 2
        if new[-1] == n - 1 or reach >= n or (depth is not None and reach >= depth):
            return order


def suffix_array(text: np.ndarray, size: int, depth: int | None = None) -> np.ndarray:
    """The suffixes of `text` in ascending order.

    Characters are 0 to size - 1; the last one is 0 and occurs nowhere else. With `depth`, suffixes are in
    order of their first `depth` characters at least, and ties may be in any order.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    if size > max(512, min(1 << 16, n // 256)):
        return by_doubling(text, depth)
    text = text.astype(np.uint16)
    small = is_small(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    found = induce(text, small, lms, size)
    marked = np.zeros(n, bool)
    marked[lms] = True
    ordered = found[marked[found]]
    # Names: an LMS substring reaches to the next LMS place, that included.
    length = np.empty(n, np.int64)
    length[lms] = np.diff(np.concatenate((lms, [n - 1]))) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    same[same] = _equal(_words(text), text, a[same], b[same], length[a[same]])
    name = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(n, np.int64)
    names[ordered] = name
    shorter = names[lms]
    if name[-1] == len(lms) - 1:
        sorted_lms = ordered
    else:
        # An LMS substring has two characters at least that the next one does not repeat.
        deep = None if depth is None else -(-depth // 2) + 1
        sorted_lms = lms[suffix_array(shorter, int(name[-1]) + 1, deep)]
    return induce(text, small, sorted_lms, size)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of the text the characters, up to `most`, that its suffix shares with the one before it in the array."""
    n = len(text)
    words = _words(text)
    shared = np.zeros(n, np.int64)
    a, b = order[:-1], order[1:]
    live, at = np.arange(n - 1), 0
    while len(live) and at < most:
        x, y = a[live] + at, b[live] + at
        inside = (x < n) & (y < n)
        same = inside & (words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)])
        rest = live[~same & inside]
        for k in range(4):
            if not len(rest):
                break
            x, y = a[rest] + at + k, b[rest] + at + k
            ok = (x < n) & (y < n)
            ok[ok] = text[x[ok]] == text[y[ok]]
            rest = rest[ok]
            shared[b[rest]] += 1
        live = live[same]
        shared[b[live]] += 4
        at += 4
    return np.minimum(shared, most)
