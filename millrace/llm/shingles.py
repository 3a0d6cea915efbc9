"""Words and five-word shingles: as column expressions, and as numpy arrays inside tasks.

A word is a run of letters or digits of the lower-cased text. A text with fewer words than a shingle
has one shingle, all its words; a text without words (or null) has none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, functions as F

WORDS = 5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, also where a lambda refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def shingles_of(text: Column, k: int = WORDS) -> Column:
    """64-bit hashes of all shingles of `text`, in order, repeated ones included (empty for null)."""
    none = F.array().cast("array<bigint>")

    def each(h: Column) -> Column:
        n = F.size(h)
        return (
            F.when(n == 0, none)
            .when(n < k, F.array(F.xxhash64(h, n)))
            .otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, k))))
        )

    words = words_of(F.coalesce(text, F.lit("")))
    return let(F.transform(words, lambda w: F.xxhash64(w)), each)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _word_chars() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def _powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    base[:1] = 1
    return np.multiply.accumulate(base)


def shingle_arrays(texts: list, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, one after another, and the offsets at which each text starts."""
    lowered = [" " + (t or "").lower() for t in texts]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=starts[1:])
    codes = np.frombuffer(("".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_chars()[codes]
    before = np.concatenate(([False], inside[:-1]))
    first = np.flatnonzero(inside & ~before)
    last = np.flatnonzero(~inside & before)
    word_at = np.searchsorted(first, starts)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    place = np.arange(len(codes)) - np.repeat(np.concatenate(([0], first)), np.diff(np.concatenate(([0], first, [len(codes)]))))
    weights = _powers(int((last - first).max()) + 1)
    term = np.where(inside, mix(codes.astype(np.uint64) + np.uint64(0x51)), np.uint64(0)) * weights[np.minimum(place, len(weights) - 1)]
    word = mix(np.add.reduceat(term, first) + (last - first).astype(np.uint64))
    n = len(word)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        part = np.zeros(n, np.uint64)
        part[: max(n - j, 0)] = word[j:]
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + part
    sizes = np.diff(word_at)
    count = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    offsets = np.concatenate(([0], np.cumsum(count)))
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1], count) + np.repeat(word_at[:-1], count)
    hashes = mix(rolled[index])
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        x = np.uint64(sizes[i])
        for w in word[word_at[i] : word_at[i + 1]]:
            x = mix(np.array([x], np.uint64) * np.uint64(3) + w)[0]
        hashes[offsets[i]] = x
    return hashes, offsets
