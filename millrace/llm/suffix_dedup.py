"""Removes bytes covered by long strings that also start earlier, by suffix arrays over sharded text.

A byte goes if some `length`-byte string over it also starts earlier: in a smaller doc_id, or before in
the same document. Strings are judged on the input, and never reach across documents.

1. Copies of a whole document go at once; the first document with that text stands for them.
2. Every `length`-byte string is filed under the smallest hash of the `gram`-byte strings in it (the
   rightmost of equals). Equal strings are filed alike, at the same place, so only strings under a hash
   that occurs more than once can repeat. A place of such a hash, with the strings filed under it, is a
   context: a stretch of at most 2 length - gram bytes.
3. Contexts are sharded by hash. In a shard equal contexts fold to the first. A string that repeats shares
   half of what surrounds its smallest hash, on the left or on the right, with another context; contexts are
   cut back to the strings for which that holds. Over them a suffix array is built by induced sorting, with permuted common prefixes. Neighbours that share `length` bytes
   are equal strings; all but the first start are marked.
4. Marked strings are joined to spans, per document.

A hash with more than `hot` places is sharded by its strings instead, so no shard holds more than the
contexts of bounded hashes, or copies of one string, which fold as they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import slices
from millrace.llm.shingles import mix
from millrace.llm.suffix_array import permuted_prefixes, suffix_array
from millrace.session import release, written

LENGTH = 100
GRAM = 32
SHARD_BYTES = 4_000_000
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def _slide(values: np.ndarray, width: int, choose) -> np.ndarray:
    """choose (minimum or maximum) over each `width` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = choose(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return choose(values[:-rest], values[rest:]) if rest else values


def contexts(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, first and last start of the strings filed under each place of one text's bytes (uint8)."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none.astype(np.uint64), none, none, none
    up, down = _power_tables(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(data.astype(np.uint64) + np.uint64(0x51)) * up[:n], dtype=np.uint64)))
    h = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    width = length - gram + 1
    least = _slide(h, width, np.minimum)  # of the string that starts there
    starts = len(least)
    # Places that are the smallest of some string: no string over them has a larger smallest hash.
    edge = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    places = np.flatnonzero(_slide(edge, width, np.maximum) == h)
    first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [starts - 1]))
    low, high = np.searchsorted(places, first), np.searchsorted(places, last + width)
    run = np.repeat(np.arange(len(first)), high - low)
    place = places[np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)]
    own = h[place] == least[first[run]]
    run, place = run[own], place[own]
    # Rightmost of equals: a string belongs to the last place in it.
    following = np.concatenate((np.where(run[1:] == run[:-1], place[1:], np.iinfo(np.int64).max), [np.iinfo(np.int64).max]))
    a = np.maximum(first[run], place - width + 1)
    b = np.minimum(np.minimum(last[run], place), following - width)
    some = a <= b
    return h[place[some]], place[some], a[some], b[some]


def repeats(texts: list[bytes], ranks: list, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(text, first start, last start) of the strings of `length` bytes in `texts` that also start in a text, or place, of lower rank.

    ranks[i] is the rank of text i's first byte, as a tuple whose last item counts bytes; the later starts of a text rank higher.
    """
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    raw = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8)
    text = raw.astype(np.int64) + 2
    text[offsets[1:] - 1] = 1
    text[-1] = 0
    order = suffix_array(text, 258, length)
    shared = permuted_prefixes(text, order, length)
    owner = np.searchsorted(offsets, order, side="right") - 1
    owner = np.minimum(owner, len(texts) - 1)
    start = order - offsets[owner]
    whole = (start <= sizes[owner] - length) & (order < offsets[-1])
    group = np.cumsum(~(shared[order] >= length))
    group, owner, start = group[whole], owner[whole], start[whole]
    several = np.concatenate(([False], group[1:] == group[:-1])) | np.concatenate((group[1:] == group[:-1], [False]))
    group, owner, start = group[several], owner[several], start[several]
    if not len(group):
        return []
    # The rank of a start: the ranks of texts are sorted once, by all but the byte count.
    heads = {r: i for i, r in enumerate(sorted({r[:-1] for r in ranks}))}
    head = np.array([heads[r[:-1]] for r in ranks])[owner]
    byte = np.array([r[-1] for r in ranks])[owner] + start
    by_rank = np.lexsort((byte, head, group))
    group, owner, start, head, byte = (x[by_rank] for x in (group, owner, start, head, byte))
    is_first = np.concatenate(([True], group[1:] != group[:-1]))
    lead = np.flatnonzero(is_first)[np.cumsum(is_first) - 1]
    later = (head != head[lead]) | (byte != byte[lead])
    marked = np.unique(owner[later] * (1 << 40) + start[later])
    cuts = np.concatenate(([True], marked[1:] != marked[:-1] + 1))
    firsts = marked[cuts]
    lasts = marked[np.concatenate((cuts[1:], [True]))]
    return list(zip((firsts >> 40).tolist(), (firsts & ((1 << 40) - 1)).tolist(), (lasts & ((1 << 40) - 1)).tolist()))


def _file(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """d, t, h, place and the starts a to b of every context of every row (d, t, data)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, datas in slices(batches, "data"):
            found = [contexts(np.frombuffer(x, np.uint8), length, gram) for x in datas]
            row = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
            h, place, a, b = (np.concatenate(x) for x in zip(*found))
            packed = (place << 16) | ((place - a) << 8) | (place - b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(h.view(np.int64)), pa.array(packed)], ["d", "t", "h", "at"])

    return docs.select("d", "t", "data").mapInArrow(each, "d bigint, t int, h bigint, at bigint")


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """key, d, t, a, g (place of the hash in it, -1 if hot), text of contexts, from rows (d, t, data, at, hs, hots); of a hot hash, one row per string."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, datas in slices(batches, "data"):
            out: list[list] = [[], [], [], [], [], []]
            for i, data in enumerate(datas):
                d, t, at, hs, hots = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4, 5))
                for x, h, hot in zip(at, hs, hots):
                    place = x >> 16
                    a, b = place - ((x >> 8) & 255), place - (x & 255)
                    pieces = [(s, data[s : s + length]) for s in range(a, b + 1)] if hot else [(a, data[a : b + length])]
                    for s, piece in pieces:
                        key = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True) if hot else h
                        for column, value in zip(out, (key, d, t, s, -1 if hot else place - a, piece)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))], ["key", "d", "t", "a", "g", "text"])

    return rows.select("d", "t", "data", "at", "hs", "hots").mapInArrow(each, "key bigint, d bigint, t int, a bigint, g int, text binary")


def _cut_back(group: list[tuple], length: int, gram: int) -> list[tuple]:
    """Of distinct contexts (text, rank, g) of one hash, the stretches (text, rank) in which strings may repeat.

    A string with `left` bytes before the hash has length - gram - left after it, so that one side has at
    least half. Where no other context has the same half on a side, strings that need it are left out.
    """
    half = (length - gram + 1) // 2
    sides: tuple[dict, dict] = ({}, {})
    for text, _, g in group:
        for side, part in zip(sides, (text[max(0, g - half) : g], text[g + gram : g + gram + half])):
            if len(part) == half:
                side[part] = side.get(part, 0) + 1
    kept = []
    for text, rank, g in group:
        first, last = 0, len(text) - length
        if sides[0].get(text[max(0, g - half) : g], 0) < 2:
            first = max(first, g - half + 1)  # fewer than half before it
        if sides[1].get(text[g + gram : g + gram + half], 0) < 2:
            last = min(last, g - (length - gram) + half - 1)  # fewer than half after it
        if first <= last:
            kept.append((text[first : last + length], (*rank[:-1], rank[-1] + first)))
    return kept


def _mark(rows: DataFrame, length: int, gram: int, shard_bytes: int) -> DataFrame:
    """d, t, start, end of byte ranges to remove, from contexts sorted by key, text, d, t, a within partitions."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[], [], [], []]
        texts: list[bytes] = []
        ranks: list[tuple] = []
        group: list[tuple] = []  # distinct contexts of the key at hand
        held, last_key, last_text = 0, None, None

        def mark(d, t, first, last):
            for column, value in zip(found, (d, t, first, last + length)):
                column.append(value)

        def close():
            nonlocal held
            if len(group) > 1:
                for text, rank in _cut_back(group, length, gram):
                    texts.append(text)
                    ranks.append(rank)
                    held += len(text) + 1
            group.clear()

        def flush():
            nonlocal held
            if texts:
                for i, first, last in repeats(texts, ranks, length):
                    d, t, a = ranks[i]
                    mark(d, t, a + first, a + last)
            texts.clear()
            ranks.clear()
            held = 0

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(found, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["d", "t", "first", "last"])
            for column in found:
                column.clear()
            return batch

        for batch in batches:
            for key, d, t, a, g, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last_key:
                    close()
                    if held >= shard_bytes:
                        flush()
                    last_key, last_text = key, None
                if text == last_text:  # rows are in order, so the first of equal contexts came before
                    mark(d, t, a, a + len(text) - length)
                else:
                    group.append((text, (d, t, a), g))
                    last_text = text
            if found[0]:
                yield out()
        close()
        flush()
        if found[0]:
            yield out()

    return rows.mapInArrow(each, "d bigint, t int, first bigint, last bigint")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = 100_000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """d, t and `ranges` (first byte, byte after the last; they may overlap) of distinct documents (d, t, data)."""
    filed = _file(docs, length, gram)
    places = stored = written(filed, "places")
    several = places.groupBy("h").agg(F.count("*").alias("times")).where("times > 1")
    several = written(several.select("h", (F.col("times") > hot).alias("hot")), "repeated")
    places = places.join(several, "h")
    by_doc = places.groupBy("d", "t").agg(F.collect_list(F.struct("at", "h", "hot")).alias("all"))
    by_doc = written(by_doc.select("d", "t", F.expr("all.at").alias("at"), F.expr("all.h").alias("hs"), F.expr("all.hot").alias("hots")), "places-by-document")
    release(stored, several)
    cut = _cut(docs.join(by_doc, ["d", "t"]), length)
    sharded = cut.repartition("key").sortWithinPartitions("key", "text", "d", "t", "a")
    marked = _mark(sharded, length, gram, shard_bytes)
    return marked.groupBy("d", "t").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def _keep(data: bytes, ranges: list) -> tuple[bytes, int]:
    """The bytes outside the ranges, and how many spans are taken out."""
    kept, at, spans, end = [], 0, 0, -1
    for first, last in sorted(ranges):
        if first > end:
            spans += 1
            kept.append(data[at:first])
        end = max(end, last)
        at = max(at, last)
    kept.append(data[at:])
    return b"".join(kept), spans


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = 100_000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of every row of `docs`.

    docs has doc_id (a whole number) and text; other columns are ignored. A null text is empty. A null
    doc_id comes before all others. Rows with one doc_id and one text are one document, with the same
    result each; other texts under that doc_id come in order of a hash of the text. Texts shorter than
    `length` bytes lose nothing. An empty table gives no rows. `length` is at most 255 more than `gram`.
    """
    if not gram < length <= gram + 255:
        raise ValueError("length must be above gram, by 255 at most")
    text = F.coalesce("text", F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", order.alias("d"), F.hash(text).alias("t"), F.encode(text, "UTF-8").alias("data"))
    digests = written(rows.select("d", "t", F.octet_length("data").alias("size"), F.unhex(F.md5("data")).alias("digest")), "digests")
    texts = digests.groupBy("d").agg(F.min("t").alias("x"), F.max("t").alias("y"))
    if not texts.where("x <> y").limit(1).count():
        # Every doc_id has one text, so ids alone tell documents apart, and nothing more is shuffled.
        rows, digests = rows.withColumn("t", F.lit(0)), digests.withColumn("t", F.lit(0))
    long, digests = rows.where(F.octet_length("data") >= length), digests.where(F.col("size") >= length)
    heads = digests.groupBy("digest").agg(F.min(F.struct("d", "t")).alias("head"), F.count("*").alias("times")).where("times > 1")
    copies = digests.join(heads, "digest").where(F.struct("d", "t") > F.col("head")).select("d", "t").distinct()
    copies = written(copies, "copies")
    few = F.broadcast(copies) if copies.count() <= 500_000 else copies
    first = long.join(few, ["d", "t"], "left_anti").select("d", "t", "data")
    ranges = written(repeated_ranges(first, length, gram, hot, shard_bytes), "ranges")
    gone = ranges.select("d", "t", "ranges", F.lit(False).alias("copy")).union(copies.select("d", "t", F.lit(None).cast("array<struct<first:bigint,last:bigint>>"), F.lit(True)))
    joined = rows.join(gone, ["d", "t"], "left").select("doc_id", "data", "ranges", "copy")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, datas in slices(batches, "data"):
            out: list[list] = [[], [], [], [], []]
            for data, ranges, copy in zip(datas, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                kept, spans = (b"", 1) if copy else _keep(data, [(r["first"], r["last"]) for r in ranges or ()])
                for column, value in zip(out, (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept", "binary")
    return joined.mapInArrow(remove, schema)
