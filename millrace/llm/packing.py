"""Packs documents into token sequences of equal capacity by Karmarkar-Karp multiway differencing.

A document's ids are its tokens and an end id. Full windows of a document are sequences of their own;
what remains is cut into pieces of at most `most_piece` ids, so that small differences can be evened out.
Pieces are dealt at random over groups of about `windows` sequences, and each group is partitioned: every
piece starts as a partial partition, and the two with the largest spread are merged, the largest sums of
one on the smallest of the other, until one is left. Windows come out near-equal; as long as the fullest
exceeds the capacity, the number of windows rises.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import slices
from millrace.llm.tokens import encoder, public_file
from millrace.session import written

CAPACITY = 2048
END = 1


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """`windows` lists of positions in `sizes` with near-equal sums (some may be empty)."""
    # A partial partition: [largest sum, heap of (sum, places)]; windows that hold nothing are left out.
    heap = [(-size, i, [size, [(size, i)]]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    held: dict[int, list[int]] = {i: [i] for i in range(len(sizes))}
    turn = len(sizes)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one[1]) < len(two[1]):
            one, two = two, one
        if len(one[1]) + len(two[1]) <= windows:
            for entry in two[1]:
                heapq.heappush(one[1], entry)
            one[0] = max(one[0], two[0])
        elif len(two[1]) == 1:
            size, place = two[1][0]
            least, home = one[1][0]
            held[home] += held.pop(place)
            heapq.heapreplace(one[1], (least + size, home))
            one[0] = max(one[0], least + size)
        else:
            large = sorted(one[1], reverse=True)
            small = sorted(two[1], reverse=True)
            alone = windows - len(small)  # of the large sums, those that meet an empty window
            merged = large[:alone]
            rest = large[alone:]
            for (x, home), (y, place) in zip(rest, small[::-1][: len(rest)]):
                held[home] += held.pop(place)
                merged.append((x + y, home))
            merged += small[::-1][len(rest) :]
            heapq.heapify(merged)
            one = [max(x for x, _ in merged), merged]
        spread = one[0] - (one[1][0][0] if len(one[1]) == windows else 0)
        heapq.heappush(heap, (-spread, turn, one))
        turn += 1
    found = [held[place] for _, place in heap[0][2][1]] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def fill(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of positions whose sums stay within the capacity, near-equal, as few as differencing allows."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return [w for w in found if w]
        windows += max(1, windows // 256)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, most_piece: int = 512) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece of every row of `docs`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([END], "<u4").tobytes()
        # Large slices, as each distinct piece is looked up once in a slice.
        for batch, texts in slices(batches, "text", 4_000_000):
            row, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(encode([t or "" for t in texts])):
                ids += end
                n = len(ids) // 4
                whole = n // capacity * capacity
                cuts = [*range(0, whole, capacity), *range(whole, n, most_piece), n]
                for a, b in zip(cuts, cuts[1:]):
                    row.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                    total.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, most_piece: int = 512, windows: int = 256) -> DataFrame:
    """Pieces with sequence_id and offset: every id of every document lies in exactly one piece.

    docs has doc_id and text; other columns are ignored. A null or empty text is its end id alone. Rows
    are packed one by one, also when they repeat or their doc_id is null. An empty table gives no rows.
    Sequence ids are distinct numbers, not a gapless count. Only lengths are shuffled, never texts.
    """
    cut = written(pieces(docs, tokenizer or public_file(), capacity, most_piece), "pieces")
    rest = cut.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(rest / (capacity * windows)))
    # The row's number in the written table spreads repeated rows too, and is the same in a retry.
    dealt = cut.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")

    def place(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        whole = np.flatnonzero(lengths == capacity).tolist()
        parts = np.flatnonzero(lengths < capacity).tolist()
        sequences = [[i] for i in whole]
        if parts:
            sequences += [[parts[i] for i in w] for w in fill([int(lengths[i]) for i in parts], capacity)]
        first = int(table.column("group")[0].as_py()) << 32
        order = np.concatenate([np.array(s) for s in sequences])
        ids = np.repeat(np.arange(len(sequences)) + first, [len(s) for s in sequences])
        offsets = np.concatenate([np.concatenate(([0], np.cumsum(lengths[s])[:-1])) for s in sequences])
        out = table.drop_columns(["group"]).take(pa.array(order))
        return out.append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("group").applyInArrow(place, schema)
