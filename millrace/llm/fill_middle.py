"""Fill-in-middle: a document is cut at two line ranks that its id chooses, and its parts change places.

The lines of a text form an indexable skip list. A link of a lane carries the units it skips and the code
points they hold; a search for a rank goes along a lane while the accumulated units allow, then one lane
down, and so reaches the cut, as a place in the text, in about log2(lines) steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.batches import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def heights(n: int, seed: int = 1) -> np.ndarray:
    """How many express lanes each of the positions 1..n is in: k with a chance of 2^-(k+1), the same on every run."""
    with np.errstate(over="ignore"):
        x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        low = x & (~x + np.uint64(1))
    return np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)


class SkipList:
    """Cut places of a sequence of units, by rank. `lengths` are the code points of each unit.

    Lane 0 links every place to the next; an express lane links the head and the places whose height
    reaches it. `lanes[k]` is (units, chars, down): the widths of its links, and each node's place in the
    lane below.
    """

    def __init__(self, lengths: list[int]):
        self.size = len(lengths)
        units, chars = np.ones(self.size, np.int64), np.array(lengths, np.int64)
        self.lanes = [(units, chars, np.arange(self.size + 1))]
        tall, at = np.append(-1, heights(self.size)), np.arange(self.size + 1)
        tall[0] = 64  # the head is in every lane
        lane = 1
        while len(units) > 1:
            keep = np.flatnonzero(tall[at] >= lane)
            if len(keep) == 1:
                break
            # Links of this lane: sums of the links below, from one kept node to the next.
            units, chars = (np.add.reduceat(w[: keep[-1]], keep[:-1]) for w in (units, chars))
            self.lanes.append((units, chars, keep))
            at, lane = at[keep], lane + 1

    def seek(self, rank: int) -> tuple[int, int]:
        """(code points before the cut after `rank` units, links followed and lanes descended)."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        node = done = chars = steps = 0
        for units, widths, down in reversed(self.lanes):
            while node < len(units) and done + units[node] <= rank:
                done += int(units[node])
                chars += int(widths[node])
                node += 1
                steps += 1
            node = int(down[node])
            steps += 1
        return chars, steps


def line_lengths(text: str) -> list[int]:
    """Code points of each line, its line end included; what follows the last line end is a line if not empty."""
    parts = text.split("\n")
    lengths = [len(p) + 1 for p in parts[:-1]]
    return lengths + [len(parts[-1])] if parts[-1] else lengths


def _draws(doc_id: Column, seed: int, count: int) -> list[Column]:
    """The first 8-digit groups of the SHA-256 of `seed:doc_id`, as numbers. A null id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_share: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output: every document as a training string.

    The first two draws of a document's id, modulo n + 1, are the cut ranks; a third below `rate` (percent)
    transforms it, a fourth below `spm_share` (percent) puts the suffix first (`spm`), else the prefix
    (`psm`). Texts that are empty or hold one of the three marks stay `plain`, with null sizes. A null text is
    empty; a null doc_id draws like an empty one; repeated rows are rows of their own; other columns are
    ignored. Nothing is shuffled, and a task holds about a million characters or one text.
    """
    names = ["cut1", "cut2", "chance", "kind"]
    draws = _draws(F.col("doc_id"), seed, 4)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[d.alias(n) for d, n in zip(draws, names)])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            numbers = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            out: list[tuple] = []
            for text, cut1, cut2, chance, kind in zip(texts, *numbers):
                lengths = line_lengths(text)
                n = len(lengths)
                if not text or chance % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    out.append((n, "plain", None, None, text))
                    continue
                units = SkipList(lengths)
                a, b = sorted((cut1 % (n + 1), cut2 % (n + 1)))
                a, b = units.seek(a)[0], units.seek(b)[0]
                head, middle, tail = text[:a], text[a:b], text[b:]
                if kind % 100 < spm_share:
                    out.append((n, "spm", a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{middle}"))
                else:
                    out.append((n, "psm", a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{middle}"))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(x, t) for x, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(split, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(strings: DataFrame) -> DataFrame:
    """Adds `text`, rebuilt from `form` and `output` alone.

    A text with a mark inside is plain, and no mark can arise where a mark and a part meet, so each of the
    three marks stands once in an output that is not plain.
    """
    parts = F.split("output", f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    text = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output"))
    return strings.withColumn("text", text)


def digests(docs: DataFrame) -> DataFrame:
    """Sizes, and SHA-256 of every output and of the text rebuilt from it."""
    rebuilt = restore(transform(docs))
    return rebuilt.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )
