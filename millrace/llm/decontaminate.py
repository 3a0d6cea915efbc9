"""Benchmark items inside documents: size-partitioned MinHash containment search, then an exact check.

An item is found in a document when at least `least` of its distinct shingles occur there. DataFrame
functions only.

The signature of a document is a one-permutation MinHash: the hash range is cut into bins, and each
bin keeps its smallest shingle hash. Documents are partitioned by size, and the number of bins is a
power of two that follows the size of the partition (at least twice the shingles of the document), so
a short item finds a long document as surely as a short one: each shared shingle is the smallest of
its bin with a probability above 0.6. In an item, a shingle is the smallest of its bin from that
resolution on at which it no longer shares the bin with a smaller hash; so one row per shingle, with
that resolution, serves all partitions. Partitions of documents too small to hold an item are not
searched for it.

With 16 shared shingles or more, the chance to miss a document is below 1e-6. Items with fewer distinct
shingles than `least_shingles` are looked up among all shingles instead, so they are never missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shingles import let, shingles_of
from millrace.session import written


def _bits(n: Column) -> Column:
    """The resolution (bins = 2^bits) of a document with n shingles: at least two bins for each."""
    return F.length(F.bin(n.cast("bigint"))) + 1


def _flagged(distinct: Column, bits: Column) -> Column:
    """The shingles in order, each with whether it is the smallest of its bin; a bin is the hashes with the same leading `bits`."""
    bin_of = lambda h: F.call_function("shiftright", h, 64 - bits)
    least = lambda s, h, i: (i == 0) | (bin_of(h) != bin_of(F.element_at(s, F.greatest(i, F.lit(1)))))
    return let(F.sort_array(distinct), lambda s: F.transform(s, lambda h, i: F.struct(h.alias("h"), least(s, h, i).alias("least"))))


def item_shingles(items: DataFrame, least: float, least_shingles: int) -> DataFrame:
    """item, n (distinct shingles), h, from_bits (smallest resolution at which h is the smallest of its bin), short."""
    sets = items.select(F.col("item_id").alias("item"), F.array_sort(F.array_distinct(shingles_of(F.col("text")))).alias("s"))
    rows = sets.where(F.size("s") > 0).select("item", F.size("s").alias("n"), "s", F.posexplode("s").alias("i", "h"))
    shared = F.when(F.col("i") == 0, F.lit(0)).otherwise(64 - F.length(F.bin(F.col("h").bitwiseXOR(F.element_at("s", F.greatest(F.col("i"), F.lit(1)))))))
    needed = _bits(F.ceil(F.col("n") * least))
    return rows.select("item", "n", "h", F.greatest(shared + 1, needed - 1).alias("from_bits"), (F.col("n") < least_shingles).alias("short"))


def find_items(docs: DataFrame, items: DataFrame, least: float = 0.8, least_shingles: int = 20) -> DataFrame:
    """item_id, doc_id, n_shingles, n_shared, containment of every document that holds an item.

    docs has doc_id and text, items has item_id and text; other columns are ignored. Null texts, texts
    without words and empty tables find nothing. An item of fewer than five words is one shingle and is
    found only in documents that are exactly those words. Of rows that share a doc_id the one that holds
    most counts; items that share an item_id are one item each, and the best of them counts.
    """
    parts = written(item_shingles(items, least, least_shingles), "items")
    # One scan and one look at each shingle: of long items its bin's smallest, of short ones any.
    hashed = docs.select(F.col("doc_id").alias("d"), F.array_distinct(shingles_of(F.col("text"))).alias("s"))
    signed = hashed.select("d", "s", _bits(F.size("s")).alias("bits"))
    rows = signed.select("d", "bits", F.inline(_flagged(F.col("s"), F.col("bits"))))
    met = rows.join(parts.select("item", "h", "from_bits", "short"), "h")
    pairs = written(met.where("short or (least and bits >= from_bits)").select("d", "item").distinct(), "candidates")

    # The exact check reads candidate documents only.
    ids = pairs.select(F.col("d").alias("doc")).distinct()
    held = docs.select(F.col("doc_id").alias("d"), "text").join(ids, F.expr("d <=> doc"), "left_semi")
    held = held.select("d", F.array_distinct(shingles_of(F.col("text"))).alias("s"))
    sets = items.select(F.col("item_id").alias("item"), F.array_distinct(shingles_of(F.col("text"))).alias("t"))
    checked = held.alias("a").join(pairs.alias("p"), F.expr("a.d <=> p.d")).join(sets.alias("t"), F.expr("p.item <=> t.item"))
    checked = checked.select(F.expr("a.d").alias("doc_id"), F.expr("p.item").alias("item_id"), F.size("t").alias("n"), F.size(F.array_intersect("s", "t")).alias("shared"))
    found = checked.where((F.col("n") > 0) & (F.col("shared") >= F.col("n") * least))
    best = found.groupBy("item_id", "doc_id").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("c"), "n", "shared")).alias("b"))
    return best.select("item_id", "doc_id", F.col("b.n").alias("n_shingles"), F.col("b.shared").alias("n_shared"), F.col("b.c").alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no item."""
    found = written(find_items(docs, items, least).select(F.col("doc_id").alias("__found")).distinct(), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__found"]), "left_anti")
