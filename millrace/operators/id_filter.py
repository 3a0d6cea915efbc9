"""Bloom filters of id sets as small tables: which ids may be in a set, without reading the set.

A filter is cut into pages of 32768 bits, one row each. An id belongs to one page, by its hash, and sets HASHES bits
of it; an id is asked for by one join on the page and a test of those bits. Ids that were never added pass with a
chance of about 1 in 100,000, ids that were added always do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_BITS = 1 << 15  # what bitmap_construct_agg holds
IDS_PER_PAGE = 1024
HASHES = 8

FILTER_SCHEMA = "pages bigint, page bigint, bits binary"


def pages_for(ids: int) -> int:
    """A power of two, so that filters of different sizes share few page numberings."""
    return 1 << max(0, (max(ids, 1) - 1) // IDS_PER_PAGE).bit_length()


def _page(key: Column, pages: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 16).bitwiseAND(pages - 1)


def _positions(key: Column) -> list[Column]:
    """The bits of an id in its page: double hashing with an odd step, so all differ.

    One expression each, not a lambda over an array: Spark compiles the one and interprets the other.
    """
    start = F.xxhash64(key).bitwiseAND(PAGE_BITS - 1)
    step = F.xxhash64(key, F.lit(1)).bitwiseAND(PAGE_BITS - 1).bitwiseOR(F.lit(1))
    return [(start + step * i).bitwiseAND(PAGE_BITS - 1) for i in range(HASHES)]


def filter_of(ids: DataFrame, key: str, count: int) -> DataFrame:
    """(pages, page, bits): the filter of `count` ids. The ids' pages and bits are shuffled once, by page."""
    pages = F.lit(pages_for(count)).cast("bigint")
    placed = ids.filter(F.col(key).isNotNull()).select(_page(F.col(key), pages).alias("page"), F.array(*_positions(F.col(key))).alias("positions"))
    bits = placed.repartition("page").select("page", F.explode("positions").alias("bit"))
    return bits.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).select(pages.alias("pages"), "page", "bits")


def _is_set(bits: Column, position: Column) -> Column:
    one = F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    # ISO-8859-1 has a character for each byte, with the byte as its number.
    byte = F.ascii(F.decode(one, "ISO-8859-1"))
    return F.getbit(byte, position.bitwiseAND(7).cast("int")) == 1


def may_hold(filters: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """`ids` joined with the rows of `filters` (and their further columns) whose sets may hold them.

    Each id is looked up once in every numbering of pages that occurs; there is one for each power of two.
    """
    sizes = [r["pages"] for r in filters.select("pages").distinct().collect()]
    asked = ids.filter(F.col(key).isNotNull()).withColumn("__pages", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<bigint>")))
    asked = asked.withColumn("__page", _page(F.col(key), F.col("__pages")))
    found = asked.join(filters, (F.col("__pages") == F.col("pages")) & (F.col("__page") == F.col("page")))
    all_set = reduce(Column.__and__, [_is_set(F.col("bits"), p) for p in _positions(F.col(key))])
    return found.filter(all_set).drop("__pages", "__page", "pages", "page", "bits")
