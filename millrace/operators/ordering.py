"""Running totals and dense keys over a global order, without one task seeing all rows.

All of them take one way, whatever the size: the rows are range-partitioned by the order and written once,
so that ranges cannot move in a retry; each range is then numbered on its own, and what lies before it is
added from one row per range. How many ranges there are follows the size (adaptive execution joins small
ones) and is bounded by the session's number of shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def _in_ranges(df: DataFrame, order_by: list[str]) -> DataFrame:
    """`df` written in ranges of the order, with `slice`: the number of the range, in order."""
    ranged = df.repartitionByRange(*[F.col(c) for c in order_by])
    return written(ranged.withColumn("slice", F.spark_partition_id()), "ranges")


def running_total(df: DataFrame, order_by: list[str], weight: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `weight` over all rows up to and including this one.

    Rows must be distinct in `order_by`.
    """
    sliced = _in_ranges(df, order_by)
    totals = sliced.groupBy("slice").agg(F.sum(weight).alias("slice_total"))
    through = F.sum("slice_total").over(Window.orderBy("slice").rowsBetween(*_UP_TO_HERE))
    before = totals.select("slice", (through - F.col("slice_total")).alias("before"))
    inside = F.sum(weight).over(
        Window.partitionBy("slice").orderBy(*order_by).rowsBetween(*_UP_TO_HERE)
    )
    joined = sliced.join(F.broadcast(before), "slice")
    return joined.withColumn(out, F.col("before") + inside).drop("slice", "before")


def dense_keys(df: DataFrame, columns: list[str], key: str, key_type: str = "int") -> DataFrame:
    """One row per distinct non-null value of `columns`, numbered 1..n in sorted order."""
    values = df.select(*columns).dropna().distinct().withColumn("one", F.lit(1).cast("long"))
    numbered = running_total(values, columns, "one", key)
    return numbered.select(F.col(key).cast(key_type).alias(key), *columns)


def numbered_within(df: DataFrame, keys: list[str], order_by: list[str], out: str) -> DataFrame:
    """Adds `out`: 1, 2, ... within each key in the order of `order_by`.

    A key may hold any share of the rows: they are numbered range by range, and only the last key of
    each range, with its count, is carried to the next ones. Equal rows are told apart by an arbitrary
    tie-breaker.
    """
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    sliced = _in_ranges(tied, [*keys, *order_by, "tie"])
    local = F.row_number().over(Window.partitionBy("slice", *keys).orderBy(*order_by, "tie"))
    numbered = sliced.withColumn("key", F.struct(*keys)).withColumn("local", local.cast("long"))
    ends = numbered.groupBy("slice").agg(
        F.min("key").alias("first_key"),
        F.max(F.struct("key", "local")).alias("last"),
    )
    # Ranges that end with one key follow each other, so its rows so far are a sum over them.
    so_far = F.sum("last.local").over(
        Window.partitionBy("last.key").orderBy("slice").rowsBetween(*_UP_TO_HERE)
    )
    order = Window.orderBy("slice")
    ends = ends.withColumn("so_far", so_far)
    carried = F.when(
        F.col("first_key").eqNullSafe(F.lag("last.key").over(order)), F.lag("so_far").over(order)
    )
    ends = ends.select("slice", "first_key", F.coalesce(carried, F.lit(0)).alias("carried"))
    joined = numbered.join(F.broadcast(ends), "slice")
    number = F.col("local") + F.when(F.col("key").eqNullSafe(F.col("first_key")), F.col("carried")).otherwise(0)
    return joined.select(*df.columns, number.alias(out))
