"""How evenly rows are spread over partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import share


def _summary(sizes: DataFrame) -> DataFrame:
    """Sizes hold one row per non-empty partition, so their median is a small aggregate."""
    return sizes.agg(
        F.count("*").alias("partitions"),
        F.max("rows").alias("max_rows"),
        F.median("rows").alias("median_rows"),
        share(F.max("rows"), F.sum("rows")).alias("max_share"),
        share(F.max("rows"), F.median("rows")).alias("max_to_median"),
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Non-empty partitions of `df` as it stands: count, largest, median, shares."""
    return _summary(df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("rows")))
