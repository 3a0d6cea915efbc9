"""CSV, Parquet and JSON files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import share

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
CODECS = ("none", "snappy", "gzip")

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

_CSV_OPTIONS = {
    "header": True,
    "timestampFormat": TIMESTAMP_TEXT,
    "timestampNTZFormat": TIMESTAMP_TEXT,
}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header line and no index column."""
    df.write.mode(mode).options(**_CSV_OPTIONS).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV under a declared schema. A value that does not fit is an error, not a null."""
    df = spark.read.schema(schema).options(**_CSV_OPTIONS).option("mode", "FAILFAST").csv(path)
    return df.select(*columns) if columns else df


def read_transactions_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    return read_csv(spark, path, TRANSACTION_SCHEMA, columns)


def write_parquet(
    df: DataFrame, path: str, codec: str = "snappy", files: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Parquet with a codec; `files` spreads the rows evenly over that many files."""
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    out = df.repartition(files) if files else df
    out.write.mode(mode).option("compression", codec).parquet(path)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, predicate=None
) -> DataFrame:
    """Parquet with an optional filter and projection; both reach the scan."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing what is there; readers see the old result or the new one."""
    df.write.mode("overwrite").json(path)


def fingerprint(spark: SparkSession, path: str) -> int:
    """A number that changes when a file below `path` is added, removed or replaced; reads no contents."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    return listed.agg(F.coalesce(F.bit_xor(each), F.lit(0))).first()[0]


def storage_footprint(spark: SparkSession, layouts: dict[str, str], baseline: str) -> DataFrame:
    """(layout, files, megabytes, saved_pct): stored size, and percent saved against `baseline`.

    Reads file lengths only, never the contents.
    """
    sizes = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.lit(layout).alias("layout"), "length")
        for layout, path in layouts.items()
    ]
    totals = (
        reduce(DataFrame.unionByName, sizes)
        .groupBy("layout")
        .agg(F.count("*").alias("files"), (F.sum("length") / (1024 * 1024)).alias("megabytes"))
    )
    base = totals.filter(F.col("layout") == baseline).select("megabytes").scalar()
    return totals.withColumn("saved_pct", (1 - share(F.col("megabytes"), base)) * 100)


def write_clustered(
    df: DataFrame, path: str, columns: list[str], lookups: tuple[str, ...] = (), row_group_bytes: int = 16 << 20
) -> None:
    """Parquet whose files and row groups hold ranges of `columns`, in order, so that filters on them skip the others.

    A filter on a prefix of the columns, equal or in a range, meets few files and row groups: their least and
    greatest values rule the rest out before a page is read. Columns in `lookups` get a Bloom filter a row group, which
    rules out row groups for values in no order. Range partitions are cut by sampled values, ties included, so
    the leading column may be mostly one value.
    """
    order = [F.col(c) for c in columns]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", row_group_bytes)
    for column in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
