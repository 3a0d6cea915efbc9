"""Transactions loaded into a star and a snowflake layout with the same surrogate keys.

Input: transactions(transaction_id, user_id, amount, category, status, timestamp).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import (
    hour_number, hour_number_date, hour_number_text, second_text, with_group,
)
from millrace.operators import key_registry
from millrace.operators.ordering import dense_keys, running_total
from millrace.session import delete_folder, fresh_path, make_folder, written
from millrace.sources import commits

# The category hierarchy.
CATEGORY_GROUPS = {
    "Clothing": "Goods / Retail",
    "Electronics": "Goods / Retail",
    "Groceries": "Goods / Retail",
    "Travel": "Services / Leisure",
    "Entertainment": "Services / Leisure",
}

# The columns of the fact.
FACT_COLUMNS = [
    "transaction_id", "user_id", "category_id", "status_id", "date_id", "transaction_ts", "amount",
]

Tables = dict[str, DataFrame]


def with_hour(tx: DataFrame, ts: str = "timestamp") -> DataFrame:
    return tx.withColumn("hour_number", hour_number(ts))


def hour_values(tx: DataFrame, ts: str = "timestamp") -> DataFrame:
    """(date_id, hour_number) of the hours that occur."""
    return dense_keys(with_hour(tx, ts), ["hour_number"], "date_id")


def dimension_values(tx: DataFrame) -> Tables:
    """The three keyed value lists both layouts share, from one scan of the source.

    The values of all three are numbered in one global order, list by list, and written by list.
    """
    found = with_hour(tx).select("category", "status", "hour_number").distinct()
    entry = lambda i, text, number: F.struct(F.lit(i).alias("list"), text.alias("text"), number.alias("number"))
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("int")
    entries = F.array(
        entry(0, F.col("category"), no_number), entry(1, F.col("status"), no_number), entry(2, no_text, F.col("hour_number"))
    )
    values = found.select(F.inline(entries)).filter("text is not null or number is not null").distinct()
    numbered = running_total(values.withColumn("one", F.lit(1).cast("long")), ["list", "text", "number"], "one", "place")
    spark, path = tx.sparkSession, fresh_path(tx.sparkSession, "values")
    numbered.select("list", "text", "number", "place").write.partitionBy("list").parquet(path)
    tables = {}
    for i, (name, value, column, key) in enumerate([
        ("category", "text", "category_name", "category_id"),
        ("status", "text", "status_name", "status_id"),
        ("hour", "number", "hour_number", "date_id"),
    ]):
        folder = f"{path}/list={i}"
        make_folder(spark, folder)  # a list may be empty
        rows = spark.read.schema("text string, number int, place long").parquet(folder)
        before = rows.agg(F.min("place")).scalar()
        tables[name] = rows.select((F.col("place") - before + 1).cast("int").alias(key), F.col(value).alias(column))
    return tables


def registered_values(tx: DataFrame, registry: str) -> Tables:
    """The same three lists with keys that earlier loads have given: see key_registry. Values of earlier loads stay."""
    found = with_hour(tx).select(
        F.col("category").alias("category_name"), F.col("status").alias("status_name"), "hour_number"
    )
    found = written(found.distinct(), "combinations")
    keyed = registry_keys(registry)
    return {
        "category": keyed(found, ["category_name"], "category_id"),
        "status": keyed(found, ["status_name"], "status_id"),
        "hour": keyed(found, ["hour_number"], "date_id"),
    }


def registry_keys(registry: str) -> Callable[[DataFrame, list[str], str], DataFrame]:
    """How to key the values of some columns: by the registry of that key below this folder."""
    return lambda df, columns, key: key_registry.extend(df, columns, key, f"{registry}/{key}")


def dense(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Keys of one load alone: 1..n in sorted order."""
    return written(dense_keys(df, columns, key), key)


def date_dim(hours: DataFrame) -> DataFrame:
    """Hour-grain dates from (date_id, hour_number): only the hours that occur."""
    date = hour_number_date("hour_number")
    return hours.select(
        "date_id",
        hour_number_text("hour_number").alias("date_hour"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.pmod("hour_number", F.lit(24)).alias("hour"),
    )


def load_fact(tx: DataFrame, values: Tables) -> DataFrame:
    """Transactions with values replaced by keys. A value without a key drops its row."""
    return (
        with_hour(tx)
        .join(values["category"], F.col("category") == F.col("category_name"))
        .join(values["status"], F.col("status") == F.col("status_name"))
        .join(values["hour"], "hour_number")
        .withColumn("transaction_ts", second_text("timestamp"))
        .select(*FACT_COLUMNS)
    )


def build_star(tx: DataFrame, mapping: dict[str, str], values: Tables | None = None) -> Tables:
    """The star layout; its fact scans the source once more than the values did."""
    values = values or dimension_values(tx)
    category = with_group(values["category"], "category_name", mapping, "category_group")
    return {
        "star_dim_category": category.select("category_id", "category_name", "category_group"),
        "star_dim_status": values["status"].select("status_id", "status_name"),
        "star_dim_date": date_dim(values["hour"]),
        "star_fact_transactions": load_fact(tx, values),
    }


def build_snowflake(
    tx: DataFrame,
    mapping: dict[str, str],
    values: Tables | None = None,
    fact: DataFrame | None = None,
    keyed: Callable[[DataFrame, list[str], str], DataFrame] = dense,
) -> Tables:
    """The snowflake layout. `fact` is the fact of a star that was stored, which is the same table.

    `keyed` gives the keys of groups, years and months; with those of a registry they outlive the load.
    """
    values = values or dimension_values(tx)
    category = with_group(values["category"], "category_name", mapping, "group_name")
    groups = keyed(category, ["group_name"], "group_id")

    dates = date_dim(values["hour"])
    years = keyed(dates.select(F.col("year").alias("year_val")), ["year_val"], "year_id")
    months = keyed(dates, ["year", "month"], "month_id").join(years, F.col("year") == F.col("year_val"))
    return {
        "snow_dim_category_group": groups.select("group_id", "group_name"),
        "snow_dim_category": category.join(groups, "group_name").select(
            "category_id", "category_name", "group_id"
        ),
        "snow_dim_status": values["status"].select("status_id", "status_name"),
        "snow_dim_year": years.select("year_id", "year_val"),
        "snow_dim_month": months.select("month_id", F.col("month").alias("month_val"), "year_id"),
        "snow_dim_date": dates.join(months, ["year", "month"]).select(
            "date_id", "date_hour", "day", "hour", "month_id"
        ),
        "snow_fact_transactions": load_fact(tx, values) if fact is None else fact,
    }


def store(tables: Tables, root: str, keep: int = 2) -> int:
    """Full refresh: all tables are written to a new folder, then one commit makes all of them current.

    Until then, and if a table fails, readers see all tables as they were. Other tables that were stored at `root` stay.
    What none of the last `keep` versions names is deleted. Returns the version.
    """
    spark = next(iter(tables.values())).sparkSession
    version, state = commits.read(spark, root)
    folder = f"snapshots/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{root}/{folder}/{name}")
    places = state.get("tables", {}) | {name: f"{folder}/{name}" for name in tables}
    version = commits.commit(spark, root, version, {"tables": places})
    known = [set(commits.read(spark, root, v)[1]["tables"].values()) for v in commits.versions(spark, root)[-keep - 1 :]]
    for place in set().union(*known[:-keep]) - set().union(*known[-keep:]):
        delete_folder(spark, f"{root}/{place}")
    return version


def load_layouts(tx: DataFrame, mapping: dict[str, str], star_root: str, snow_root: str) -> None:
    """Both layouts from two scans of the source: one for the keys, one for the fact.

    The snowflake's fact is a copy of the star's.
    """
    values = dimension_values(tx)
    star = build_star(tx, mapping, values)
    store(star, star_root)
    fact = stored(tx.sparkSession, star_root, ["star_fact_transactions"])["star_fact_transactions"]
    store(build_snowflake(tx, mapping, values, fact), snow_root)


def stored(spark: SparkSession, root: str, names: list[str] | None = None, version: int | None = None) -> Tables:
    """The tables as of one version, the latest by default."""
    found, state = commits.read(spark, root, version)
    if found == -1:
        raise FileNotFoundError(f"no tables were stored at {root}")
    return {name: spark.read.parquet(f"{root}/{state['tables'][name]}") for name in names or state["tables"]}
