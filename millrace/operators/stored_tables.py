"""Keyed tables that change in place: only the buckets that hold a changed key are written anew.

A table is a folder. Rows lie in buckets by a hash of the key, a folder of Parquet files each, and a commit (see
sources/commits) names the folder of every bucket. A change writes new folders for the buckets it touches and commits
the list with those replaced. Readers see one version; a change that fails leaves folders nobody reads.

The number of buckets is fixed when a table is made, and bounds the list of a commit. Choose it so that a bucket is
some hundred MB: then a change costs its buckets, not the table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.checks import Rule
from millrace.operators.keyed_tables import (
    broken_rules, delete_by_key, last_change_per_key, new_rows, refuse_if_broken, update_by_key,
)
from millrace.session import delete_folder, on_file_system, release, written
from millrace.sources import commits


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a row; rows without a key are in the bucket of the null hash."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(df: DataFrame, root: str, key: str, buckets: int = 64) -> int:
    """Stores `df` as the first version of a table at `root`."""
    state = {"key": key, "buckets": buckets, "schema": df.schema.jsonValue(), "folders": {}}
    state["folders"] = _written_buckets(df, root, state)
    return commits.commit(df.sparkSession, root, -1, state)


def _written_buckets(rows: DataFrame, root: str, state: dict, touched: list[int] | None = None) -> dict[str, str]:
    """Writes rows by bucket into a new folder; bucket number to folder. A touched bucket without rows gets no folder."""
    name = f"data/{uuid.uuid4().hex}"
    placed = rows.withColumn("__bucket", bucket_of(state["key"], state["buckets"]))
    placed.hint("rebalance", F.col("__bucket")).write.partitionBy("__bucket").parquet(f"{root}/{name}")
    spark = rows.sparkSession
    files, folder = on_file_system(spark, f"{root}/{name}")
    found = [status.getPath().getName() for status in files.listStatus(folder)]
    return {n.partition("=")[2]: f"{name}/{n}" for n in found if n.startswith("__bucket=")}


def _rows(spark: SparkSession, root: str, state: dict, buckets: list[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(state["schema"])
    folders = [f for b, f in sorted(state["folders"].items()) if buckets is None or int(b) in buckets]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its latest commit, or of an earlier one that was not vacuumed away."""
    _, state = commits.read(spark, root, version)
    return _rows(spark, root, state)


def folders(spark: SparkSession, root: str, version: int | None = None) -> dict[int, str]:
    """Where each bucket that has rows lies."""
    return {int(b): f for b, f in commits.read(spark, root, version)[1]["folders"].items()}


def _buckets_with(spark: SparkSession, root: str, state: dict, keys: DataFrame) -> list[int]:
    """The buckets that hold one of `keys`: key column only, and only of buckets some key hashes to."""
    keys = keys.select(F.col(state["key"])).filter(F.col(state["key"]).isNotNull())
    number = bucket_of(state["key"], state["buckets"]).alias("bucket")
    asked = sorted(r["bucket"] for r in keys.select(number).distinct().collect())
    held = _rows(spark, root, state, asked).select(state["key"]).join(keys, state["key"], "left_semi")
    return sorted(r["bucket"] for r in held.select(number).distinct().collect())


def _replaced(spark: SparkSession, root: str, version: int, state: dict, rows: DataFrame, touched: list[int]) -> int:
    """Commits `rows` as the whole content of the touched buckets."""
    fresh = _written_buckets(rows, root, state)
    kept = {b: f for b, f in state["folders"].items() if int(b) not in touched}
    return commits.commit(spark, root, version, state | {"folders": kept | fresh})


def update(
    spark: SparkSession, root: str, changes: DataFrame, cols: list[str], order_by: str, rules: list[Rule] | None = None
) -> int:
    """Sets `cols` from the last change per key; the number of rows changed. Rules as in update_by_key.

    A rule of uniqueness is checked on the whole table, since other buckets may hold the new value.
    """
    version, state = commits.read(spark, root)
    key = state["key"]
    last = written(last_change_per_key(changes, key, cols, order_by).select(key, "change.*"), "changes")
    touched = _buckets_with(spark, root, state, last)
    if not touched:
        release(last)
        return 0
    before = _rows(spark, root, state, touched)
    unique = [r for r in rules or [] if r.kind == "unique" and r.column in cols]
    after = update_by_key(before, last, key, cols, order_by, [r for r in rules or [] if r not in unique] or None)
    if unique:
        rest = [b for b in range(state["buckets"]) if b not in touched]
        refuse_if_broken(after.unionByName(_rows(spark, root, state, rest)), unique)
    changed = before.join(last, key, "left_semi").count()
    _replaced(spark, root, version, state, after, touched)
    release(last)
    return changed


def delete(spark: SparkSession, root: str, keys: DataFrame) -> int:
    """Removes the rows with these keys; how many there were."""
    version, state = commits.read(spark, root)
    gone = written(keys.select(state["key"]).distinct(), "keys")
    touched = _buckets_with(spark, root, state, gone)
    if not touched:
        release(gone)
        return 0
    before = _rows(spark, root, state, touched)
    removed = before.join(gone, state["key"], "left_semi").count()
    _replaced(spark, root, version, state, delete_by_key(before, gone, state["key"]), touched)
    release(gone)
    return removed


def insert_ignore(
    spark: SparkSession, root: str, incoming: DataFrame, unique: str, order_by: str, rules: list[Rule] | None = None
) -> int:
    """Adds the first arrival per value of `unique` that the table lacks; how many rows that were.

    `unique` may be another column than the key. Only buckets that get rows are written anew: nothing
    but the unique column is read outside the buckets that get rows.
    """
    version, state = commits.read(spark, root)
    target = _rows(spark, root, state)
    added = written(new_rows(target, incoming, unique, order_by).select(*target.columns), "added")
    if rules:
        report = broken_rules(added, target, rules).filter("rows > 0").collect()
        if report:
            release(added)
            raise ValueError(f"rules broken: {', '.join(f'{r[0]} {r[1]} ({r[2]} rows)' for r in report)}")
    added_rows = added.filter(F.col(unique).isNotNull())
    count = added_rows.count()
    if count:
        number = bucket_of(state["key"], state["buckets"]).alias("bucket")
        touched = sorted(r["bucket"] for r in added_rows.select(number).distinct().collect())
        _replaced(spark, root, version, state, _rows(spark, root, state, touched).unionByName(added_rows), touched)
    release(added)
    return count


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes data folders that none of the last `keep` versions names; how many. Not while a change is under way."""
    known = commits.versions(spark, root)[-keep:]
    named = reduce(set.union, [set(commits.read(spark, root, v)[1]["folders"].values()) for v in known], set())
    files, folder = on_file_system(spark, f"{root}/data")
    removed = 0
    for write in files.listStatus(folder):
        for status in files.listStatus(write.getPath()):
            place = f"data/{write.getPath().getName()}/{status.getPath().getName()}"
            if status.isDirectory() and place not in named:
                delete_folder(spark, f"{root}/{place}")
                removed += 1
    return removed
