"""Keyed tables that change in place, sets of tables that change at once, and key registries."""

import glob
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import checks, key_registry, stored_tables
from millrace.operators.dimensional import (
    CATEGORY_GROUPS, build_snowflake, build_star, registered_values, registry_keys, store, stored,
)
from millrace.sources import commits

SCHEMA = "id long, full_name string, email string, gpa decimal(5,2)"


def people(spark, n):
    return spark.range(1, n + 1).select(
        "id", F.concat(F.lit("P"), "id").alias("full_name"), F.concat(F.lit("p"), "id", F.lit("@x")).alias("email"),
        (F.col("id") % 100).cast("decimal(5,2)").alias("gpa"),
    )


def files_of(root, places):
    return {b: sorted(os.path.basename(p) for p in glob.glob(f"{root}/{f}/*.parquet")) for b, f in places.items()}


@pytest.fixture
def table(spark, root):
    stored_tables.create(people(spark, 1000), root, "id", buckets=32)
    return root


def changes(spark, data):
    return spark.createDataFrame(data, "seq long, id long, gpa decimal(5,2)")


def test_update_rewrites_only_the_buckets_of_changed_keys(spark, table, rows):
    before = stored_tables.folders(spark, table)
    names = files_of(table, before)
    some = changes(spark, [(1, 7, Decimal("1.00")), (2, 7, Decimal("2.00")), (3, 8, None), (4, 5000, Decimal("9.00"))])
    assert stored_tables.update(spark, table, some, ["gpa"], "seq") == 2
    after = stored_tables.folders(spark, table)
    moved = {b for b in after if after[b] != before[b]}
    assert 1 <= len(moved) <= 2 and len(after) == len(before) == 32
    assert all(files_of(table, after)[b] == names[b] for b in set(after) - moved)
    assert rows(stored_tables.read(spark, table).filter("id in (7, 8, 9)"), "id", "gpa") == [(7, Decimal("2.00")), (8, None), (9, Decimal("9.00"))]
    assert stored_tables.read(spark, table).count() == 1000


def test_changes_that_hit_nothing_commit_nothing(spark, table):
    assert stored_tables.update(spark, table, changes(spark, [(1, 9999, None)]), ["gpa"], "seq") == 0
    assert stored_tables.delete(spark, table, spark.createDataFrame([(9999,), (None,)], "id long")) == 0
    again = people(spark, 10).withColumn("arrival_seq", F.col("id"))
    assert stored_tables.insert_ignore(spark, table, again, "email", "arrival_seq") == 0
    assert commits.versions(spark, table) == [0]


def test_delete_and_insert(spark, table, rows):
    assert stored_tables.delete(spark, table, spark.createDataFrame([(3,), (3,), (4,), (None,)], "id long")) == 2
    arrivals = [(1, 2001, "N", "n@x", None), (2, 2002, "again", "n@x", None), (3, 2003, "known", "p5@x", None), (4, 2004, "back", "p3@x", None), (5, 2005, "none", None, None)]
    incoming = spark.createDataFrame(arrivals, f"arrival_seq long, {SCHEMA}")
    assert stored_tables.insert_ignore(spark, table, incoming, "email", "arrival_seq") == 2
    now = stored_tables.read(spark, table)
    assert now.count() == 1000
    assert rows(now.filter("id > 1000 or id in (3, 4, 5)"), "id", "full_name") == [(5, "P5"), (2001, "N"), (2004, "back")]
    assert stored_tables.read(spark, table, 0).count() == 1000 and stored_tables.read(spark, table, 1).count() == 998


def test_a_crash_between_write_and_commit_changes_nothing(spark, table, monkeypatch):
    def lost(*args):
        raise RuntimeError("lost")

    before = stored_tables.folders(spark, table)
    monkeypatch.setattr(commits, "commit", lost)
    with pytest.raises(RuntimeError):
        stored_tables.delete(spark, table, spark.range(1, 500))
    assert stored_tables.folders(spark, table) == before
    assert stored_tables.read(spark, table).count() == 1000
    monkeypatch.undo()
    assert stored_tables.vacuum(spark, table) > 0  # what the lost change wrote
    assert stored_tables.delete(spark, table, spark.range(1, 500).select("id")) == 499
    assert stored_tables.read(spark, table).count() == 501


def test_of_two_writers_one_is_refused(spark, table):
    version, state = commits.read(spark, table)
    stored_tables.delete(spark, table, spark.createDataFrame([(1,)], "id long"))
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, table, version, state)
    assert stored_tables.read(spark, table).count() == 999


def test_rules_refuse_a_change_as_a_whole(spark, table):
    with pytest.raises(ValueError, match="precision"):
        stored_tables.update(spark, table, spark.createDataFrame([(1, 1, 1000.0), (2, 2, 5.0)], "seq long, id long, gpa double"), ["gpa"], "seq", checks.PEOPLE_RULES)
    taken = spark.createDataFrame([(1, 1, "p900@x")], "seq long, id long, email string")
    with pytest.raises(ValueError, match="unique"):
        stored_tables.update(spark, table, taken, ["email"], "seq", checks.PEOPLE_RULES)
    faulty = spark.createDataFrame([(1, 2001, None, "n@x", None), (2, 2002, "ok", "m@x", None)], f"arrival_seq long, {SCHEMA}")
    with pytest.raises(ValueError, match="not_null"):
        stored_tables.insert_ignore(spark, table, faulty, "email", "arrival_seq", checks.PEOPLE_RULES)
    assert commits.versions(spark, table) == [0]


def test_a_table_may_lose_all_its_rows(spark, table):
    assert stored_tables.delete(spark, table, people(spark, 1000).select("id")) == 1000
    assert stored_tables.read(spark, table).count() == 0
    fresh = people(spark, 3).withColumn("arrival_seq", F.col("id"))
    assert stored_tables.insert_ignore(spark, table, fresh, "email", "arrival_seq") == 3
    assert stored_tables.vacuum(spark, table) == 32
    assert stored_tables.read(spark, table).count() == 3


TX = "transaction_id long, user_id long, amount double, category string, status string, timestamp timestamp_ntz"


def transactions(spark, categories, start=0):
    data = [(start + i, i, 1.0 * i, c, "OK", None) for i, c in enumerate(categories)]
    day = F.make_timestamp_ntz(F.lit(2025), F.lit(1), (F.col("user_id") % 28 + 1).cast("int"), F.lit(start % 24), F.lit(0), F.lit(0))
    return spark.createDataFrame(data, TX).withColumn("timestamp", day)


def test_a_failed_refresh_leaves_all_tables_as_they_were(spark, root):
    names = ["Travel", "Groceries"] * 20
    store(build_star(transactions(spark, names), CATEGORY_GROUPS), root)
    new = build_star(transactions(spark, [*names, "Clothing"], start=3), CATEGORY_GROUPS)
    last = list(new)[-1]
    assert len(new) == 4
    broken = new | {last: new[last].withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))}
    with pytest.raises(PySparkException):
        store(broken, root)
    old = stored(spark, root)
    assert {n: t.count() for n, t in old.items()} == {"star_dim_category": 2, "star_dim_status": 1, "star_dim_date": 28, "star_fact_transactions": 40}
    reader = stored(spark, root)["star_fact_transactions"]
    store(new, root)
    assert stored(spark, root)["star_dim_category"].count() == 3
    assert reader.count() == 40  # a reader that has begun keeps its version
    assert stored(spark, root, version=0)["star_dim_category"].count() == 2
    store(new, root)
    with pytest.raises(PySparkException):  # two versions are kept
        stored(spark, root, version=0)["star_dim_category"].count()
    store({"other": spark.range(3)}, root)
    assert stored(spark, root)["star_dim_category"].count() == stored(spark, root)["other"].count() == 3
    with pytest.raises(FileNotFoundError):
        stored(spark, f"{root}/nowhere")


def test_keys_survive_further_loads(spark, root, rows):
    def extended(values):
        return key_registry.extend(spark.createDataFrame([(v,) for v in values], "name string"), ["name"], "k", root)

    assert rows(extended(["m", "c", None, "m"])) == [(1, "c"), (2, "m")]
    assert rows(extended(["a", "m", "z"])) == [(1, "c"), (2, "m"), (3, "a"), (4, "z")]
    before = commits.versions(spark, root)
    assert rows(extended(["z", "c"])) == [(1, "c"), (2, "m"), (3, "a"), (4, "z")]
    assert commits.versions(spark, root) == before
    with pytest.raises(ValueError):
        key_registry.extend(spark.createDataFrame([("x",)], "other string"), ["other"], "k", root)


def test_an_empty_load_begins_a_registry(spark, root, rows):
    empty = spark.createDataFrame([], "name string")
    assert key_registry.extend(empty, ["name"], "k", root).count() == 0
    assert rows(key_registry.extend(spark.createDataFrame([("b",), ("a",)], "name string"), ["name"], "k", root)) == [(1, "a"), (2, "b")]


def test_a_load_that_fails_takes_no_keys(spark, root, rows, monkeypatch):
    first = spark.createDataFrame([("b",)], "name string")
    key_registry.extend(first, ["name"], "k", root)

    def lost(*args):
        raise commits.CommitConflict("lost")

    monkeypatch.setattr(commits, "commit", lost)
    with pytest.raises(commits.CommitConflict):
        key_registry.extend(spark.createDataFrame([("a",)], "name string"), ["name"], "k", root)
    monkeypatch.undo()
    assert rows(key_registry.extend(spark.createDataFrame([("c",)], "name string"), ["name"], "k", root)) == [(1, "b"), (2, "c")]


def test_layouts_of_a_second_load_keep_old_keys(spark, root, rows):
    first = transactions(spark, ["Travel", "Groceries"], start=5)
    second = transactions(spark, ["Travel", "Clothing", "Art"], start=1)
    keyed = registry_keys(root)
    old = build_star(first, CATEGORY_GROUPS, registered_values(first, root))["star_dim_category"].collect()
    build_snowflake(first, CATEGORY_GROUPS, registered_values(first, root), keyed=keyed)
    values = registered_values(second, root)
    star = build_star(second, CATEGORY_GROUPS, values)
    snow = build_snowflake(second, CATEGORY_GROUPS, values, keyed=keyed)
    now = {r["category_name"]: r["category_id"] for r in star["star_dim_category"].collect()}
    assert {r["category_name"]: r["category_id"] for r in old} == {"Groceries": 1, "Travel": 2}
    assert now == {"Groceries": 1, "Travel": 2, "Art": 3, "Clothing": 4}
    groups = {r["group_name"]: r["group_id"] for r in snow["snow_dim_category_group"].collect()}
    assert groups == {"Goods / Retail": 1, "Services / Leisure": 2, "Other": 3}
    assert star["star_fact_transactions"].count() == 3
