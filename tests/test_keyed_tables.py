"""Insert-ignore, update, delete and the rules of the keyed table."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks, keyed_tables

SCHEMA = "id long, full_name string, email string, gpa decimal(5,2)"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "A", "a@x", Decimal("80.00")), (2, "B", "b@x", None), (5, "E", "e@x", Decimal("70.50"))],
        SCHEMA,
    )


def arrivals(spark, data):
    return spark.createDataFrame(data, "arrival_seq long, full_name string, email string, gpa decimal(5,2)")


def test_insert_ignore(spark, target, rows):
    incoming = arrivals(
        spark,
        [(0, "N", "n@x", None), (1, "again", "a@x", None), (2, "late", "n@x", Decimal("99.00")),
         (3, "case", "A@x", None)],
    )
    with_ids = keyed_tables.with_defaults(incoming, target, "arrival_seq")
    assert with_ids.filter("created_at is null").count() == 0
    table = keyed_tables.insert_ignore(target, with_ids.drop("created_at"), "email", "arrival_seq")
    assert rows(table, "id", "full_name", "email") == [
        (1, "A", "a@x"), (2, "B", "b@x"), (5, "E", "e@x"), (6, "N", "n@x"), (9, "case", "A@x"),
    ]
    report = keyed_tables.affected_rows(target, "email", "arrival_seq", inserts=incoming)
    assert rows(report) == [("insert", 2)]
    again = keyed_tables.insert_ignore(table, with_ids.drop("created_at"), "email", "arrival_seq")
    assert again.count() == table.count()


def test_insert_into_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    first = keyed_tables.with_defaults(
        arrivals(spark, [(0, "N", "n@x", None)]), empty, "arrival_seq", time_column=None
    )
    assert keyed_tables.insert_ignore(empty, first, "email", "arrival_seq").first()["id"] == 1


def test_one_key_may_fill_the_batch(spark, target):
    hot = [(i, f"n{i}", "same@x", None) for i in range(500)]
    rest = [(1000 + i, "r", f"r{i}@x", None) for i in range(500)]
    nulls = [(2000 + i, "n", None, None) for i in range(500)]
    new = keyed_tables.new_rows(target, arrivals(spark, hot + rest + nulls), "email", "arrival_seq")
    assert new.count() == 1 + 500 + 500
    assert new.filter("email = 'same@x'").first()["full_name"] == "n0"


def test_update(spark, target, rows):
    changes = spark.createDataFrame(
        [(0, 1, Decimal("90.00")), (1, 1, None), (2, 2, Decimal("60.00")), (3, 2, Decimal("61.00")),
         (4, 77, Decimal("1.00")), (5, None, Decimal("2.00"))],
        "seq long, id long, gpa decimal(5,2)",
    )
    table = keyed_tables.update_by_key(target, changes, "id", ["gpa"], "seq")
    assert table.columns == target.columns
    assert rows(table.withColumn("gpa", F.col("gpa").cast("double")), "id", "gpa") == [
        (1, None), (2, 61.0), (5, 70.5),
    ]
    report = keyed_tables.affected_rows(target, "id", "seq", updates=changes)
    assert rows(report) == [("update", 2)]


def test_delete(spark, target, rows):
    gone = spark.createDataFrame([(2,), (2,), (99,)], "id long")
    assert rows(keyed_tables.delete_by_key(target, gone, "id"), "id") == [(1,), (5,)]
    report = keyed_tables.affected_rows(target, "id", "seq", deletes=gone)
    assert rows(report) == [("delete", 1)]


def test_a_load_is_taken_whole_or_refused(spark, target):
    long_name = arrivals(spark, [(0, "N", "n@x", None), (1, "x" * 200, "m@x", None)])
    nothing = arrivals(spark, [(0, None, None, None)])
    good = arrivals(spark, [(0, "N", "n@x", Decimal("99.50")), (1, "again", "a@x", None)])
    for bad, found in ((long_name, "full_name max_length"), (nothing, "email not_null")):
        rows = keyed_tables.with_defaults(bad, target, "arrival_seq", time_column=None)
        with pytest.raises(ValueError, match=found):
            keyed_tables.insert_ignore(target, rows, "email", "arrival_seq", checks.PEOPLE_RULES)
        unchecked = keyed_tables.insert_ignore(target, rows, "email", "arrival_seq")
        assert unchecked.filter("email is null").count() == 0
    rows = keyed_tables.with_defaults(good, target, "arrival_seq", time_column=None)
    assert keyed_tables.insert_ignore(target, rows, "email", "arrival_seq", checks.PEOPLE_RULES).count() == 4


def test_unique_counts_the_table_and_the_batch(spark, target):
    by_id = spark.createDataFrame([(9, "a@x"), (10, "a@x"), (11, "n@x"), (12, None), (13, None)], "id long, email string")
    report = keyed_tables.broken_rules(by_id, target, [checks.unique("email"), checks.not_null("email")])
    assert {(r["rule"], r["rows"]) for r in report.collect()} == {("unique", 2), ("not_null", 2)}


def test_an_update_that_breaks_a_rule_is_refused(spark, target):
    def change(gpa, email="z@x", key=1):
        return spark.createDataFrame([(0, key, gpa, email)], "seq long, id long, gpa double, email string")

    def update(rows):
        return keyed_tables.update_by_key(target, rows, "id", ["gpa", "email"], "seq", checks.PEOPLE_RULES)

    for rows, found in ((change(1000.0), "gpa precision"), (change(1.0, None), "email not_null"), (change(1.0, "b@x"), "email unique")):
        with pytest.raises(ValueError, match=found):
            update(rows)
    assert update(change(99.5)).filter("email = 'z@x'").count() == 1
    assert update(change(1000.0, key=77)).count() == 3


def test_rules(spark, rows):
    data = [
        ("ok", "a@x", 99.505), ("x" * 101, "b@x", 999.99), (None, "c@x", 1000.0),
        ("y" * 100, "a@x", -1000.0), ("z", None, None), ("z", "a@x", 999.996),
    ]
    df = spark.createDataFrame(data, "full_name string, email string, gpa double")
    found = {(c, r): n for c, r, n in map(tuple, checks.check_rules(df, checks.PEOPLE_RULES).collect())}
    assert found == {
        ("full_name", "not_null"): 1, ("full_name", "max_length"): 1, ("email", "not_null"): 1,
        ("email", "max_length"): 0, ("email", "unique"): 2, ("gpa", "precision"): 3,
    }
    with pytest.raises(ValueError, match="full_name not_null"):
        keyed_tables.refuse_if_broken(df, checks.PEOPLE_RULES)
    keyed_tables.refuse_if_broken(df.limit(1), checks.PEOPLE_RULES)
    half = spark.range(1).select(F.lit(99.505).cast("decimal(5,2)"))
    assert half.first()[0] == Decimal("99.51")


def test_the_rules_read_the_added_rows_from_one_table(spark):
    from plans import plan_text

    target = spark.createDataFrame([(1, "n", "a", 1.0)], "id int, full_name string, email string, gpa double")
    rows = [(i, None if i == 3 else "n", [None, "a", "b", "c"][i % 4], 1000.0 if i == 6 else 1.0) for i in range(12)]
    incoming = spark.createDataFrame(rows, "arrival_seq int, full_name string, email string, gpa double")
    added = keyed_tables.new_rows(target, incoming, "email", "arrival_seq")
    report = keyed_tables.broken_rules(added, target, checks.PEOPLE_RULES)
    # The joins that make the rows are not part of the report's plan.
    assert "LeftAnti" in plan_text(added) and "LeftAnti" not in plan_text(report)
    found = {(r["column_name"], r["rule"]): r["rows"] for r in report.collect()}
    assert found == {
        ("full_name", "not_null"): 1, ("full_name", "max_length"): 0, ("email", "not_null"): 3,
        ("email", "max_length"): 0, ("email", "unique"): 0, ("gpa", "precision"): 0,
    }
