"""Numbering agrees with sorting, whatever the values look like and however many ranges there are."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import ordering
from millrace.operators.ordering import dense_keys, numbered_within, running_total


@pytest.fixture(params=["as_is", "many_ranges"], autouse=True)
def ranges(request, spark):
    """Small inputs make one range; without coalescing they make as many as there are partitions."""
    if request.param == "many_ranges":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_keys_follow_sorted_order(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("Z",), ("é",)], "v string")
    assert rows(dense_keys(df, ["v"], "k")) == [(1, "Z"), (2, "a"), (3, "b"), (4, "é")]
    assert dense_keys(df.limit(0), ["v"], "k").count() == 0


def test_keys_equal_sorted_positions(spark):
    values = [random.Random(1).randrange(10_000) for _ in range(5_000)] + [7] * 5_000
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    found = {r["v"]: r["k"] for r in dense_keys(df, ["v"], "k", "long").collect()}
    assert found == {v: i + 1 for i, v in enumerate(sorted(set(values)))}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.text(max_size=3)), max_size=60))
def test_two_column_keys(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b string")
    found = {(r["a"], r["b"]): r["k"] for r in dense_keys(df, ["a", "b"], "k").collect()}
    order = sorted(set(pairs), key=lambda p: (p[0], p[1].encode()))
    assert found == {p: i + 1 for i, p in enumerate(order)}


def test_running_total_of_weights(spark):
    data = [(i, (i * 37) % 11) for i in range(1000)]
    df = spark.createDataFrame(data, "i long, w long").repartition(5)
    total, expected = 0, {}
    for i, w in data:
        total += w
        expected[i] = total
    assert {r["i"]: r["t"] for r in running_total(df, ["i"], "w", "t").collect()} == expected


def test_numbered_within_a_key_that_holds_nine_of_ten_rows(spark):
    data = [("hot", i % 5) for i in range(6000)] + [(None, i) for i in range(300)] + [("x", 1), ("x", None)]
    data += [(f"k{i % 100}", i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v long").repartition(6)
    per_key = {}
    for r in numbered_within(df, ["k"], ["v"], "n").collect():
        per_key.setdefault(r["k"], []).append((r["n"], r["v"]))
    for key, found in per_key.items():
        values = [v for k, v in data if k == key]
        assert [n for n, _ in sorted(found, key=lambda p: p[0])] == list(range(1, len(values) + 1))
        assert [v for _, v in sorted(found, key=lambda p: p[0])] == sorted(values, key=lambda v: (v is not None, v))


def test_one_intermediate_write_and_no_join_of_rows_on_the_key(spark, monkeypatch):
    from plans import plan_text

    labels, write = [], ordering.written
    monkeypatch.setattr(ordering, "written", lambda df, label: labels.append(label) or write(df, label))
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    numbered = numbered_within(df, ["k"], ["v"], "n")
    assert labels == ["ranges"]
    assert "SortMergeJoin" not in plan_text(numbered)
    dense_keys(df, ["v"], "key")
    assert labels == ["ranges"] * 2
