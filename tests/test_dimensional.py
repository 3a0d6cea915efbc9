"""Star and snowflake loads, their questions and the plans behind them."""

import datetime as dt

import pytest
from plans import plan_text

from millrace.operators import checks
from millrace.operators.dimensional import (
    CATEGORY_GROUPS, FACT_COLUMNS, build_snowflake, build_star, dimension_values, load_fact, store,
    stored,
)
from millrace.plans import warehouse as questions
from millrace.sources.files import TRANSACTION_SCHEMA


def at(text):
    return dt.datetime.fromisoformat(text)


TX = [
    ("T1", 1, 10.10, "Travel", "COMPLETED", at("2025-12-31T23:59:59")),
    ("T2", 1, 20.20, "Groceries", "COMPLETED", at("2026-01-01T00:00:00")),
    ("T3", 2, 30.30, "Groceries", "FAILED", at("2026-01-01T00:59:59")),
    ("T4", 2, None, "Groceries", "COMPLETED", at("2026-01-01T01:00:00")),
    ("T5", 3, 50.50, "Gadgets", "COMPLETED", at("2026-02-01T05:06:07")),
]


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(TX, TRANSACTION_SCHEMA)


@pytest.fixture(scope="module")
def layouts(spark, tx):
    from millrace.session import fresh_path

    root = fresh_path(spark, "layouts")
    store(build_star(tx, CATEGORY_GROUPS), root)
    store(build_snowflake(tx, CATEGORY_GROUPS), root)
    return (
        stored(spark, root, questions.STAR_TABLES),
        stored(spark, root, questions.SNOWFLAKE_TABLES),
    )


def test_star(layouts, rows):
    star = layouts[0]
    assert rows(star["star_dim_category"]) == [
        (1, "Gadgets", "Other"), (2, "Groceries", "Goods / Retail"), (3, "Travel", "Services / Leisure"),
    ]
    assert rows(star["star_dim_status"]) == [(1, "COMPLETED"), (2, "FAILED")]
    assert rows(star["star_dim_date"]) == [
        (1, "2025-12-31 23:00", 2025, 12, 31, 23), (2, "2026-01-01 00:00", 2026, 1, 1, 0),
        (3, "2026-01-01 01:00", 2026, 1, 1, 1), (4, "2026-02-01 05:00", 2026, 2, 1, 5),
    ]
    fact = star["star_fact_transactions"]
    assert fact.columns == FACT_COLUMNS
    assert rows(fact)[0] == ("T1", 1, 3, 1, 1, "2025-12-31 23:59:59", 10.10)
    assert fact.count() == len(TX)


def test_snowflake(layouts, rows):
    snow = layouts[1]
    assert rows(snow["snow_dim_category_group"]) == [
        (1, "Goods / Retail"), (2, "Other"), (3, "Services / Leisure"),
    ]
    assert rows(snow["snow_dim_category"]) == [(1, "Gadgets", 2), (2, "Groceries", 1), (3, "Travel", 3)]
    assert rows(snow["snow_dim_year"]) == [(1, 2025), (2, 2026)]
    assert rows(snow["snow_dim_month"]) == [(1, 12, 1), (2, 1, 2), (3, 2, 2)]
    assert rows(snow["snow_dim_date"]) == [
        (1, "2025-12-31 23:00", 31, 23, 1), (2, "2026-01-01 00:00", 1, 0, 2),
        (3, "2026-01-01 01:00", 1, 1, 2), (4, "2026-02-01 05:00", 1, 5, 3),
    ]


def test_same_answers_from_both(layouts, rows):
    star, snow = layouts
    for ask, keys in [
        (questions.revenue_by_category_status, ["category_name", "status_name"]),
        (questions.revenue_by_group_year, ["group_name", "year"]),
        (questions.daily_revenue_by_group, ["group_name", "year", "month", "day"]),
    ]:
        assert checks.differences(ask(star), ask(snow), keys).count() == 0
    daily = questions.daily_revenue_by_group(star).collect()
    assert [tuple(r) for r in daily] == [
        ("Goods / Retail", 2026, 1, 1, 2, 20.20), ("Other", 2026, 2, 1, 1, 50.50),
        ("Services / Leisure", 2025, 12, 31, 1, 10.10),
    ]


def test_a_second_load_leaves_the_same_tables(spark, tx, layouts, rows, root):
    before = {name: rows(df) for name, df in layouts[0].items()}
    store(build_star(tx.limit(2), CATEGORY_GROUPS), root)
    store(build_star(tx, CATEGORY_GROUPS), root)
    again = stored(spark, root, questions.STAR_TABLES)
    assert {name: rows(df) for name, df in again.items()} == before


def test_lost_rows_are_reported(spark, tx, rows):
    broken = tx.union(
        spark.createDataFrame(
            [
                ("T6", 1, 1.0, None, "COMPLETED", at("2026-01-01T00:00:00")),
                ("T7", 1, 1.0, "Travel", None, at("2026-01-01T00:00:00")),
                ("T8", 1, 1.0, "Travel", "FAILED", None),
            ],
            TRANSACTION_SCHEMA,
        )
    )
    values = dimension_values(broken)
    fact = load_fact(broken, values)
    assert tuple(checks.load_guard(broken, fact).first()) == (8, 5, False)
    assert tuple(checks.load_guard(tx, load_fact(tx, values)).first()) == (5, 5, True)
    assert rows(checks.unmatched_rows(broken, values), "dimension", "value", "rows") == [
        ("category", None, 1), ("hour", None, 1), ("status", None, 1),
    ]
    assert checks.unmatched_rows(tx, values).count() == 0


def test_dimensions_are_broadcast_because_they_are_small(spark, layouts):
    star, snow = layouts
    for layout in (star, snow):
        text = plan_text(questions.daily_revenue_by_group(layout))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = questions.daily_revenue_by_group(star)
        assert "BroadcastHashJoin" not in plan_text(large)
        assert large.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_scan_reads_only_what_a_question_needs(layouts):
    text = plan_text(questions.revenue_by_category_status(layouts[0]))
    assert "ReadSchema: struct<category_id:int,status_id:int,amount:double>" in text
