"""Revenue questions, answered from either layout.

The joins carry no hints: dimensions are stored tables, so Catalyst knows their size and
broadcasts them while they are small, and falls back to a shuffled join when they are not.
Chains are joined to the facts one table at a time. Joining the dimensions to each other first
would multiply their estimated sizes, and the facts would be shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import exact_sum
from millrace.operators.dimensional import Tables

STAR_TABLES = [
    "star_dim_category", "star_dim_status", "star_dim_date", "star_fact_transactions",
]
SNOWFLAKE_TABLES = [
    "snow_dim_category_group", "snow_dim_category", "snow_dim_status",
    "snow_dim_year", "snow_dim_month", "snow_dim_date", "snow_fact_transactions",
]


def _is_star(layout: Tables) -> bool:
    return "star_fact_transactions" in layout


def _fact(layout: Tables) -> DataFrame:
    return layout["star_fact_transactions" if _is_star(layout) else "snow_fact_transactions"]


def _status(layout: Tables) -> DataFrame:
    return layout["star_dim_status" if _is_star(layout) else "snow_dim_status"]


def _category(layout: Tables) -> DataFrame:
    return layout["star_dim_category" if _is_star(layout) else "snow_dim_category"]


def _with_group(facts: DataFrame, layout: Tables) -> DataFrame:
    """Adds group_name."""
    joined = facts.join(_category(layout), "category_id")
    if _is_star(layout):
        return joined.withColumnRenamed("category_group", "group_name")
    return joined.join(layout["snow_dim_category_group"], "group_id")


def _with_calendar(facts: DataFrame, layout: Tables) -> DataFrame:
    """Adds year, month, day."""
    if _is_star(layout):
        return facts.join(layout["star_dim_date"], "date_id")
    return (
        facts.join(layout["snow_dim_date"], "date_id")
        .join(layout["snow_dim_month"], "month_id")
        .join(layout["snow_dim_year"], "year_id")
        .withColumnsRenamed({"year_val": "year", "month_val": "month"})
    )


def revenue_by_category_status(layout: Tables, digits: int | None = None) -> DataFrame:
    keys = ["category_name", "status_name"]
    return (
        _fact(layout)
        .join(_category(layout), "category_id")
        .join(_status(layout), "status_id")
        .groupBy(*keys)
        .agg(F.count("*").alias("total_txns"), exact_sum("amount", digits).alias("total_amount"))
        .orderBy(*keys)
    )


def revenue_by_group_year(layout: Tables, digits: int | None = None) -> DataFrame:
    keys = ["group_name", "year"]
    facts = _with_calendar(_with_group(_fact(layout), layout), layout)
    return (
        facts.groupBy(*keys)
        .agg(exact_sum("amount", digits).alias("total_amount"))
        .orderBy(*keys)
    )


def daily_revenue_by_group(
    layout: Tables, status: str = "COMPLETED", digits: int | None = None
) -> DataFrame:
    keys = ["group_name", "year", "month", "day"]
    wanted = _status(layout).filter(F.col("status_name") == status)
    facts = _with_group(_fact(layout).join(wanted, "status_id"), layout)
    return (
        _with_calendar(facts, layout)
        .groupBy(*keys)
        .agg(F.count("*").alias("total_txns"), exact_sum("amount", digits).alias("total_amount"))
        .orderBy(*keys)
    )
