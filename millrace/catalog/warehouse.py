"""Registered queries: files, dimensional layouts, revenue questions and table checks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import parse_timestamp, round_even
from millrace.catalog.inputs import GROUPS, TX, money, table, tx
from millrace.operators import checks, partials
from millrace.operators.aggregates import filtered_stats, sum_by, table_counts
from millrace.operators.dimensional import (
    build_snowflake, build_star, date_dim, dimension_values, hour_values, load_fact, load_layouts, registered_values,
    registry_keys, store, stored,
)
from millrace.operators.ordering import dense_keys
from millrace.plans.warehouse import (
    SNOWFLAKE_TABLES, STAR_TABLES, daily_revenue_by_group, revenue_by_category_status,
    revenue_by_group_year,
)
from millrace.session import fresh_path, written
from millrace.sources import files

CENTS = 2  # the given prices have two decimals

# Layouts loaded by this application, by the files they were made from.
_loaded: dict[tuple, dict[str, DataFrame]] = {}


def layout(spark, sf_dir: str, kind: str) -> dict[str, DataFrame]:
    """The star or snowflake tables of `sf_dir`: loaded once for the files there, then read."""
    source = tx(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, files.fingerprint(spark, f"{sf_dir}/orders.parquet"))
    if key not in _loaded:
        star_root, snow_root = fresh_path(spark, "star"), fresh_path(spark, "snow")
        load_layouts(source, GROUPS, star_root, snow_root)
        _loaded[key] = stored(spark, star_root, STAR_TABLES) | stored(spark, snow_root, SNOWFLAKE_TABLES)
    names = STAR_TABLES if kind == "star" else SNOWFLAKE_TABLES
    return {name: _loaded[key][name] for name in names}


# -- files --------------------------------------------------------------------------------


def sum_by_category(spark, sf_dir):
    return sum_by(tx(spark, sf_dir), "category", "amount", "total_amount", CENTS)


def filtered_count_mean(spark, sf_dir):
    wanted = (F.col("status") == "F") & (F.col("amount") > 1000)
    return filtered_stats(tx(spark, sf_dir), wanted, "amount", CENTS)


def _clustered(spark, sf_dir) -> DataFrame:
    """Transactions stored in order of status and amount, with Bloom filters of users."""
    path = fresh_path(spark, "clustered")
    files.write_clustered(tx(spark, sf_dir), path, ["status", "amount"], ("user_id",), row_group_bytes=256 << 10)
    return files.read_parquet(spark, path)


def clustered_count_mean(spark, sf_dir):
    """The filtered count and mean from a layout that lets the scan skip row groups."""
    return filtered_stats(_clustered(spark, sf_dir), (F.col("status") == "F") & (F.col("amount") > 1000), "amount", CENTS)


def clustered_range(spark, sf_dir):
    """Transactions of one status in a narrow range of amounts."""
    wanted = (F.col("status") == "O") & F.col("amount").between(1000, 5000)
    return _clustered(spark, sf_dir).filter(wanted).select("transaction_id", "user_id", "amount")


def clustered_lookup(spark, sf_dir):
    """All transactions of a few users, by the Bloom filters of row groups."""
    return _clustered(spark, sf_dir).filter(F.col("user_id").isin(7, 77, 777)).select("transaction_id", "user_id", "amount")


def _daily_batches(spark, sf_dir) -> str:
    """Transactions in three batches, the second of them twice, and the first two joined before the third comes."""
    root = fresh_path(spark, "daily")
    batches = [
        partials.daily_amounts(tx(spark, sf_dir).filter(F.col("transaction_id") % 3 == i), CENTS) for i in range(3)
    ]
    for batch_id in (0, 1, 1):
        partials.add_batch(batches[batch_id], partials.DAILY_REVENUE, root, batch_id)
    partials.join_batches(spark, root, partials.DAILY_REVENUE)
    partials.add_batch(batches[2], partials.DAILY_REVENUE, root, 2)
    return root


def incremental_daily_revenue(spark, sf_dir):
    """Daily revenue of finished orders by category, from the states of three batches."""
    return partials.daily_revenue(spark, _daily_batches(spark, sf_dir), CENTS, "F").select(
        "category", F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day"), "transactions", "revenue"
    )


def discounted_revenue(spark, sf_dir):
    """Revenue after discount, whose amounts have no fixed number of decimals."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )
    total = sum_by(lines, "l_returnflag", "revenue", "revenue")
    return total.withColumn("revenue", F.round("revenue", 3))


def _tx_text(spark, sf_dir):
    return tx(spark, sf_dir).withColumn("transaction_id", F.col("transaction_id").cast("string"))


def csv_roundtrip_sum(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.write_csv(_tx_text(spark, sf_dir), path)
    back = files.read_transactions_csv(spark, path, ["category", "amount"])
    return sum_by(back, "category", "amount", "total_amount", CENTS)


def csv_filtered_count_mean(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.write_csv(_tx_text(spark, sf_dir), path)
    back = files.read_transactions_csv(spark, path, ["status", "amount"])
    return filtered_stats(back, (F.col("status") == "F") & (F.col("amount") > 1000), "amount", CENTS)


def csv_roundtrip_rows(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.write_csv(_tx_text(spark, sf_dir), path)
    return files.read_transactions_csv(spark, path)


def parquet_codec_sum(spark, sf_dir):
    parts = []
    for codec in files.CODECS:
        path = fresh_path(spark, f"parquet-{codec}")
        files.write_parquet(tx(spark, sf_dir), path, codec)
        back = files.read_parquet(spark, path, ["category", "amount"])
        total = sum_by(back, "category", "amount", "total_amount", CENTS)
        parts.append(total.withColumn("codec", F.lit(codec)))
    return reduce(DataFrame.unionByName, parts)


def storage_rows(spark, sf_dir):
    """What no codec changes: the rows that every stored form gives back."""
    paths = {"csv": fresh_path(spark, "csv")}
    files.write_csv(_tx_text(spark, sf_dir), paths["csv"])
    tables = {"csv": files.read_transactions_csv(spark, paths["csv"])}
    for codec in files.CODECS:
        path = paths[f"parquet_{codec}"] = fresh_path(spark, f"parquet-{codec}")
        files.write_parquet(tx(spark, sf_dir), path, codec)
        tables[f"parquet_{codec}"] = files.read_parquet(spark, path)
    sizes = files.storage_footprint(spark, paths, "csv").select(
        F.col("layout").alias("table_name"), (F.col("megabytes") > 0).alias("stored")
    )
    return table_counts(tables).join(sizes, "table_name")


def parsed_timestamps(spark, sf_dir):
    """Event times as text, and parsed again."""
    text = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("text"))
    return text.select("event_id", parse_timestamp("text").alias("ts"))


def half_even_quantities(spark, sf_dir):
    """Eighths of quantities at two decimals: ties go to the even digit."""
    eighths = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 8).alias("eighth"))
    return eighths.groupBy("eighth").agg(F.count("*").alias("rows")).withColumn("rounded", round_even("eighth"))


def storage_footprint(spark, sf_dir):
    paths = {"csv": fresh_path(spark, "csv")}
    files.write_csv(_tx_text(spark, sf_dir), paths["csv"])
    for codec in files.CODECS:
        paths[f"parquet_{codec}"] = fresh_path(spark, f"parquet-{codec}")
        files.write_parquet(tx(spark, sf_dir), paths[f"parquet_{codec}"], codec)
    return files.storage_footprint(spark, paths, "csv")


# -- dimensions and facts -----------------------------------------------------------------


def _star(name):
    return lambda spark, sf_dir: layout(spark, sf_dir, "star")[name]


def _snow(name):
    return lambda spark, sf_dir: layout(spark, sf_dir, "snow")[name]


def dim_date_hour(spark, sf_dir):
    return date_dim(hour_values(table(spark, sf_dir, "events"), "ts"))


def part_supplier_keys(spark, sf_dir):
    """Dense keys for a large domain."""
    return dense_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "pair_id", "long")


def fact_load(spark, sf_dir):
    source = tx(spark, sf_dir)
    return load_fact(source, dimension_values(source))


def fact_unmatched(spark, sf_dir):
    """All transactions against the dimensions an earlier load of the status F rows left behind."""
    source = tx(spark, sf_dir)
    earlier = dimension_values(source.filter(F.col("status") == "F"))
    return checks.unmatched_rows(source, earlier)


def load_guard(spark, sf_dir):
    source = tx(spark, sf_dir)
    whole = checks.load_guard(source, load_fact(source, dimension_values(source)))
    earlier = dimension_values(source.filter(F.col("status") == "F"))
    partial = checks.load_guard(source, load_fact(source, earlier))
    return whole.withColumn("load", F.lit("whole")).unionByName(
        partial.withColumn("load", F.lit("stale_dimensions"))
    )


def _two_loads(spark, sf_dir) -> dict[str, DataFrame]:
    """Both layouts after a second load, with the keys that the first one, of older orders, has given."""
    source, registry = tx(spark, sf_dir), fresh_path(spark, "registry")
    older = source.filter((F.col("timestamp") < "1998-01-01") & (F.col("category") != "3-MEDIUM"))
    for load in (older, source):
        values = registered_values(load, registry)
        star = build_star(load, GROUPS, values)
        snow = build_snowflake(load, GROUPS, values, star["star_fact_transactions"], registry_keys(registry))
    return star | snow


def second_load_keys(spark, sf_dir):
    """Every key of every dimension after two loads."""
    t = _two_loads(spark, sf_dir)
    named = {
        "category": ("star_dim_category", "category_id", F.col("category_name")),
        "status": ("star_dim_status", "status_id", F.col("status_name")),
        "hour": ("star_dim_date", "date_id", F.col("date_hour")),
        "group": ("snow_dim_category_group", "group_id", F.col("group_name")),
        "year": ("snow_dim_year", "year_id", F.col("year_val").cast("string")),
    }
    lists = [
        t[name].select(F.lit(dim).alias("dimension"), F.col(key).alias("key"), value.alias("value"))
        for dim, (name, key, value) in named.items()
    ]
    months = t["snow_dim_month"].join(t["snow_dim_year"], "year_id")
    text = F.concat_ws("-", F.col("year_val").cast("string"), F.lpad(F.col("month_val").cast("string"), 2, "0"))
    lists.append(months.select(F.lit("month").alias("dimension"), F.col("month_id").alias("key"), text.alias("value")))
    return reduce(DataFrame.unionByName, lists)


def second_load_fact(spark, sf_dir):
    """The fact of the second load, in keys that the first one may have given."""
    return _two_loads(spark, sf_dir)["star_fact_transactions"]


def layout_refresh(spark, sf_dir):
    """Rows per table of a star: first stored, after a refresh that failed in its last table, after one that did not."""
    root, source = fresh_path(spark, "refresh"), tx(spark, sf_dir)
    store(build_star(source.filter(F.col("status") == "F"), GROUPS), root)
    refreshed = build_star(source, GROUPS)
    broken = dict(refreshed)
    fact = broken.pop("star_fact_transactions")
    broken["star_fact_transactions"] = fact.withColumn("amount", F.raise_error(F.lit("lost source")).cast("double"))
    reports = []

    def report(state):
        rows = table_counts(stored(spark, root)).withColumn("state", F.lit(state))
        reports.append(written(rows, "refresh-report"))

    report("stored")
    try:
        store(broken, root)
        raise AssertionError("the refresh should have failed")
    except PySparkException:
        report("failed refresh")
    store(refreshed, root)
    report("refreshed")
    return reduce(DataFrame.unionByName, reports)


# -- revenue questions --------------------------------------------------------------------

_QUESTIONS = {
    "q1": (lambda tables: revenue_by_category_status(tables, CENTS), ["category_name", "status_name"]),
    "q2": (lambda tables: revenue_by_group_year(tables, CENTS), ["group_name", "year"]),
    "q3": (lambda tables: daily_revenue_by_group(tables, "F", CENTS), ["group_name", "year", "month", "day"]),
}


def _question(name, kind):
    ask = _QUESTIONS[name][0]
    return lambda spark, sf_dir: ask(layout(spark, sf_dir, kind))


def layout_differences(spark, sf_dir):
    """Per question: rows compared and rows on which the two layouts disagree."""
    star, snow = layout(spark, sf_dir, "star"), layout(spark, sf_dir, "snow")
    reports = []
    for name, (ask, keys) in _QUESTIONS.items():
        compared = ask(star).agg(F.count("*")).scalar()
        wrong = checks.differences(ask(star), ask(snow), keys)
        reports.append(
            wrong.agg(F.count("*").alias("differing")).select(
                F.lit(name).alias("question"), compared.alias("compared"), "differing"
            )
        )
    return reduce(DataFrame.unionByName, reports)


def result_differences(spark, sf_dir):
    """Daily revenue of two statuses against each other: values differ and days are missing."""
    star = layout(spark, sf_dir, "star")
    keys = ["group_name", "year", "month", "day"]
    return checks.differences(
        daily_revenue_by_group(star, "F", CENTS), daily_revenue_by_group(star, "P", CENTS), keys
    )


def repeated_key_differences(spark, sf_dir):
    """Line items before and after a price change of one brand of rows, paired within their order.

    Orders repeat many times, so rows are paired by key and position.
    """
    lines = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    before = lines.select("l_orderkey", flag, "l_extendedprice")
    after = lines.select(
        "l_orderkey",
        flag,
        F.when((F.col("l_linenumber") == 7) & (flag == "R"), F.lit(0.0))
        .otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"),
    )
    return checks.differences(before, after, ["l_orderkey", "l_returnflag"])


# -- checks -------------------------------------------------------------------------------


def key_violations(spark, sf_dir):
    return checks.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphans(spark, sf_dir):
    """Line items whose order is not among the open ones."""
    open_orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    return checks.orphans(
        table(spark, sf_dir, "lineitem"), "l_orderkey", open_orders, "o_orderkey"
    )


def layout_integrity(spark, sf_dir):
    """Per declared key of both layouts: primary key violations and orphaned foreign keys."""
    t = layout(spark, sf_dir, "star") | layout(spark, sf_dir, "snow")
    primary = {
        "star_dim_category": "category_id", "star_dim_status": "status_id",
        "star_dim_date": "date_id", "star_fact_transactions": "transaction_id",
        "snow_dim_category_group": "group_id", "snow_dim_category": "category_id",
        "snow_dim_status": "status_id", "snow_dim_year": "year_id", "snow_dim_month": "month_id",
        "snow_dim_date": "date_id", "snow_fact_transactions": "transaction_id",
    }
    foreign = [
        ("snow_dim_category", "group_id", "snow_dim_category_group"),
        ("snow_dim_month", "year_id", "snow_dim_year"),
        ("snow_dim_date", "month_id", "snow_dim_month"),
    ] + [
        (f"{kind}_fact_transactions", f"{dim}_id", f"{kind}_dim_{dim}")
        for kind in ("star", "snow")
        for dim in ("category", "status", "date")
    ]
    broken = [
        (f"{name}.{key} unique", checks.key_violations(t[name], [key]))
        for name, key in primary.items()
    ] + [
        (f"{child}.{fk} references {parent}", checks.orphans(t[child], fk, t[parent], fk))
        for child, fk, parent in foreign
    ]
    return reduce(
        DataFrame.unionByName,
        [
            rows.agg(F.count("*").alias("broken")).select(F.lit(label).alias("constraint_name"), "broken")
            for label, rows in broken
        ],
    )


def broken_layout_integrity(spark, sf_dir):
    """A star whose status dimension lost a row and whose fact holds some transactions twice."""
    t = layout(spark, sf_dir, "star")
    fact = t["star_fact_transactions"]
    twice = fact.unionByName(fact.filter(F.col("transaction_id") % 10 == 0))
    statuses = t["star_dim_status"].filter(F.col("status_name") != "F")
    broken = {
        "fact.transaction_id unique": checks.key_violations(twice, ["transaction_id"]),
        "fact.status_id references status": checks.orphans(twice, "status_id", statuses, "status_id"),
    }
    return reduce(
        DataFrame.unionByName,
        [
            rows.agg(F.count("*").alias("broken")).select(F.lit(label).alias("constraint_name"), "broken")
            for label, rows in broken.items()
        ],
    )


def star_table_counts(spark, sf_dir):
    return table_counts(layout(spark, sf_dir, "star") | layout(spark, sf_dir, "snow"))


def rule_violations(spark, sf_dir):
    customer = checks.check_rules(
        table(spark, sf_dir, "customer"),
        [
            checks.not_null("c_name"), checks.max_length("c_mktsegment", 8),
            checks.precision("c_acctbal", 5, 2), checks.unique("c_name"),
            checks.unique("c_mktsegment"),
        ],
    )
    orders = checks.check_rules(
        table(spark, sf_dir, "orders"),
        [
            checks.not_null("o_orderpriority"), checks.max_length("o_orderpriority", 6),
            checks.precision("o_totalprice", 7, 2), checks.unique("o_custkey"),
        ],
    )
    return customer.unionByName(orders)


QUERIES = {
    "sum_by_category": sum_by_category,
    "filtered_count_mean": filtered_count_mean,
    "clustered_count_mean": clustered_count_mean,
    "clustered_range": clustered_range,
    "clustered_lookup": clustered_lookup,
    "incremental_daily_revenue": incremental_daily_revenue,
    "discounted_revenue": discounted_revenue,
    "csv_roundtrip_sum": csv_roundtrip_sum,
    "csv_filtered_count_mean": csv_filtered_count_mean,
    "csv_roundtrip_rows": csv_roundtrip_rows,
    "parquet_codec_sum": parquet_codec_sum,
    "storage_footprint": storage_footprint,
    "storage_rows": storage_rows,
    "parsed_timestamps": parsed_timestamps,
    "half_even_quantities": half_even_quantities,
    "broken_layout_integrity": broken_layout_integrity,
    "dim_category": _star("star_dim_category"),
    "dim_status": _star("star_dim_status"),
    "dim_date": _star("star_dim_date"),
    "dim_date_hour": dim_date_hour,
    "part_supplier_keys": part_supplier_keys,
    "fact_load": fact_load,
    "fact_unmatched": fact_unmatched,
    "load_guard": load_guard,
    "second_load_keys": second_load_keys,
    "second_load_fact": second_load_fact,
    "layout_refresh": layout_refresh,
    "snow_group": _snow("snow_dim_category_group"),
    "snow_category": _snow("snow_dim_category"),
    "snow_status": _snow("snow_dim_status"),
    "snow_year": _snow("snow_dim_year"),
    "snow_month": _snow("snow_dim_month"),
    "snow_date": _snow("snow_dim_date"),
    "q1_star": _question("q1", "star"),
    "q1_snow": _question("q1", "snow"),
    "q2_star": _question("q2", "star"),
    "q2_snow": _question("q2", "snow"),
    "q3_star": _question("q3", "star"),
    "q3_snow": _question("q3", "snow"),
    "layout_differences": layout_differences,
    "result_differences": result_differences,
    "repeated_key_differences": repeated_key_differences,
    "key_violations": key_violations,
    "orphans": orphans,
    "layout_integrity": layout_integrity,
    "table_counts": star_table_counts,
    "rule_violations": rule_violations,
}

# -- the same in SQL ----------------------------------------------------------------------

_SUM = f"""
SELECT category, {money('o_totalprice')} AS total_amount
FROM (SELECT o_orderpriority AS category, o_totalprice FROM orders) WHERE category IS NOT NULL
GROUP BY category
"""

_STATS = f"""
SELECT count(*) AS count, {money('o_totalprice')} / count(o_totalprice) AS mean_amount
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000
"""

_FACT = f"""WITH {TX}
SELECT transaction_id, user_id, category_id, status_id, date_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_ts, amount
FROM tx JOIN cat ON category = category_name JOIN stat ON status = status_name
     JOIN hours ON date_trunc('hour', ts) = h
"""

_DATE_COLUMNS = """CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month,
       CAST(day(h) AS INTEGER) AS day, CAST(hour(h) AS INTEGER) AS hour"""

_Q1 = f"""WITH {TX}
SELECT category AS category_name, status AS status_name, count(*) AS total_txns,
       {money('amount')} AS total_amount
FROM tx GROUP BY category, status ORDER BY 1, 2
"""

_Q2 = f"""WITH {TX}
SELECT category_group AS group_name, CAST(year(ts) AS INTEGER) AS year, {money('amount')} AS total_amount
FROM tx JOIN cat ON category = category_name GROUP BY 1, 2 ORDER BY 1, 2
"""


def _daily(status: str) -> str:
    return f"""
SELECT category_group AS group_name, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       count(*) AS total_txns, {money('amount')} AS total_amount
FROM tx JOIN cat ON category = category_name WHERE status = '{status}'
GROUP BY 1, 2, 3, 4
"""


_Q3 = f"WITH {TX} {_daily('F')} ORDER BY 1, 2, 3, 4"

# Values in the order of their keys: those of the first load, sorted, then those that the second one adds, sorted.
_TWO_LOADS = f"""WITH {TX},
named AS (
    SELECT transaction_id, ts < '1998-01-01' AND category <> '3-MEDIUM' AS older, category, status, date_trunc('hour', ts) AS h,
           CASE WHEN category IN ('1-URGENT', '2-HIGH') THEN 'Expedited'
                WHEN category IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Regular' ELSE 'Other' END AS grp
    FROM tx),
found AS (
    SELECT older, unnest([
        {{'dimension': 'category', 'value': category}}, {{'dimension': 'status', 'value': status}},
        {{'dimension': 'hour', 'value': strftime(h, '%Y-%m-%d %H:00')}}, {{'dimension': 'group', 'value': grp}},
        {{'dimension': 'year', 'value': strftime(h, '%Y')}}, {{'dimension': 'month', 'value': strftime(h, '%Y-%m')}}], recursive := true)
    FROM named),
keyed AS (
    SELECT dimension, value,
           CAST(row_number() OVER (PARTITION BY dimension ORDER BY first DESC, value) AS INTEGER) AS key
    FROM (SELECT dimension, value, bool_or(coalesce(older, false)) AS first FROM found WHERE value IS NOT NULL GROUP BY ALL))
"""

_EARLIER = f"""WITH {TX},
seen AS (SELECT * FROM tx WHERE status = 'F'),
flagged AS (
    SELECT category, status, date_trunc('hour', ts) AS h,
           category IN (SELECT category FROM seen) AS has_category,
           status IN (SELECT status FROM seen) AS has_status,
           date_trunc('hour', ts) IN (SELECT date_trunc('hour', ts) FROM seen) AS has_hour
    FROM tx)
"""

_CONSTRAINTS = [
    f"{name}.{key} unique"
    for name, key in [
        ("star_dim_category", "category_id"), ("star_dim_status", "status_id"),
        ("star_dim_date", "date_id"), ("star_fact_transactions", "transaction_id"),
        ("snow_dim_category_group", "group_id"), ("snow_dim_category", "category_id"),
        ("snow_dim_status", "status_id"), ("snow_dim_year", "year_id"),
        ("snow_dim_month", "month_id"), ("snow_dim_date", "date_id"),
        ("snow_fact_transactions", "transaction_id"),
    ]
] + [
    "snow_dim_category.group_id references snow_dim_category_group",
    "snow_dim_month.year_id references snow_dim_year",
    "snow_dim_date.month_id references snow_dim_month",
] + [
    f"{kind}_fact_transactions.{dim}_id references {kind}_dim_{dim}"
    for kind in ("star", "snow")
    for dim in ("category", "status", "date")
]


def _unique_rows(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, 'unique' AS rule, "
        f"count({column}) - count(DISTINCT {column}) AS rows FROM {source}"
    )


def _breaking_rows(column: str, rule: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE {condition}) AS rows FROM {source}"
    )


ORACLES = {
    "storage_rows": """
SELECT unnest(['csv', 'parquet_none', 'parquet_snappy', 'parquet_gzip']) AS table_name, n AS rows, true AS stored
FROM (SELECT count(*) AS n FROM orders)""",
    "parsed_timestamps": "SELECT event_id, ts FROM events",
    "half_even_quantities": """
SELECT l_quantity / 8 AS eighth, count(*) AS rows, round_even(l_quantity / 8, 2) AS rounded
FROM lineitem GROUP BY ALL""",
    "broken_layout_integrity": """
SELECT 'fact.transaction_id unique' AS constraint_name, count(*) AS broken FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT 'fact.status_id references status', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus = 'F'""",
    "discounted_revenue": """
SELECT l_returnflag, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE), 3) AS revenue
FROM lineitem GROUP BY l_returnflag""",
    "sum_by_category": _SUM,
    "csv_roundtrip_sum": _SUM,
    "filtered_count_mean": _STATS,
    "csv_filtered_count_mean": _STATS,
    "clustered_count_mean": _STATS,
    "clustered_range": """
SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 1000 AND 5000""",
    "clustered_lookup": """
SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount
FROM orders WHERE o_custkey IN (7, 77, 777)""",
    "incremental_daily_revenue": f"""
SELECT o_orderpriority AS category, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, count(*) AS transactions, {money('o_totalprice')} AS revenue
FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""",
    "csv_roundtrip_rows": """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_custkey AS user_id, o_totalprice AS amount,
       o_orderpriority AS category, o_orderstatus AS status, o_orderdate AS "timestamp" FROM orders
""",
    "parquet_codec_sum": f"SELECT s.*, codec FROM ({_SUM}) s, "
    "(SELECT unnest(['none', 'snappy', 'gzip']) AS codec)",
    "dim_category": f"WITH {TX} SELECT * FROM cat",
    "dim_status": f"WITH {TX} SELECT * FROM stat",
    "dim_date": f"""WITH {TX}
SELECT date_id, strftime(h, '%Y-%m-%d %H:00') AS date_hour, {_DATE_COLUMNS} FROM hours""",
    "dim_date_hour": f"""
SELECT CAST(row_number() OVER (ORDER BY h) AS INTEGER) AS date_id,
       strftime(h, '%Y-%m-%d %H:00') AS date_hour, {_DATE_COLUMNS}
FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)""",
    "part_supplier_keys": """
SELECT row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id, l_partkey, l_suppkey
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
    "fact_load": _FACT,
    "second_load_keys": f"{_TWO_LOADS} SELECT dimension, key, value FROM keyed",
    "second_load_fact": f"""{_TWO_LOADS}
SELECT transaction_id, user_id, c.key AS category_id, s.key AS status_id, d.key AS date_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_ts, amount
FROM tx JOIN keyed c ON c.dimension = 'category' AND category = c.value
     JOIN keyed s ON s.dimension = 'status' AND status = s.value
     JOIN keyed d ON d.dimension = 'hour' AND strftime(ts, '%Y-%m-%d %H:00') = d.value""",
    "layout_refresh": f"""WITH {TX},
counted AS (
    SELECT f, count(DISTINCT category) AS c, count(DISTINCT status) AS s, count(DISTINCT date_trunc('hour', ts)) AS h,
           count(*) FILTER (WHERE category IS NOT NULL AND status IS NOT NULL AND ts IS NOT NULL) AS n
    FROM (SELECT *, true AS f FROM tx WHERE status = 'F' UNION ALL SELECT *, false FROM tx) GROUP BY f),
long AS (
    SELECT f, unnest([{{'table_name': 'star_dim_category', 'rows': c}}, {{'table_name': 'star_dim_status', 'rows': s}},
                      {{'table_name': 'star_dim_date', 'rows': h}}, {{'table_name': 'star_fact_transactions', 'rows': n}}], recursive := true)
    FROM counted)
SELECT table_name, rows, state FROM long JOIN (VALUES (true, 'stored'), (true, 'failed refresh'), (false, 'refreshed')) v(f, state) USING (f)""",
    "fact_unmatched": f"""{_EARLIER}
SELECT 'category' AS dimension, category AS value, count(*) AS rows FROM flagged
WHERE NOT has_category GROUP BY category
UNION ALL
SELECT 'status', status, count(*) FROM flagged WHERE NOT has_status GROUP BY status
UNION ALL
SELECT 'hour', strftime(h, '%Y-%m-%d %H:00'), count(*) FROM flagged WHERE NOT has_hour GROUP BY h""",
    "load_guard": f"""{_EARLIER}
SELECT count(*) AS source_rows, count(*) AS loaded_rows, true AS ok, 'whole' AS load FROM flagged
UNION ALL
SELECT count(*), count(*) FILTER (WHERE has_category AND has_status AND has_hour),
       bool_and(has_category AND has_status AND has_hour), 'stale_dimensions' FROM flagged""",
    "snow_group": f"WITH {TX} SELECT * FROM grp",
    "snow_category": f"""WITH {TX}
SELECT category_id, category_name, group_id FROM cat JOIN grp ON category_group = group_name""",
    "snow_status": f"WITH {TX} SELECT * FROM stat",
    "snow_year": f"WITH {TX} SELECT * FROM yr",
    "snow_month": f"""WITH {TX}
SELECT month_id, m AS month_val, year_id FROM mon JOIN yr ON y = year_val""",
    "snow_date": f"""WITH {TX}
SELECT date_id, strftime(h, '%Y-%m-%d %H:00') AS date_hour, CAST(day(h) AS INTEGER) AS day,
       CAST(hour(h) AS INTEGER) AS hour, month_id
FROM hours JOIN mon ON year(h) = y AND month(h) = m""",
    "q1_star": _Q1,
    "q1_snow": _Q1,
    "q2_star": _Q2,
    "q2_snow": _Q2,
    "q3_star": _Q3,
    "q3_snow": _Q3,
    "layout_differences": f"""WITH {TX}
SELECT 'q1' AS question, count(*) AS compared, CAST(0 AS BIGINT) AS differing
FROM (SELECT DISTINCT category, status FROM tx)
UNION ALL
SELECT 'q2', count(*), CAST(0 AS BIGINT)
FROM (SELECT DISTINCT category_group, year(ts) FROM tx JOIN cat ON category = category_name)
UNION ALL
SELECT 'q3', count(*), CAST(0 AS BIGINT)
FROM (SELECT DISTINCT category_group, CAST(ts AS DATE) FROM tx JOIN cat ON category = category_name
      WHERE status = 'F')""",
    "result_differences": f"""WITH {TX}, a AS ({_daily('F')}), b AS ({_daily('P')})
SELECT COALESCE(a.group_name, b.group_name) AS group_name, COALESCE(a.year, b.year) AS year,
       COALESCE(a.month, b.month) AS month, COALESCE(a.day, b.day) AS day,
       CASE WHEN b.year IS NULL THEN 'left_only' WHEN a.year IS NULL THEN 'right_only' ELSE 'both' END AS side,
       a.total_txns AS total_txns_left, a.total_amount AS total_amount_left,
       b.total_txns AS total_txns_right, b.total_amount AS total_amount_right
FROM a FULL OUTER JOIN b ON a.group_name = b.group_name AND a.year = b.year
     AND a.month = b.month AND a.day = b.day
WHERE a.year IS NULL OR b.year IS NULL OR a.total_txns <> b.total_txns
      OR abs(a.total_amount - b.total_amount) > 1e-9 * abs(b.total_amount)""",
    "repeated_key_differences": """WITH a AS (
    SELECT l_orderkey, l_returnflag, l_extendedprice AS price,
           row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_extendedprice) AS rn
    FROM lineitem),
b AS (
    SELECT l_orderkey, l_returnflag, price,
           row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY price) AS rn
    FROM (SELECT l_orderkey, l_returnflag,
                 CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 0.0::DOUBLE
                      ELSE l_extendedprice END AS price FROM lineitem))
SELECT a.l_orderkey, a.l_returnflag, 'both' AS side, a.price AS l_extendedprice_left,
       b.price AS l_extendedprice_right
FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag AND a.rn = b.rn
WHERE abs(a.price - b.price) > 1e-9 * abs(b.price)""",
    "key_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS rows, 'duplicate' AS problem
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "orphans": """
SELECT l_orderkey, count(*) AS child_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
GROUP BY l_orderkey""",
    "layout_integrity": "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in _CONSTRAINTS)
    + "]) AS constraint_name, CAST(0 AS BIGINT) AS broken",
    "table_counts": f"""WITH {TX}
SELECT * FROM (
    SELECT 'star_dim_category' AS table_name, count(*) AS rows FROM cat
    UNION ALL SELECT 'star_dim_status', count(*) FROM stat
    UNION ALL SELECT 'star_dim_date', count(*) FROM hours
    UNION ALL SELECT 'star_fact_transactions', count(*) FROM tx
    UNION ALL SELECT 'snow_dim_category_group', count(*) FROM grp
    UNION ALL SELECT 'snow_dim_category', count(*) FROM cat
    UNION ALL SELECT 'snow_dim_status', count(*) FROM stat
    UNION ALL SELECT 'snow_dim_year', count(*) FROM yr
    UNION ALL SELECT 'snow_dim_month', count(*) FROM mon
    UNION ALL SELECT 'snow_dim_date', count(*) FROM hours
    UNION ALL SELECT 'snow_fact_transactions', count(*) FROM tx) ORDER BY table_name""",
    "rule_violations": " UNION ALL ".join(
        [
            _breaking_rows("c_name", "not_null", "c_name IS NULL", "customer"),
            _breaking_rows("c_mktsegment", "max_length", "length(c_mktsegment) > 8", "customer"),
            _breaking_rows("c_acctbal", "precision", "TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL", "customer"),
            _unique_rows("c_name", "customer"),
            _unique_rows("c_mktsegment", "customer"),
            _breaking_rows("o_orderpriority", "not_null", "o_orderpriority IS NULL", "orders"),
            _breaking_rows("o_orderpriority", "max_length", "length(o_orderpriority) > 6", "orders"),
            _breaking_rows("o_totalprice", "precision", "TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL", "orders"),
            _unique_rows("o_custkey", "orders"),
        ]
    ),
}
