"""The inputs of the registered queries, derived from the given tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_millis
from millrace.session import written
from millrace.sources.files import fingerprint

GROUPS = {
    "1-URGENT": "Expedited",
    "2-HIGH": "Expedited",
    "3-MEDIUM": "Regular",
    "4-NOT SPECIFIED": "Regular",
}


# Declared, so that opening a table needs no job that reads footers first.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# -- transactions -------------------------------------------------------------------------


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions; one of the five categories is left out of GROUPS."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("timestamp"),
    )


TX = """
tx AS (
    SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount,
           o_orderpriority AS category, o_orderstatus AS status, o_orderdate AS ts
    FROM orders),
cat AS (
    SELECT CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS category_id,
           category AS category_name,
           CASE WHEN category IN ('1-URGENT', '2-HIGH') THEN 'Expedited'
                WHEN category IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Regular'
                ELSE 'Other' END AS category_group
    FROM (SELECT DISTINCT category FROM tx WHERE category IS NOT NULL)),
stat AS (
    SELECT CAST(row_number() OVER (ORDER BY status) AS INTEGER) AS status_id,
           status AS status_name
    FROM (SELECT DISTINCT status FROM tx WHERE status IS NOT NULL)),
hours AS (
    SELECT CAST(row_number() OVER (ORDER BY h) AS INTEGER) AS date_id, h
    FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM tx WHERE ts IS NOT NULL)),
grp AS (
    SELECT CAST(row_number() OVER (ORDER BY group_name) AS INTEGER) AS group_id, group_name
    FROM (SELECT DISTINCT category_group AS group_name FROM cat)),
yr AS (
    SELECT CAST(row_number() OVER (ORDER BY year_val) AS INTEGER) AS year_id, year_val
    FROM (SELECT DISTINCT CAST(year(h) AS INTEGER) AS year_val FROM hours)),
mon AS (
    SELECT CAST(row_number() OVER (ORDER BY y, m) AS INTEGER) AS month_id, y, m
    FROM (SELECT DISTINCT CAST(year(h) AS INTEGER) AS y, CAST(month(h) AS INTEGER) AS m FROM hours))
"""


def money(value: str) -> str:
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,2))) AS DOUBLE)"


# -- session logs -------------------------------------------------------------------------


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a session log: one session per user and day."""
    return log_of(table(spark, sf_dir, "events"))


def log_of(events: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    return events.select(
        user.alias("user_id"),
        F.concat(user, F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        epoch_millis("ts").alias("event_timestamp"),
    )


def hot_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions, nine of ten moved to one user."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    moved = (F.col("user_id") * 7 + F.dayofmonth("ts")) % 10 < 9
    return events.select(
        F.when(moved, F.lit("whale")).otherwise(user).alias("user_id"),
        F.concat(user, F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        epoch_millis("ts").alias("event_timestamp"),
    )


LOGS = """
logs AS (
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
           CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS event_timestamp
    FROM events),
hot_logs AS (
    SELECT CASE WHEN (user_id * 7 + day(ts)) % 10 < 9 THEN 'whale'
                ELSE CAST(user_id AS VARCHAR) END AS user_id,
           CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
           CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS event_timestamp
    FROM events)
"""

# -- sensor feed --------------------------------------------------------------------------


# Feeds written by this application, by the files they were made from.
_feeds: dict[tuple, DataFrame] = {}


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of `sf_dir`: written once for the files there, and then read like a source table."""
    source = f"{sf_dir}/events.parquet"
    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, source))
    if key not in _feeds:
        _feeds[key] = written(derived_feed(spark, sf_dir).hint("rebalance"), "feed")
    return _feeds[key]


def derived_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON sensor records: every reason, both sides of each bound, one of five delivered twice.

    The first half of the month is batch 0. Of the second deliveries half come in the batch of
    the first one, the others in batch 1. All records of one kind share the empty id.
    """
    e = table(spark, sf_dir, "events")
    number, kind = F.col("event_id"), F.col("event_id") % 30

    def decimal(cents):
        return F.concat(
            F.floor(cents / 100).cast("string"),
            F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
        )

    def member(name, text, missing=None):
        pair = F.concat(F.lit(f'"{name}":'), text)
        return pair if missing is None else F.when(kind != missing, pair)

    cents = F.round(F.col("value") * 100).cast("long") % 4500 + 1500
    record_id = (
        F.when(kind == 12, F.lit("null"))
        .when(kind == 13, number.cast("string"))
        .when(kind == 14, F.lit('""'))
        .otherwise(F.concat(F.lit('"rec-'), number.cast("string"), F.lit('"')))
    )
    timestamp = F.when(kind == 8, F.lit('"yesterday"')).otherwise(
        F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"'))
    )
    sensor = F.when(kind == 11, F.lit('""')).otherwise(
        F.concat(F.lit('"probe-'), (F.col("user_id") % 5 + 1).cast("string"), F.lit('"'))
    )
    temperature = (
        F.when(kind == 5, F.lit("null"))
        .when(kind == 6, F.lit('"warm"'))
        .when(kind == 7, F.lit("480.25"))
        .when(kind == 15, F.lit("-50"))
        .when(kind == 19, F.lit("-50.01"))
        .when(kind == 23, F.lit("100"))
        .when(kind == 24, F.lit("100.01"))
        .otherwise(decimal(cents))
    )
    humidity = (
        F.when(kind == 9, F.lit("true"))
        .when(kind == 10, F.lit("100.01"))
        .when(kind == 16, F.lit("100"))
        .when(kind == 20, F.lit("-0.01"))
        .when(kind == 21, F.lit("null"))
        .when(kind == 22, F.lit("0"))
        .otherwise(decimal(number % 4001 + 4000))
    )
    record = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            member("record_id", record_id, missing=17),
            member("timestamp", timestamp, missing=18),
            member("sensor_id", sensor, missing=3),
            member("temperature", temperature, missing=4),
            member("humidity", humidity, missing=2),
        ),
        F.lit("}"),
    )
    raw = (
        F.when(kind == 0, F.concat(F.lit("not json {"), number.cast("string")))
        .when(kind == 1, F.concat(F.lit("["), number.cast("string"), F.lit(",2]")))
        .otherwise(record)
    )
    first_batch = F.when(F.dayofmonth("ts") <= 15, 0).otherwise(1)
    copies = F.when(number % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    batch = F.when((F.col("copy") == 0) | (number % 10 == 0), F.col("first_batch")).otherwise(1)
    return (
        e.select("event_id", raw.alias("raw"), first_batch.alias("first_batch"), F.explode(copies).alias("copy"))
        .withColumn("batch_id", batch.cast("long"))
        .select(
            "raw",
            "batch_id",
            (F.col("batch_id") * 1_000_000_000_000_000 + number * 2 + F.col("copy") * 41).alias("arrival_seq"),
        )
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a fetch for its batch that fails `event_id % 6` times before it succeeds."""
    fails = F.col("event_id") % 6
    tries = F.sequence(F.lit(1), F.least(fails + 1, F.lit(4)).cast("int"))
    rows = table(spark, sf_dir, "events").select(
        F.when(F.dayofmonth("ts") <= 15, 0).otherwise(1).cast("long").alias("batch_id"),
        fails.alias("fails"),
        F.explode(tries).alias("attempt"),
    )
    return rows.select("batch_id", "attempt", (F.col("attempt") > F.col("fails")).alias("ok"))


def _decimal_sql(cents: str) -> str:
    return (
        f"CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0')"
    )


FEED = f"""
made AS (
    SELECT event_id,
           CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS first_batch,
           CASE event_id % 30
           WHEN 0 THEN 'not json {{' || CAST(event_id AS VARCHAR)
           WHEN 1 THEN '[' || CAST(event_id AS VARCHAR) || ',2]'
           ELSE '{{' || concat_ws(',',
               CASE WHEN event_id % 30 <> 17 THEN '"record_id":' || CASE event_id % 30 WHEN 12 THEN 'null'
                   WHEN 13 THEN CAST(event_id AS VARCHAR) WHEN 14 THEN '""'
                   ELSE '"rec-' || CAST(event_id AS VARCHAR) || '"' END END,
               CASE WHEN event_id % 30 <> 18 THEN '"timestamp":' || CASE event_id % 30 WHEN 8 THEN '"yesterday"'
                   ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"' END END,
               CASE WHEN event_id % 30 <> 3 THEN '"sensor_id":' || CASE event_id % 30 WHEN 11 THEN '""'
                   ELSE '"probe-' || CAST(user_id % 5 + 1 AS VARCHAR) || '"' END END,
               CASE WHEN event_id % 30 <> 4 THEN '"temperature":' || CASE event_id % 30
                   WHEN 5 THEN 'null' WHEN 6 THEN '"warm"' WHEN 7 THEN '480.25' WHEN 15 THEN '-50'
                   WHEN 19 THEN '-50.01' WHEN 23 THEN '100' WHEN 24 THEN '100.01'
                   ELSE {_decimal_sql("CAST(round(value * 100) AS BIGINT) % 4500 + 1500")} END END,
               CASE WHEN event_id % 30 <> 2 THEN '"humidity":' || CASE event_id % 30
                   WHEN 9 THEN 'true' WHEN 10 THEN '100.01' WHEN 16 THEN '100'
                   WHEN 20 THEN '-0.01' WHEN 21 THEN 'null' WHEN 22 THEN '0'
                   ELSE {_decimal_sql("event_id % 4001 + 4000")} END END
               ) || '}}' END AS raw
    FROM events),
delivered AS (
    SELECT event_id, raw, first_batch, 0 AS copy FROM made
    UNION ALL
    SELECT event_id, raw, first_batch, 1 AS copy FROM made WHERE event_id % 5 = 0),
numbered AS (
    SELECT *, CAST(CASE WHEN copy = 0 OR event_id % 10 = 0 THEN first_batch ELSE 1 END AS BIGINT) AS batch_id
    FROM delivered),
feed AS (
    SELECT raw, batch_id, batch_id * 1000000000000000 + event_id * 2 + copy * 41 AS arrival_seq
    FROM numbered)
"""

JUDGED = """
parsed AS (SELECT *, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM feed),
typed AS (
    SELECT *, COALESCE(json_type(j) = 'OBJECT', false) AS is_object,
           json_type(j, '$.record_id') AS rid_type, json_type(j, '$.sensor_id') AS sensor_type,
           json_type(j, '$.timestamp') AS ts_type, json_type(j, '$.temperature') AS t_type,
           json_type(j, '$.humidity') AS h_type
    FROM parsed),
judged AS (
    SELECT raw, batch_id, arrival_seq, j,
           CASE WHEN is_object AND rid_type NOT IN ('NULL', 'ARRAY', 'OBJECT')
                THEN CAST(json_extract(j, '$.record_id') AS VARCHAR) END AS record_key,
           CASE WHEN NOT is_object THEN 'not_object'
                WHEN rid_type IS NULL THEN 'missing:record_id'
                WHEN ts_type IS NULL THEN 'missing:timestamp'
                WHEN sensor_type IS NULL THEN 'missing:sensor_id'
                WHEN t_type IS NULL THEN 'missing:temperature'
                WHEN h_type IS NULL THEN 'missing:humidity'
                WHEN rid_type <> 'VARCHAR' OR j->>'$.record_id' = '' THEN 'bad_record_id'
                WHEN sensor_type <> 'VARCHAR' OR j->>'$.sensor_id' = '' THEN 'bad_sensor_id'
                WHEN ts_type <> 'VARCHAR' OR TRY_CAST(j->>'$.timestamp' AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
                WHEN t_type = 'NULL' OR h_type = 'NULL' THEN 'null_measure'
                WHEN t_type NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'bad_type'
                WHEN h_type NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'bad_type'
                WHEN CAST(j->>'$.temperature' AS DOUBLE) NOT BETWEEN -50 AND 100 THEN 'temperature_range'
                WHEN CAST(j->>'$.humidity' AS DOUBLE) NOT BETWEEN 0 AND 100 THEN 'humidity_range'
           END AS reason_code,
           t_type IN ('BIGINT', 'UBIGINT', 'DOUBLE') AS t_number
    FROM typed),
verdict AS (
    SELECT * EXCLUDE (t_number),
           CAST(CASE reason_code
                WHEN 'bad_record_id' THEN json_extract(j, '$.record_id')
                WHEN 'bad_sensor_id' THEN json_extract(j, '$.sensor_id')
                WHEN 'bad_timestamp' THEN json_extract(j, '$.timestamp')
                WHEN 'bad_type' THEN CASE WHEN t_number THEN json_extract(j, '$.humidity')
                                          ELSE json_extract(j, '$.temperature') END
                WHEN 'temperature_range' THEN json_extract(j, '$.temperature')
                WHEN 'humidity_range' THEN json_extract(j, '$.humidity')
           END AS VARCHAR) AS reason_value
    FROM judged),
fresh AS (
    SELECT * FROM verdict WHERE record_key IS NULL
    UNION ALL
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY arrival_seq) AS rn
        FROM verdict WHERE record_key IS NOT NULL) WHERE rn = 1)
"""

ATTEMPTS = """
fetched AS (
    SELECT CAST(CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
           CAST(sum(least(event_id % 6, 3)) AS BIGINT) AS fetch_retries,
           CAST(sum(CAST(event_id % 6 >= 4 AS BIGINT)) AS BIGINT) AS fetch_failures
    FROM events GROUP BY ALL)
"""

CLEAN_FIELDS = """
    j->>'$.record_id' AS record_id, j->>'$.timestamp' AS "timestamp", j->>'$.sensor_id' AS sensor_id,
    CAST(j->>'$.temperature' AS DOUBLE) AS temperature, CAST(j->>'$.humidity' AS DOUBLE) AS humidity, raw
"""

# -- people -------------------------------------------------------------------------------


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the keyed table people(id, full_name, email, gpa)."""
    cents = F.round(F.abs("c_acctbal") * 100).cast("long") % 10000
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("email"),
        (cents / F.lit(100.0)).cast("decimal(5,2)").alias("gpa"),
    )


def newcomers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sign-ups: many per e-mail address, half of the addresses known already."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long") % 10000
    who = (F.col("o_custkey") * 2).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arrival_seq"),
        F.concat(F.lit("New "), who).alias("full_name"),
        F.concat(F.lit("c"), who, F.lit("@example.org")).alias("email"),
        (cents / F.lit(100.0)).cast("decimal(5,2)").alias("gpa"),
    )


def faulty_newcomers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign-ups with values that break rules: no name or a long one, no address, a mark too high."""
    kind = F.col("o_orderkey") % 50
    who = (F.col("o_custkey") * 2).cast("string")
    name = F.concat(F.lit("New "), who)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arrival_seq"),
        F.when(kind == 1, F.lit("n" * 101)).when(kind != 0, name).alias("full_name"),
        F.when(kind != 2, F.concat(F.lit("c"), who, F.lit("@example.org"))).alias("email"),
        F.when(kind == 3, F.lit(1000.0)).otherwise(F.lit(99.5)).alias("gpa"),
    )


def gpa_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes: many per person, some of them to NULL, some for unknown ids."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long") % 10000
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        (F.col("o_custkey") * 3 + 1).alias("id"),
        F.when(F.col("o_orderstatus") != "P", (cents / F.lit(100.0)).cast("decimal(5,2)")).alias("gpa"),
    )


def leavers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people behind urgent orders."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return urgent.select((F.col("o_custkey") + 1).alias("id"))


PEOPLE = """
people AS (
    SELECT c_custkey + 1 AS id, c_name AS full_name,
           'c' || CAST(c_custkey AS VARCHAR) || '@example.org' AS email,
           CAST(CAST(round(abs(c_acctbal) * 100) AS BIGINT) % 10000 / 100.0 AS DECIMAL(5,2)) AS gpa
    FROM customer),
newcomers AS (
    SELECT o_orderkey AS arrival_seq, 'New ' || CAST(o_custkey * 2 AS VARCHAR) AS full_name,
           'c' || CAST(o_custkey * 2 AS VARCHAR) || '@example.org' AS email,
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 10000 / 100.0 AS DECIMAL(5,2)) AS gpa
    FROM orders),
gpa_changes AS (
    SELECT o_orderkey AS seq, o_custkey * 3 + 1 AS id,
           CASE WHEN o_orderstatus <> 'P' THEN
               CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 10000 / 100.0 AS DECIMAL(5,2)) END AS gpa
    FROM orders),
faulty AS (
    SELECT o_orderkey AS arrival_seq,
           CASE o_orderkey % 50 WHEN 0 THEN NULL WHEN 1 THEN repeat('n', 101)
                ELSE 'New ' || CAST(o_custkey * 2 AS VARCHAR) END AS full_name,
           CASE WHEN o_orderkey % 50 <> 2 THEN 'c' || CAST(o_custkey * 2 AS VARCHAR) || '@example.org' END AS email,
           CASE WHEN o_orderkey % 50 = 3 THEN 1000.0 ELSE 99.5 END AS gpa
    FROM orders),
faulty_added AS (
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY arrival_seq) AS rn FROM faulty)
    WHERE email IS NULL OR (rn = 1 AND email NOT IN (SELECT email FROM people))),
leavers AS (SELECT o_custkey + 1 AS id FROM orders WHERE o_orderpriority = '1-URGENT'),
added AS (
    SELECT (SELECT max(id) FROM people) + arrival_seq + 1 AS id, full_name, email, gpa
    FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY arrival_seq) AS rn FROM newcomers)
    WHERE rn = 1 AND email NOT IN (SELECT email FROM people))
"""
