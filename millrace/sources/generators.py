"""Generated transactions and session logs.

Every value is computed from the row's id with integers, so the same ids give the same rows
on any cluster and in any partition layout. `ids` is a DataFrame with a LONG column `id`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import mixed

# Transactions.
CATEGORIES = ["Groceries", "Electronics", "Clothing", "Travel", "Entertainment"]
STATUSES = ["COMPLETED", "PENDING", "FAILED", "REFUNDED"]
FIRST_USER, USER_BOUND = 1000, 9999
MIN_CENTS, MAX_CENTS = 500, 500_000
FIRST_SECOND_TEXT = "2025-01-01 00:00:00"
TRANSACTIONS = 1_000_000

# Session log.
SESSIONS = 400_000
USERS = 50_000
MIN_EVENTS, MAX_EVENTS = 2, 20
MAX_SESSION_MS = 2 * 60 * 60 * 1000
PERIOD_MS = 30 * 24 * 60 * 60 * 1000
BASE_TIMESTAMP_MS = 1_700_000_000_000
HOT_USER = "user_whale"
HOT_SHARE = 0.9

_MIX_RANGE = 2_147_483_647


def id_range(spark: SparkSession, n: int = TRANSACTIONS) -> DataFrame:
    """Ids 0 to n - 1; TRANSACTIONS and SESSIONS are the usual sizes."""
    return spark.range(n)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def transactions(ids: DataFrame) -> DataFrame:
    """One transaction per id, one second apart from 2025-01-01."""
    cents = MIN_CENTS + mixed("id", 2) % (MAX_CENTS - MIN_CENTS + 1)
    first = F.lit(FIRST_SECOND_TEXT).cast("timestamp_ntz")
    seconds = F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))
    return ids.select(
        F.format_string("TXN_%08d", "id").alias("transaction_id"),
        (FIRST_USER + mixed("id", 1) % (USER_BOUND - FIRST_USER)).alias("user_id"),
        (cents / F.lit(100.0)).alias("amount"),
        _pick(CATEGORIES, mixed("id", 3) % len(CATEGORIES)).alias("category"),
        _pick(STATUSES, mixed("id", 4) % len(STATUSES)).alias("status"),
        (first + seconds).alias("timestamp"),
    )


def session_log(
    ids: DataFrame, users: int = USERS, hot_share: float = 0.0, hot_user: str = HOT_USER
) -> DataFrame:
    """One session per id: 2 to 20 events of one user within two hours, over thirty days.

    With `hot_share`, that part of the sessions belongs to `hot_user`.
    """
    regular = F.concat(F.lit("user_"), (mixed("id", 11) % users).cast("string"))
    user = (
        F.when(mixed("id", 17) < int(hot_share * _MIX_RANGE), F.lit(hot_user)).otherwise(regular)
        if hot_share
        else regular
    )
    # Two mixes together cover the period, which is longer than the range of one.
    start = (mixed("id", 13) * _MIX_RANGE + mixed("id", 14)) % PERIOD_MS
    sessions = ids.select(
        "id",
        user.alias("user_id"),
        F.concat(F.lit("sess_"), F.col("id").cast("string")).alias("session_id"),
        (MIN_EVENTS + mixed("id", 12) % (MAX_EVENTS - MIN_EVENTS + 1)).cast("int").alias("n_events"),
        (F.lit(BASE_TIMESTAMP_MS) + start).alias("start_ms"),
        (mixed("id", 15) % MAX_SESSION_MS).alias("length_ms"),
    )
    events = sessions.withColumn("k", F.explode(F.sequence(F.lit(1), "n_events")))
    draw = mixed(F.col("id") * (MAX_EVENTS + 1) + F.col("k"), 16)
    offset = F.expr("draw * length_ms div " + str(_MIX_RANGE))
    return events.withColumn("draw", draw).select(
        "user_id", "session_id", (F.col("start_ms") + offset).alias("event_timestamp")
    )
