"""Session durations under different data distributions, and relief for hot keys.

Input: logs(user_id, session_id, event_timestamp LONG ms).

`default` is the layout to run: Spark folds each session inside the map tasks, so one
exchange carries at most one row per session and task. The other layouts move the events
themselves first, fold them where they are, and are kept for comparison; all give the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import salt, share, with_salt
from millrace.session import written

KEYS = ["user_id", "session_id"]
LAYOUTS = ("default", "round_robin", "by_key", "by_user", "salted")
SALT_BUCKETS = 32


def hot_groups(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Keys that hold more than 1/parts of all rows. There are always fewer than `parts`."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*")).scalar()
    return counts.filter(F.col("rows") * parts > total).select(*keys)


def laid_out(df: DataFrame, layout: str, partitions: int | None = None, buckets: int = SALT_BUCKETS) -> DataFrame:
    """The events repartitioned for `layout`, over `partitions` (the session's number by default).

    By key, by user and salted, the events are rebalanced: adaptive execution cuts a partition that a
    hot user or session has filled into several, from the sizes it has seen, so no count of keys is
    needed beforehand. The rows are placed by a hash of the keys, not the keys themselves: a partition
    may be cut as long as nothing relies on finding a whole key in it.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "default":
        return df
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if layout == "round_robin":
        return df.repartition(partitions)
    if layout == "salted":
        df = with_salt(df, "session_id", buckets, "salt")
    by = {"by_key": KEYS, "by_user": ["user_id"], "salted": ["user_id", "salt"]}[layout]
    return df.withColumn("place", F.hash(*by)).hint("rebalance", partitions, "place").drop("place")


def session_durations(
    df: DataFrame, layout: str = "default", partitions: int | None = None, buckets: int = SALT_BUCKETS
) -> DataFrame:
    """(user_id, session_id, duration_ms): last minus first event; 0 for a single event."""
    events = laid_out(df, layout, partitions, buckets)
    duration = F.max("event_timestamp") - F.min("event_timestamp")
    return events.groupBy(*KEYS).agg(duration.alias("duration_ms"))


def average_session_duration(
    df: DataFrame, layout: str = "default", partitions: int | None = None
) -> DataFrame:
    """One row: mean duration and number of sessions."""
    return (
        session_durations(df, layout, partitions)
        .agg(F.sum("duration_ms").alias("total"), F.count("*").alias("sessions"))
        .select(share("total", "sessions").alias("avg_duration_ms"), "sessions")
    )


def units_per_key(df: DataFrame, key: str = "user_id", unit: str = "session_id") -> DataFrame:
    """Distinct units per key."""
    return df.select(key, unit).distinct().groupBy(key).agg(F.count("*").alias("units"))


def hot_keys(df: DataFrame, key: str = "user_id", unit: str = "session_id", k: int = 3) -> DataFrame:
    """The k keys with most units, and their share of all units. Ties go to the smaller key."""
    return _hottest(units_per_key(df, key, unit), key, k)


def _hottest(units: DataFrame, key: str, k: int) -> DataFrame:
    total = units.agg(F.sum("units")).scalar()
    top = units.orderBy(F.desc("units"), key).limit(k)
    return top.select(key, "units", share(F.col("units"), total).alias("share"))


def _sessions(df: DataFrame) -> DataFrame:
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    return df.groupBy(*KEYS).agg(
        F.count("*").alias("events"),
        (last - first).alias("duration_ms"),
        first.alias("first_ms"),
        last.alias("last_ms"),
    )


def _salted_user_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions with a salt, folded by (user, salt) and then by user."""
    partial = sessions.groupBy("user_id", "salt").agg(
        F.count("*").alias("sessions"),
        F.sum("events").alias("events"),
        F.sum("duration_ms").alias("duration_ms"),
        F.max("duration_ms").alias("longest_ms"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
    )
    return (
        partial.groupBy("user_id")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("events").alias("events"),
            F.sum("duration_ms").alias("duration_ms"),
            F.max("longest_ms").alias("longest_ms"),
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
        )
        .withColumn("avg_duration_ms", share("duration_ms", "sessions"))
    )


def two_stage_user_metrics(df: DataFrame, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Per user: sessions, events, durations. First by (user, salt of the session), then by user."""
    return _salted_user_metrics(with_salt(_sessions(df), "session_id", buckets))


def isolate_hot_keys(df: DataFrame, parts: int | None = None, buckets: int = SALT_BUCKETS) -> DataFrame:
    """The same metrics with every hot user salted; all others go in one step.

    Hot is a user with more than 1/parts of all sessions (the session's number of shuffle partitions by
    default), so there are fewer than `parts`, and their names are broadcast. Events are folded to
    sessions once and written, because the hot set and the metrics both need them.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sessions = written(_sessions(df), "sessions")
    hot = hot_groups(sessions, ["user_id"], parts).withColumn("is_hot", F.lit(True))
    joined = sessions.alias("s").join(
        F.broadcast(hot).alias("h"), F.col("s.user_id").eqNullSafe(F.col("h.user_id")), "left"
    )
    bucket = F.when(F.col("h.is_hot"), salt(F.col("s.session_id"), buckets)).otherwise(F.lit(0))
    return _salted_user_metrics(joined.select("s.*", bucket.alias("salt")))
