"""Registered queries: sessions, skew, timing reports and generators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.inputs import LOGS, hot_logs, log_of, logs, table
from millrace.operators import aggregates, checks, partials, profile, sessions
from millrace.session import fresh_path, written
from millrace.sources import files, generators

PARTITIONS = 16


def session_durations(spark, sf_dir):
    return sessions.session_durations(logs(spark, sf_dir))


def _average(layout):
    return lambda spark, sf_dir: sessions.average_session_duration(logs(spark, sf_dir), layout, PARTITIONS)


def _hot_average(layout):
    return lambda spark, sf_dir: sessions.average_session_duration(
        hot_logs(spark, sf_dir), layout, PARTITIONS
    )


def incremental_sessions(spark, sf_dir):
    """Session durations from the states of three batches of events, over which most sessions are spread."""
    return partials.session_durations(spark, _session_batches(spark, sf_dir))


def incremental_session_average(spark, sf_dir):
    return partials.average_session_duration(spark, _session_batches(spark, sf_dir))


def _session_batches(spark, sf_dir) -> str:
    """Events in three batches; the first comes twice, and two are joined before the third comes."""
    root, events = fresh_path(spark, "sessions"), table(spark, sf_dir, "events")
    for batch_id, part in ((0, 0), (0, 0), (1, 1)):
        bounds = partials.session_bounds(log_of(events.filter(F.col("event_id") % 3 == part)))
        partials.add_batch(bounds, partials.SESSIONS, root, batch_id)
    partials.join_batches(spark, root, partials.SESSIONS)
    bounds = partials.session_bounds(log_of(events.filter(F.col("event_id") % 3 == 2)))
    partials.add_batch(bounds, partials.SESSIONS, root, 2)
    return root


def layout_agreement(spark, sf_dir):
    """Per layout: how many rows of its mean differ from the default's."""
    source = hot_logs(spark, sf_dir)

    def mean(layout):
        average = sessions.average_session_duration(source, layout, PARTITIONS)
        return average.select(F.lit(layout).alias("layout"), F.round("avg_duration_ms", 6).alias("mean_ms"))

    means = written(reduce(DataFrame.unionByName, [mean(layout) for layout in sessions.LAYOUTS]), "means")
    default = means.filter(F.col("layout") == "default").select("mean_ms")
    names = F.array(*[F.lit(layout) for layout in sessions.LAYOUTS])
    wrong = checks.differences(means, default.select(F.explode(names).alias("layout"), "mean_ms"), ["layout"], rtol=0.0)
    counted = wrong.groupBy("layout").agg(F.count("*").alias("n"))
    return means.select("layout").join(counted, "layout", "left").select("layout", F.coalesce("n", F.lit(0)).cast("bigint").alias("differing"))


def sessions_per_user(spark, sf_dir):
    return sessions.units_per_key(hot_logs(spark, sf_dir))


def hot_keys(spark, sf_dir):
    return sessions.hot_keys(hot_logs(spark, sf_dir))


def two_stage_user_metrics(spark, sf_dir):
    return sessions.two_stage_user_metrics(hot_logs(spark, sf_dir))


def isolate_hot_keys(spark, sf_dir):
    return sessions.isolate_hot_keys(hot_logs(spark, sf_dir))


def _profiles(spark, sf_dir) -> DataFrame:
    """The log as stored, and as each layout really places it."""
    source = hot_logs(spark, sf_dir)
    placed = {"as_stored": source} | {
        layout: sessions.laid_out(source, layout, PARTITIONS) for layout in sessions.LAYOUTS if layout != "default"
    }
    profiles = [profile.partition_profile(df).withColumn("layout", F.lit(name)) for name, df in placed.items()]
    return reduce(DataFrame.unionByName, profiles)


def partition_profile(spark, sf_dir):
    return _profiles(spark, sf_dir)


def partition_profile_rows(spark, sf_dir):
    """What holds for any placement: all rows are somewhere, and the largest partition is no smaller than the mean or the median."""
    found = _profiles(spark, sf_dir)
    return found.select(
        "layout", F.round(F.col("max_rows") / F.col("max_share")).cast("bigint").alias("rows"),
        (F.col("max_share") * F.col("partitions") >= 0.999999).alias("above_mean"), (F.col("max_to_median") >= 1).alias("above_median"),
    )


def layout_disagreement(spark, sf_dir):
    """Sessions whose duration differs when the events of one day are left out."""
    source = logs(spark, sf_dir)
    partial = source.filter(~F.col("session_id").endswith("07"))
    return checks.differences(
        sessions.session_durations(source), sessions.session_durations(partial, "by_key"), sessions.KEYS
    )


# -- timing reports -----------------------------------------------------------------------


def _samples(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("label"), F.col("value").alias("seconds")
    )


def _rounded(df, columns, digits=6):
    return df.select(
        *[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def timing_summary(spark, sf_dir):
    return _rounded(aggregates.timing_summary(_samples(spark, sf_dir)), ["median_seconds"])


def timing_summary_by_user(spark, sf_dir):
    """The same for very many labels: every user's samples."""
    samples = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("label"), F.col("value").alias("seconds")
    )
    return _rounded(aggregates.timing_summary(samples), ["median_seconds"])


def speedup_against(spark, sf_dir):
    report = aggregates.speedup_against(_samples(spark, sf_dir), "click")
    return _rounded(report, ["mean_seconds", "speedup", "ratio"])


def _timings(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.col("l_linenumber").alias("cores"),
        F.col("l_extendedprice").alias("seconds"),
    )


def fit_scaling(spark, sf_dir):
    fit = aggregates.fit_scaling(_timings(spark, sf_dir), "l_returnflag")
    return _rounded(fit, ["t_seq", "t_par", "p", "s_max"], 4)


def scaling_table(spark, sf_dir):
    report = aggregates.scaling_table(_timings(spark, sf_dir), "l_returnflag")
    measures = ["seconds", "speedup_measured", "speedup_model", "efficiency", "karp_flatt"]
    return _rounded(report, measures, 5)


# -- generators ---------------------------------------------------------------------------


def _ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


def gen_transactions(spark, sf_dir):
    return generators.transactions(_ids(spark, sf_dir))


def gen_session_log(spark, sf_dir):
    """Written evenly over 16 files and read back."""
    path = fresh_path(spark, "log")
    files.write_parquet(generators.session_log(_ids(spark, sf_dir)), path, files=16)
    return files.read_parquet(spark, path)


def log_files(spark, sf_dir):
    """The session log written evenly over 16 files and read back."""
    path = fresh_path(spark, "log")
    files.write_parquet(logs(spark, sf_dir), path, files=16)
    return files.read_parquet(spark, path)


def gen_session_log_skewed(spark, sf_dir):
    return generators.session_log(_ids(spark, sf_dir), hot_share=generators.HOT_SHARE)


def json_results(spark, sf_dir):
    """A result table written as JSON and read back."""
    path = fresh_path(spark, "json")
    files.write_json(sessions.session_durations(logs(spark, sf_dir)), path)
    return spark.read.schema("user_id string, session_id string, duration_ms bigint").json(path)


QUERIES = (
    {"session_durations": session_durations}
    | {f"session_average_{layout}": _average(layout) for layout in sessions.LAYOUTS}
    | {f"hot_session_average_{layout}": _hot_average(layout) for layout in sessions.LAYOUTS}
    | {
        "layout_agreement": layout_agreement,
        "incremental_sessions": incremental_sessions,
        "incremental_session_average": incremental_session_average,
        "sessions_per_user": sessions_per_user,
        "hot_keys": hot_keys,
        "two_stage_user_metrics": two_stage_user_metrics,
        "isolate_hot_keys": isolate_hot_keys,
        "partition_profile": partition_profile,
        "timing_summary": timing_summary,
        "timing_summary_sliced": timing_summary,
        "timing_summary_by_user": timing_summary_by_user,
        "speedup_against": speedup_against,
        "fit_scaling": fit_scaling,
        "scaling_table": scaling_table,
        "gen_transactions": gen_transactions,
        "gen_session_log": gen_session_log,
        "gen_session_log_skewed": gen_session_log_skewed,
        "log_files": log_files,
        "partition_profile_rows": partition_profile_rows,
        "layout_disagreement": layout_disagreement,
        "json_results": json_results,
    }
)

# -- the same in SQL ----------------------------------------------------------------------

_DURATIONS = """
SELECT user_id, session_id, max(event_timestamp) - min(event_timestamp) AS duration_ms
FROM {logs} GROUP BY user_id, session_id
"""


def _mean_sql(name: str) -> str:
    return f"""WITH {LOGS}
SELECT CAST(sum(duration_ms) AS DOUBLE) / count(*) AS avg_duration_ms, count(*) AS sessions
FROM ({_DURATIONS.format(logs=name)})"""


_USER_METRICS = f"""WITH {LOGS},
s AS (
    SELECT user_id, session_id, count(*) AS events, min(event_timestamp) AS first_ms,
           max(event_timestamp) AS last_ms, max(event_timestamp) - min(event_timestamp) AS duration_ms
    FROM hot_logs GROUP BY user_id, session_id)
SELECT user_id, count(*) AS sessions, CAST(sum(events) AS BIGINT) AS events,
       CAST(sum(duration_ms) AS BIGINT) AS duration_ms, max(duration_ms) AS longest_ms,
       min(first_ms) AS first_ms, max(last_ms) AS last_ms,
       CAST(sum(duration_ms) AS DOUBLE) / count(*) AS avg_duration_ms
FROM s GROUP BY user_id"""

_SUMMARY = """
SELECT event_type AS label, round(median(value), 6) AS median_seconds, min(value) AS min_seconds,
       max(value) AS max_seconds, count(value) AS runs
FROM events GROUP BY event_type"""

_FIT = """
parts AS (
    SELECT l_returnflag,
           greatest(regr_intercept(l_extendedprice, 1.0 / l_linenumber), 0.0) AS t_seq,
           greatest(regr_slope(l_extendedprice, 1.0 / l_linenumber), 0.0) AS t_par
    FROM (SELECT l_returnflag, l_extendedprice, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem)
    GROUP BY l_returnflag),
fit AS (
    SELECT *, CASE WHEN t_seq + t_par <> 0 THEN t_par / (t_seq + t_par) END AS p FROM parts)
"""


def _mix_sql(value: str, stream: int) -> str:
    start = f"((({value}) % 2147483647 * 48271 + {stream * 7919 + 1}) % 2147483647)"
    squared = f"(({start} * {start} + {stream * 104729}) % 2147483647)"
    return f"(({squared} * 69621 + 12345) % 2147483647)"


def _log_sql(user: str) -> str:
    return f"""
WITH sess AS (
    SELECT o_orderkey AS id, {user} AS user_id,
           'sess_' || CAST(o_orderkey AS VARCHAR) AS session_id,
           2 + {_mix_sql('o_orderkey', 12)} % 19 AS n_events,
           1700000000000 + ({_mix_sql('o_orderkey', 13)} * 2147483647
               + {_mix_sql('o_orderkey', 14)}) % 2592000000 AS start_ms,
           {_mix_sql('o_orderkey', 15)} % 7200000 AS length_ms
    FROM orders),
ev AS (SELECT *, unnest(range(1, n_events + 1)) AS k FROM sess)
SELECT user_id, session_id,
       start_ms + {_mix_sql('id * 21 + k', 16)} * length_ms // 2147483647 AS event_timestamp
FROM ev"""


_REGULAR_USER = f"'user_' || CAST({_mix_sql('o_orderkey', 11)} % 50000 AS VARCHAR)"
_HOT_USER = (
    f"CASE WHEN {_mix_sql('o_orderkey', 17)} < {int(0.9 * 2147483647)} THEN 'user_whale' "
    f"ELSE {_REGULAR_USER} END"
)

ORACLES = (
    {"session_durations": f"WITH {LOGS} {_DURATIONS.format(logs='logs')}"}
    | {f"session_average_{layout}": _mean_sql("logs") for layout in sessions.LAYOUTS}
    | {f"hot_session_average_{layout}": _mean_sql("hot_logs") for layout in sessions.LAYOUTS}
    | {
        "layout_agreement": "SELECT unnest(["
        + ", ".join(f"'{layout}'" for layout in sessions.LAYOUTS)
        + "]) AS layout, CAST(0 AS BIGINT) AS differing",
        "sessions_per_user": f"""WITH {LOGS}
SELECT user_id, count(DISTINCT session_id) AS units FROM hot_logs GROUP BY user_id""",
        "hot_keys": f"""WITH {LOGS},
u AS (SELECT user_id, count(DISTINCT session_id) AS units FROM hot_logs GROUP BY user_id)
SELECT user_id, units, CAST(units AS DOUBLE) / (SELECT sum(units) FROM u) AS share
FROM u ORDER BY units DESC, user_id LIMIT 3""",
        "two_stage_user_metrics": _USER_METRICS,
        "isolate_hot_keys": _USER_METRICS,
        "timing_summary": _SUMMARY,
        "timing_summary_sliced": _SUMMARY,
        "timing_summary_by_user": _SUMMARY.replace("event_type", "user_id"),
        "speedup_against": """
WITH m AS (SELECT event_type AS label, avg(value) AS mean_seconds FROM events GROUP BY event_type),
b AS (SELECT mean_seconds AS base FROM m WHERE label = 'click')
SELECT label, round(mean_seconds, 6) AS mean_seconds, round(base / mean_seconds, 6) AS speedup,
       round(mean_seconds / base, 6) AS ratio
FROM m, b""",
        "fit_scaling": f"""WITH {_FIT}
SELECT l_returnflag, round(t_seq, 4) AS t_seq, round(t_par, 4) AS t_par, round(p, 4) AS p,
       round(CASE WHEN p < 1 THEN 1 / (1 - p) WHEN p = 1 THEN CAST('infinity' AS DOUBLE) END, 4) AS s_max
FROM fit""",
        "scaling_table": f"""WITH {_FIT},
t AS (
    SELECT l_returnflag, l_linenumber AS cores, avg(l_extendedprice) AS seconds
    FROM lineitem GROUP BY 1, 2),
one AS (SELECT l_returnflag, seconds AS single FROM t WHERE cores = 1),
j AS (
    SELECT t.l_returnflag, CAST(cores AS DOUBLE) AS n, cores, seconds, single / seconds AS s, p
    FROM t LEFT JOIN one USING (l_returnflag) JOIN fit USING (l_returnflag))
SELECT l_returnflag, cores, round(seconds, 5) AS seconds, round(s, 5) AS speedup_measured,
       round(1 / ((1 - p) + p / n), 5) AS speedup_model, round(s / n, 5) AS efficiency,
       round(CASE WHEN cores > 1 THEN (1 / s - 1 / n) / (1 - 1 / n) END, 5) AS karp_flatt
FROM j""",
        "gen_transactions": f"""
SELECT 'TXN_' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS transaction_id,
       1000 + {_mix_sql('o_orderkey', 1)} % 8999 AS user_id,
       (500 + {_mix_sql('o_orderkey', 2)} % 499501) / CAST(100.0 AS DOUBLE) AS amount,
       list_extract(['Groceries', 'Electronics', 'Clothing', 'Travel', 'Entertainment'],
                    {_mix_sql('o_orderkey', 3)} % 5 + 1) AS category,
       list_extract(['COMPLETED', 'PENDING', 'FAILED', 'REFUNDED'],
                    {_mix_sql('o_orderkey', 4)} % 4 + 1) AS status,
       TIMESTAMP '2025-01-01 00:00:00' + to_seconds(o_orderkey) AS "timestamp"
FROM orders""",
        "gen_session_log": _log_sql(_REGULAR_USER),
        "gen_session_log_skewed": _log_sql(_HOT_USER),
        "json_results": f"WITH {LOGS} {_DURATIONS.format(logs='logs')}",
        "log_files": f"WITH {LOGS} SELECT * FROM logs",
        "partition_profile_rows": """
SELECT unnest(['as_stored', 'round_robin', 'by_key', 'by_user', 'salted']) AS layout, count(*) AS rows,
       true AS above_mean, true AS above_median FROM events""",
        "incremental_sessions": f"""WITH {LOGS}
SELECT user_id, session_id, count(*) AS events, max(event_timestamp) - min(event_timestamp) AS duration_ms
FROM logs GROUP BY user_id, session_id""",
        "incremental_session_average": _mean_sql("logs"),
        "layout_disagreement": f"""WITH {LOGS}, s AS ({_DURATIONS.format(logs='logs')})
SELECT user_id, session_id, 'left_only' AS side, duration_ms AS duration_ms_left,
       CAST(NULL AS BIGINT) AS duration_ms_right FROM s WHERE session_id LIKE '%07'""",
    }
)
