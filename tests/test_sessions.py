"""Layouts agree with each other and with brute force, also under skew."""

import random

import pytest
from plans import exchanges

from millrace.operators import profile, sessions

PARTITIONS = 6


def log(seed=3, hot_user=0, hot_session=0):
    rng = random.Random(seed)
    data = [
        (f"u{rng.randrange(20)}", f"s{rng.randrange(60)}", rng.randrange(10**6)) for _ in range(800)
    ]
    data += [("whale", f"w{rng.randrange(200)}", rng.randrange(10**6)) for _ in range(hot_user)]
    data += [("u1", "endless", rng.randrange(10**6)) for _ in range(hot_session)]
    return data + [("single", "one", 5), (None, "s", 1), (None, "s", 4)]


LOGS = {
    "flat": log(),
    "hot_user": log(hot_user=2000),
    "hot_session": log(hot_session=2000),
}


def brute(data):
    times = {}
    for user, session, ms in data:
        times.setdefault((user, session), []).append(ms)
    return {k: max(v) - min(v) for k, v in times.items()}


@pytest.fixture(scope="module", params=sorted(LOGS))
def logs(spark, request):
    data = LOGS[request.param]
    df = spark.createDataFrame(data, "user_id string, session_id string, event_timestamp long")
    return data, df.repartition(5).persist()


@pytest.mark.parametrize("layout", sessions.LAYOUTS)
def test_durations(logs, layout):
    data, df = logs
    found = {
        (r["user_id"], r["session_id"]): r["duration_ms"]
        for r in sessions.session_durations(df, layout, PARTITIONS).collect()
    }
    assert found == brute(data)


@pytest.mark.parametrize("layout", sessions.LAYOUTS)
def test_no_task_gets_a_hot_group(spark, logs, layout):
    data, df = logs
    if layout == "default":
        return
    # Small data count as large, so that adaptive execution acts on them.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100b")
    try:
        events = sessions.laid_out(df, layout, 16)
        assert profile.partition_profile(events).first()["max_share"] < 0.35
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_user_metrics(logs):
    data, df = logs
    durations = brute(data)
    expected = {}
    for user in {u for u, _, _ in data}:
        mine = [d for (u, _), d in durations.items() if u == user]
        ms = [t for u, _, t in data if u == user]
        expected[user] = (len(mine), len(ms), sum(mine), max(mine), min(ms), max(ms), sum(mine) / len(mine))
    for metrics in (sessions.two_stage_user_metrics(df), sessions.isolate_hot_keys(df), sessions.isolate_hot_keys(df, 4)):
        found = {r["user_id"]: tuple(r)[1:] for r in metrics.collect()}
        assert found == expected


def test_hot_keys_break_ties_by_key(spark, rows):
    data = [("b", "1"), ("b", "2"), ("a", "3"), ("a", "4"), ("a", "4"), ("c", "5"), ("d", "6"), ("d", "7")]
    df = spark.createDataFrame(data, "user_id string, session_id string")
    top = [tuple(r) for r in sessions.hot_keys(df, k=2).collect()]
    assert top == [("a", 2, 2 / 7), ("b", 2, 2 / 7)]


@pytest.mark.parametrize("layout", sessions.LAYOUTS)
def test_exchanges(spark, layout):
    """One for the sessions, and one for the events where a layout moves them; no scan beforehand."""
    df = spark.range(100).selectExpr(
        "cast(id as string) user_id", "cast(id as string) session_id", "id as event_timestamp"
    )
    assert exchanges(sessions.session_durations(df, layout)) == (1 if layout == "default" else 2)
    assert exchanges(sessions.average_session_duration(df, layout)) == (2 if layout == "default" else 3)


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        sessions.session_durations(spark.createDataFrame([], "user_id string"), "sideways")


def test_profile_of_real_layouts(logs):
    data, df = logs
    for layout in sessions.LAYOUTS:
        found = profile.partition_profile(sessions.laid_out(df, layout, PARTITIONS)).first()
        assert round(found["max_rows"] / found["max_share"]) == df.count()
        assert found["max_to_median"] >= 1 and found["max_share"] * found["partitions"] >= 0.999


def test_profile_of_nothing(spark):
    empty = profile.partition_profile(spark.createDataFrame([], "a int")).first()
    assert empty["partitions"] == 0 and empty["max_rows"] is None and empty["max_share"] is None


def test_profile_counts_non_empty_partitions(spark):
    found = profile.partition_profile(spark.range(0, 3, 1, 8)).first()
    assert (found["partitions"], found["max_rows"], found["median_rows"]) == (3, 1, 1.0)
