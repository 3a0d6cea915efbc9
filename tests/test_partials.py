"""Mergeable states, medians by selection, checksums of tables, and layouts that let scans skip."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks, ordering, partials
from millrace.operators.aggregates import timing_summary
from millrace.session import delete_folder
from millrace.sources import files

TX = "category string, status string, timestamp timestamp_ntz, amount double"


def amounts(spark, path, rows):
    """A batch that lies in files of its own."""
    day = F.make_timestamp_ntz(F.lit(2025), F.lit(1), F.col("d"), F.lit(3), F.lit(0), F.lit(0))
    data = spark.createDataFrame(rows, "category string, d int, amount double")
    data.select("category", F.lit("F").alias("status"), day.alias("timestamp"), "amount").write.parquet(path)
    return partials.daily_amounts(spark.read.parquet(path), 2)


def revenue(spark, root):
    return {(r["category"], r["day"].day): (r["transactions"], r["revenue"]) for r in partials.daily_revenue(spark, root, 2).collect()}


def test_batches_add_up_and_only_new_files_are_read(spark, root):
    for batch_id, rows in enumerate([[("a", 1, 0.1), ("a", 1, 0.2), ("b", 2, 5.0)], [("a", 1, 0.3)], [("b", 2, None), ("c", 3, -1.5)]]):
        path = f"{root}/in/{batch_id}"
        partials.add_batch(amounts(spark, path, rows), partials.DAILY_REVENUE, f"{root}/state", batch_id)
        delete_folder(spark, path)  # later batches and readers do without
    assert revenue(spark, f"{root}/state") == {("a", 1): (3, 0.6), ("b", 2): (2, 5.0), ("c", 3): (1, -1.5)}


def test_a_repeated_batch_replaces_itself(spark, root):
    first, again = amounts(spark, f"{root}/a", [("a", 1, 1.0)]), amounts(spark, f"{root}/b", [("a", 1, 2.0), ("a", 1, 2.0)])
    for batch in (first, first, again):
        partials.add_batch(batch, partials.DAILY_REVENUE, f"{root}/state", 7)
    assert revenue(spark, f"{root}/state") == {("a", 1): (2, 4.0)}
    partials.join_batches(spark, f"{root}/state", partials.DAILY_REVENUE)
    partials.join_batches(spark, f"{root}/state", partials.DAILY_REVENUE)
    with pytest.raises(ValueError):
        partials.add_batch(first, partials.DAILY_REVENUE, f"{root}/state", 7)
    partials.add_batch(first, partials.DAILY_REVENUE, f"{root}/state", 8)
    assert revenue(spark, f"{root}/state") == {("a", 1): (3, 5.0)}


def test_a_lost_batch_is_not_seen(spark, root, monkeypatch):
    first = amounts(spark, f"{root}/a", [("a", 1, 1.0)])
    partials.add_batch(first, partials.DAILY_REVENUE, f"{root}/state", 0)
    monkeypatch.setattr(partials.commits, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        partials.add_batch(first, partials.DAILY_REVENUE, f"{root}/state", 1)
    monkeypatch.undo()
    assert revenue(spark, f"{root}/state") == {("a", 1): (1, 1.0)}


def test_sessions_over_batches(spark, root, rows):
    events = [("u", "s", t) for t in (50, 10, 90)] + [("u", "t", 5)] + [("hot", "h", t) for t in range(200)]
    random.seed(2)
    random.shuffle(events)
    for batch_id in range(3):
        part = spark.createDataFrame(events[batch_id::3], "user_id string, session_id string, event_timestamp long")
        partials.add_batch(partials.session_bounds(part), partials.SESSIONS, root, batch_id)
    assert rows(partials.session_durations(spark, root)) == [("hot", "h", 200, 199), ("u", "s", 3, 80), ("u", "t", 1, 0)]
    assert rows(partials.average_session_duration(spark, root)) == [((199 + 80) / 3, 3)]
    with pytest.raises(FileNotFoundError):
        partials.session_durations(spark, f"{root}/none")


# -- medians --------------------------------------------------------------------------------


@pytest.mark.parametrize("make", [
    lambda r: r.random(), lambda r: 7.5 if r.random() < 0.9 else r.random() * 20, lambda r: float(r.randint(0, 3)), lambda r: r.lognormvariate(0, 5),
])
def test_medians_by_selection(spark, make):
    r = random.Random(4)
    data = [("big", make(r)) for _ in range(20_000)] + [(None, make(r)) for _ in range(4)] + [("one", make(r)), ("none", None)]
    data += [(f"l{i}", make(r)) for i in range(50) for _ in range(i % 5 + 1)]
    df = spark.createDataFrame(data, "label string, seconds double").repartition(5)
    wanted = {}
    for label, seconds in data:
        if seconds is not None:
            wanted.setdefault(label, []).append(seconds)
    got = {r["label"]: (r["median_seconds"], r["min_seconds"], r["max_seconds"], r["runs"]) for r in timing_summary(df).collect()}
    assert got == {k: (statistics.median(v), min(v), max(v), len(v)) for k, v in wanted.items()}


def test_only_what_is_near_the_median_is_put_in_order(spark, monkeypatch):
    sizes = []
    plain = ordering._in_ranges

    def counted(df, order_by):
        sizes.append(df.count())
        return plain(df, order_by)

    monkeypatch.setattr(ordering, "_in_ranges", counted)
    df = spark.range(50_000).select(F.lit("a").alias("label"), (F.col("id") * 7919 % 50_021).cast("double").alias("seconds"))
    got = timing_summary(df).first()
    values = sorted(float(i * 7919 % 50_021) for i in range(50_000))
    assert got["median_seconds"] == statistics.median(values)
    assert len(sizes) == 1 and sizes[0] < 500


def test_medians_with_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("a", 2.0), ("b", nan)], "label string, seconds double")
    got = {r["label"]: r for r in timing_summary(df).collect()}
    assert got["a"]["median_seconds"] == 2.0 and got["a"]["runs"] == 3
    assert got["b"]["median_seconds"] != got["b"]["median_seconds"]


# -- checksums ------------------------------------------------------------------------------


def pairs(spark, n, change=lambda i: None):
    return spark.createDataFrame([(i // 3, f"v{i}" if change(i) is None else change(i)) for i in range(n)], "k long, v string")


def test_equal_tables_are_told_by_checksums(spark, monkeypatch):
    a, b = pairs(spark, 3000), pairs(spark, 3000).repartition(7)
    assert checks.unlike(a, b, ["k"], "leaf") is None

    def moved(*args):
        raise AssertionError("rows of equal tables were put in order")

    monkeypatch.setattr(checks, "numbered_within", moved)
    assert checks.differences(a, b, ["k"]).count() == 0


def test_only_ranges_that_differ_are_compared(spark, monkeypatch):
    a, b = pairs(spark, 30_000), pairs(spark, 30_000, lambda i: "other" if i in (5, 20_000) else None)
    sizes, plain = [], checks.numbered_within
    monkeypatch.setattr(checks, "numbered_within", lambda df, *rest: (sizes.append(df.count()), plain(df, *rest))[1])
    found = {(r["k"], r["side"], r["v_left"], r["v_right"]) for r in checks.differences(a, b, ["k"]).collect()}
    assert {k for k, *_ in found} == {1, 6666}
    assert max(sizes) < 100


def test_moved_nulls_extra_rows_and_types(spark, rows):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "k int, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", None)], "k long, p string, q string")
    assert [r["k"] for r in checks.differences(a, b, ["k"]).collect()] == [1]
    assert checks.differences(b, b.union(b), ["k"]).count() == 2
    twice = b.union(b.filter("k = 2"))
    assert rows(checks.differences(twice, b, ["k"]), "k", "side") == [(2, "left_only")]
    floats = spark.createDataFrame([(1, 0.5)], "k int, x float"), spark.createDataFrame([(1, 0.5 + 1e-12)], "k long, x double")
    assert checks.differences(*floats, ["k"]).count() == 0
    empty = b.limit(0)
    assert checks.differences(empty, empty, ["k"]).count() == 0
    assert rows(checks.differences(empty, b, ["k"]), "k", "side") == [(1, "right_only"), (2, "right_only")]


# -- layouts that let scans skip ------------------------------------------------------------


def rows_read(df):
    """Rows that the scans of a query have handed out."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()  # runs the plan whose metrics are read
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_files_skip_row_groups(spark, root):
    df = spark.range(200_000).select(
        "id", F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (F.col("id") % 3 + 1).cast("int")).alias("status"),
        (F.col("id") * 7919 % 100_003).cast("double").alias("amount"), (F.col("id") * 31 % 50_000).alias("user_id"),
    )
    files.write_clustered(df, f"{root}/c", ["status", "amount"], ("user_id",), row_group_bytes=64 << 10)
    df.write.parquet(f"{root}/plain")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        narrow = (F.col("status") == "O") & F.col("amount").between(1000, 2000)
        one_user = F.col("user_id") == 777
        read = {name: [rows_read(spark.read.parquet(f"{root}/{name}").filter(f)) for f in (narrow, one_user)] for name in ("c", "plain")}
        for f in (narrow, one_user):
            same = [sorted(r["id"] for r in spark.read.parquet(f"{root}/{name}").filter(f).collect()) for name in ("c", "plain")]
            assert same[0] == same[1] and same[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["c"][0] < read["plain"][0] / 4
    assert read["c"][1] < read["plain"][1] / 2


def test_only_large_ranges_are_put_in_order(spark, monkeypatch):
    a = pairs(spark, 3000).union(spark.createDataFrame([(7, f"h{i % 50}") for i in range(900)] + [(None, "n")] * 3, "k long, v string"))
    b = pairs(spark, 3000, lambda i: "other" if i in (5, 21, 2000) else None).union(
        spark.createDataFrame([(7, f"h{i % 49}") for i in range(905)] + [(None, None)], "k long, v string")
    )

    def compared():
        return sorted(map(str, checks.differences(a, b, ["k"]).collect()))

    sizes, plain = [], checks.numbered_within
    monkeypatch.setattr(checks, "numbered_within", lambda df, *rest: (sizes.append(df.count()), plain(df, *rest))[1])
    by_key = compared()
    assert max(sizes) == 0
    sizes.clear()
    monkeypatch.setattr(checks, "MOST_ROWS", 100)
    assert compared() == by_key and sorted(sizes) == [903, 908]
    sizes.clear()
    monkeypatch.setattr(checks, "MOST_ROWS", 0)
    assert compared() == by_key and len(by_key) > 500 and min(sizes) > 908 - 8
    sizes.clear()
    wide = b.select(F.col("k").cast("decimal(20,2)").alias("k"), "v")
    assert checks.differences(a, wide, ["k"]).count() == len(by_key)
