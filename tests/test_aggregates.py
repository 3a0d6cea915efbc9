"""Sums, means and the reports over timings."""

import statistics
from decimal import Decimal

from pyspark.sql import functions as F

import pytest

from millrace.functions.columns import exact_sum
from millrace.operators import aggregates


def test_sum_by(spark, rows):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("b", None), (None, 5.0), ("c", 1.0), ("c", None)], "k string, v double"
    )
    assert rows(aggregates.sum_by(df, "k", "v", digits=1)) == [("a", 0.3), ("b", 0.0), ("c", 1.0)]


def test_filtered_stats(spark):
    df = spark.createDataFrame(
        [("C", 1000.0), ("C", 1000.01), ("C", 1999.99), ("P", 5000.0), (None, 5000.0), ("C", None)],
        "status string, amount double",
    )
    wanted = (F.col("status") == "C") & (F.col("amount") > 1000)
    assert tuple(aggregates.filtered_stats(df, wanted, "amount").first()) == (2, 1500.0)
    nothing = aggregates.filtered_stats(df, F.col("status") == "X", "amount").first()
    assert tuple(nothing) == (0, None)
    unfiltered = aggregates.filtered_stats(df, F.col("status") == "C", "amount").first()
    assert unfiltered["count"] == 4


def test_table_counts(spark):
    tables = {"b": spark.range(3), "a": spark.range(0)}
    assert [tuple(r) for r in aggregates.table_counts(tables).collect()] == [("a", 0), ("b", 3)]


def test_timing_summary(spark):
    samples = {"even": [4.0, 1.0, 3.0, 2.0], "odd": [5.0, 1.0, 3.0], "one": [7.0], "same": [2.0] * 9 + [8.0]}
    data = [(k, v) for k, vs in samples.items() for v in vs] + [("odd", None), ("none", None)]
    df = spark.createDataFrame(data, "label string, seconds double").repartition(3)
    expected = {k: (statistics.median(v), min(v), max(v), len(v)) for k, v in samples.items()}
    for joined in ("true", "false"):  # one range, or as many as there are partitions
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
        found = {r["label"]: tuple(r)[1:] for r in aggregates.timing_summary(df).collect()}
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert found == expected


def test_speedup(spark, rows):
    df = spark.createDataFrame([("csv", 2.0), ("csv", 4.0), ("pq", 1.0), ("nil", 0.0)], "label string, seconds double")
    assert rows(aggregates.speedup_against(df, "csv")) == [
        ("csv", 3.0, 1.0, 1.0), ("nil", 0.0, None, 0.0), ("pq", 1.0, 3.0, 1 / 3),
    ]


def timings(spark, **runs):
    data = [(name, n, t) for name, points in runs.items() for n, t in points]
    return spark.createDataFrame(data, "job string, cores int, seconds double")


CORES = (1, 2, 4, 8)


def test_fit(spark):
    df = timings(
        spark,
        mixed=[(n, 1 + 8 / n) for n in CORES],
        worse=[(n, 1.0 + n) for n in CORES],
        perfect=[(n, 8 / n) for n in CORES],
        single=[(4, 3.0), (4, 4.0)],
        nothing=[(n, 0.0) for n in CORES],
    )
    fit = {r["job"]: r for r in aggregates.fit_scaling(df, "job").collect()}
    assert [round(fit["mixed"][c], 9) for c in ("t_seq", "t_par", "p", "s_max")] == [1, 8, round(8 / 9, 9), 9]
    assert fit["worse"]["t_par"] == 0 and fit["worse"]["p"] == 0 and fit["worse"]["s_max"] == 1
    assert round(fit["perfect"]["t_par"], 9) == 8 and fit["perfect"]["s_max"] > 1e9
    assert tuple(fit["single"])[1:] == (None,) * 4
    assert fit["nothing"]["p"] is None and fit["nothing"]["s_max"] is None


def test_scaling_table(spark):
    df = timings(spark, job=[(n, 1 + 8 / n) for n in CORES], alone=[(2, 5.0), (4, 3.0)])
    table = {(r["job"], r["cores"]): r for r in aggregates.scaling_table(df, "job").collect()}
    four = table[("job", 4)]
    assert round(four["speedup_measured"], 9) == 3 and round(four["speedup_model"], 9) == 3
    assert round(four["efficiency"], 9) == 0.75 and round(four["karp_flatt"], 9) == round(1 / 9, 9)
    assert table[("job", 1)]["karp_flatt"] is None
    assert table[("alone", 2)]["speedup_measured"] is None


def test_exact_sum(spark):
    values = [0.1, 0.2, 0.3, -0.01, 499978.59, -499978.58, 9_000_000_000_000.01, 0.1, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = sum(Decimal(str(v)) for v in values if v is not None)
    assert df.select(exact_sum("v", 2)).first()[0] == float(exact)
    negative = spark.createDataFrame([(-0.01,), (-5.55,)], "v double")
    assert negative.select(exact_sum("v", 2)).first()[0] == -5.56
    many = spark.range(1_000_000).select(F.lit(499_999.99).alias("v"))
    assert many.select(exact_sum("v", 2)).first()[0] == 499_999_990_000.0
    assert df.filter("v is null").select(exact_sum("v", 2)).first()[0] is None
    whole = spark.createDataFrame([(3,), (4,)], "v long")
    assert whole.select(exact_sum("v", 2)).first()[0] == 7.0


def test_exact_sum_of_any_doubles(spark):
    import math
    import random

    random.seed(1)
    cases = [[0.125, 0.004, 0.004, 0.004], [0.0011], [1e15, 1e-3, -1e15], [-5.55, -0.01], [1e-9] * 10, [2.0**60, 1.0, -(2.0**60)]]
    cases += [[random.uniform(-1, 1) * 10 ** random.randint(-4, 12) for _ in range(50)] for _ in range(30)]
    rows = [(i, v) for i, values in enumerate(cases) for v in values]
    df = spark.createDataFrame(rows, "i int, v double").repartition(5)
    found = {r["i"]: r["s"] for r in df.groupBy("i").agg(exact_sum("v").alias("s")).collect()}
    for i, values in enumerate(cases):
        assert math.isclose(found[i], math.fsum(values), rel_tol=1e-15, abs_tol=1e-18), values


def test_exact_sum_skips_nan_and_never_rounds(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", 1.5), ("a", nan), ("a", None), ("b", nan), ("c", inf), ("c", 1.0), ("d", inf), ("d", -inf)], "k string, v double")
    found = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert (found["a"], found["b"], found["c"]) == (1.5, None, inf) and found["d"] != found["d"]
    assert df.filter("k = 'a'").select(exact_sum("v", 1)).first()[0] == 1.5
    with pytest.raises(Exception, match="not an amount with 2 decimals"):
        spark.createDataFrame([(0.125,)], "v double").select(exact_sum("v", 2)).collect()
