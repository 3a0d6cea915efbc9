"""Keys, references and differing results."""

from pyspark.sql import functions as F

from millrace.operators import checks


def test_key_violations(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b")], "k long, v string")
    assert rows(checks.key_violations(df, ["k"])) == [(None, 1, "null"), (1, 2, "duplicate")]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, None)], "id long, fk long")
    parent = spark.createDataFrame([(10,)], "pk long")
    assert rows(checks.orphans(child, "fk", parent, "pk")) == [(11, 2)]


def frames(spark, a, b, schema="k string, v double"):
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def test_equal_within_tolerance(spark):
    a, b = frames(spark, [("x", 1.0), ("y", None), (None, 3.0)], [("x", 1.0 + 5e-10), ("y", None), (None, 3.0)])
    assert checks.differences(a, b, ["k"]).count() == 0
    assert checks.differences(a, b, ["k"], rtol=1e-12).count() == 1
    assert checks.differences(a, b, ["k"], rtol=0.0, atol=1e-6).count() == 0


def test_types_do_not_matter_for_numbers(spark):
    a, _ = frames(spark, [("x", 1.0)], [])
    b = spark.createDataFrame([("x", 1)], "k string, v int")
    assert checks.differences(a, b, ["k"]).count() == 0


def test_missing_and_null(spark, rows):
    a, b = frames(spark, [("x", 1.0), ("y", 2.0), ("z", None)], [("x", 1.0), ("w", 2.0), ("z", 0.0)])
    found = rows(checks.differences(a, b, ["k"]), "k", "side", "v_left", "v_right")
    assert found == [("w", "right_only", None, 2.0), ("y", "left_only", 2.0, None), ("z", "both", None, 0.0)]


def test_repeated_keys_are_paired_by_order(spark, rows):
    a, b = frames(
        spark,
        [("x", 3.0), ("x", 1.0), ("x", 1.0), ("y", 1.0)],
        [("x", 1.0), ("x", 4.0), ("x", 1.0), ("y", 1.0), ("y", 1.0)],
    )
    found = rows(checks.differences(a, b, ["k"]), "k", "side", "v_left", "v_right")
    assert found == [("x", "both", 3.0, 4.0), ("y", "right_only", None, 1.0)]


def test_a_hot_repeated_key(spark):
    a = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") % 50).cast("double").alias("v"))
    assert checks.differences(a, a.repartition(9), ["k"]).count() == 0
    changed = a.withColumn("v", F.when(F.col("v") == 49, 100.0).otherwise(F.col("v")))
    assert checks.differences(a, changed, ["k"]).count() == 60


def test_strings_must_be_equal(spark):
    a = spark.createDataFrame([(1, "p")], "k long, v string")
    b = spark.createDataFrame([(1, "q")], "k long, v string")
    assert checks.differences(a, b, ["k"]).first()["side"] == "both"
