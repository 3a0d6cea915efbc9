"""Column functions, also away from UTC."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as c

TIMES = [
    "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2025-12-31 23:00:00",
    "2026-03-29 03:30:15.5", "2026-10-25 03:59:59", "2024-02-29 12:00:01",
]


@pytest.fixture(params=["UTC", "Europe/Kyiv", "America/New_York"])
def times(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark.createDataFrame([(t,) for t in TIMES], "t string").select(
        "t", c.parse_timestamp("t").alias("ts")
    )
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hours_and_texts_do_not_depend_on_the_zone(times):
    found = times.select(
        "t", c.second_text("ts"), c.hour_number_text(c.hour_number("ts"))
    ).collect()
    for t, second, by_number in found:
        assert second == t[:19]
        assert by_number == t[:13] + ":00"


def test_bad_time_text_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("soon",)], "t string").select(c.parse_timestamp("t")).collect()


def test_epoch_millis_round_down(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1970, 1, 1, 0, 0, 1, 999),), (dt.datetime(1969, 12, 31, 23, 59, 59, 999900),)],
        "ts timestamp_ntz",
    )
    assert [r[0] for r in df.select(c.epoch_millis("ts")).collect()] == [1000, -1]


def test_groups(spark, rows):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert rows(c.with_group(df, "v", {"a": "A"}, "g")) == [(None, "Other"), ("a", "A"), ("z", "Other")]
    assert rows(c.with_group(df, "v", {}, "g", "none"), "g") == [("none",)] * 3


def test_shares(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(c.share("a", "b", 3)).collect()] == [0.333, None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "v double")
    assert [r[0] for r in df.select(c.round_even("v")).collect()] == [0.12, 0.38, 2.5]


def test_salt_is_a_function_of_the_key(spark):
    df = c.with_salt(spark.range(1000).select(F.col("id").cast("string").alias("k")), "k", 8)
    counts = df.groupBy("salt").count().collect()
    assert {r["salt"] for r in counts} == set(range(8)) and min(r["count"] for r in counts) > 80
