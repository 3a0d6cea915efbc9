"""Files written and read back."""

import datetime as dt
import json

import pytest
from plans import plan_text
from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.sources import files

ROWS = [
    ("T1", 1, 10.55, "Travel", "COMPLETED", dt.datetime(1998, 10, 3)),
    ("T2", 2, 2000.0, "with, comma", "FAILED", dt.datetime(2025, 1, 1, 23, 59, 59)),
    ("T3", 3, None, None, "COMPLETED", None),
]


@pytest.fixture
def tx(spark):
    return spark.createDataFrame(ROWS, files.TRANSACTION_SCHEMA)


def test_csv_round_trip(spark, tx, root, rows):
    files.write_csv(tx.coalesce(1), root)
    text = "".join(r["value"] for r in spark.read.text(root).collect())
    assert "1998-10-03 00:00:00" in text and "transaction_id" in text
    back = files.read_transactions_csv(spark, root)
    assert back.schema == files.TRANSACTION_SCHEMA
    assert rows(back) == rows(tx)


def test_csv_reads_two_columns(spark, tx, root):
    files.write_csv(tx, root)
    two = files.read_transactions_csv(spark, root, ["category", "amount"])
    assert "ReadSchema: struct<amount:double,category:string>" in plan_text(two)


def test_csv_with_a_bad_timestamp_is_an_error(spark, root):
    spark.range(1).selectExpr(
        "'T' transaction_id", "1 user_id", "2.5 amount", "'c' category", "'s' status", "'soon' timestamp"
    ).write.option("header", True).csv(root)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        files.read_transactions_csv(spark, root).collect()


@pytest.mark.parametrize("codec", files.CODECS)
def test_parquet_codecs(spark, tx, root, codec):
    files.write_parquet(tx, root, codec)
    assert checks.differences(tx, files.read_parquet(spark, root), ["transaction_id"]).count() == 0


def test_unknown_codec(tx, root):
    with pytest.raises(ValueError):
        files.write_parquet(tx, root, "zip")


def test_filter_and_projection_reach_the_scan(spark, tx, root):
    files.write_parquet(tx, root)
    wanted = (F.col("status") == "FAILED") & (F.col("amount") > 1000)
    df = files.read_parquet(spark, root, ["status", "amount"], wanted)
    text = plan_text(df)
    assert "EqualTo(status,FAILED)" in text and "GreaterThan(amount,1000.0)" in text
    assert "ReadSchema: struct<amount:double,status:string>" in text
    assert [tuple(r) for r in df.collect()] == [("FAILED", 2000.0)]


def test_number_of_files(spark, root):
    files.write_parquet(spark.range(100), root, files=5)
    sizes = spark.read.parquet(root).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 5 and all(abs(r["count"] - 20) <= 5 for r in sizes)


def test_footprint(spark, root, rows):
    df = spark.range(20_000).selectExpr("id % 7 as a", "'text text' as b")
    files.write_csv(df, f"{root}/csv")
    files.write_parquet(df, f"{root}/pq", "gzip")
    found = files.storage_footprint(spark, {"csv": f"{root}/csv", "pq": f"{root}/pq"}, "csv")
    report = {r["layout"]: r for r in found.collect()}
    assert report["csv"]["saved_pct"] == 0
    assert 50 < report["pq"]["saved_pct"] < 100
    assert report["pq"]["saved_pct"] == pytest.approx(
        (1 - report["pq"]["megabytes"] / report["csv"]["megabytes"]) * 100
    )


def test_json_replaces(spark, root):
    files.write_json(spark.range(5), root)
    files.write_json(spark.range(2), root)
    lines = [json.loads(r["value"]) for r in spark.read.text(root).collect()]
    assert sorted(x["id"] for x in lines) == [0, 1]


def test_released_tables_are_gone(spark):
    from pyspark.errors import AnalysisException

    from millrace.session import release, written

    table = written(spark.range(5), "table")
    path = table._written_to
    assert table.count() == 5
    release(table, spark.range(3))
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
