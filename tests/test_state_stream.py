"""The stream that keeps handled ids in Spark's state store."""

import json

from millrace.operators import ingest
from millrace.streaming.ingest_stream import FEED_SCHEMA, feed_stream, run_state_stream


def rec(record_id, temperature=20.0):
    return json.dumps({"record_id": record_id, "timestamp": "2026-01-01", "sensor_id": "s", "temperature": temperature, "humidity": 50.0})


def deliver(spark, path, raws, start):
    rows = [(raw, 0, start + i) for i, raw in enumerate(raws)]
    spark.createDataFrame(rows, FEED_SCHEMA).repartition(3).write.mode("append").parquet(path)


def run(spark, source, root, **options):
    run_state_stream(feed_stream(spark, source, **options), root).awaitTermination()
    metrics = ingest.read_sink(spark, root, "metrics").orderBy("batch_id").collect()
    return [(m["received"], m["clean"], m["dlq"], m["duplicates"]) for m in metrics]


def clean(spark, root):
    return sorted(tuple(r) for r in ingest.read_sink(spark, root, "clean").select("record_id", "temperature").collect())


def test_state_is_kept_over_runs(spark, root):
    source, sinks = f"{root}/in", f"{root}/out"
    deliver(spark, source, [rec("a"), rec("b"), rec("a", 30.0), rec(None), "junk", "junk"], 0)
    assert run(spark, source, sinks) == [(6, 2, 3, 1)]
    deliver(spark, source, [rec("c"), rec("b", 40.0), rec("bad", 999.0), rec("bad"), "junk"], 10)
    assert run(spark, source, sinks) == [(6, 2, 3, 1), (5, 1, 2, 2)]
    deliver(spark, source, [rec("a"), rec("bad"), rec("c")], 20)
    assert run(spark, source, sinks)[-1] == (3, 0, 0, 3)
    assert clean(spark, sinks) == [("a", 20.0), ("b", 20.0), ("c", 20.0)]
    assert ingest.read_sink(spark, sinks, "dead_letter").count() == 5


def test_the_session_keeps_its_state_store(spark, root):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    deliver(spark, f"{root}/in", [rec("a")], 0)
    run(spark, f"{root}/in", f"{root}/out")
    assert spark.conf.get(name) == before


def test_a_crash_in_a_batch_repeats_it(spark, root, monkeypatch):
    from millrace.streaming import ingest_stream

    source, sinks = f"{root}/in", f"{root}/out"
    deliver(spark, source, [rec("a"), rec("b"), rec("b")], 0)
    run(spark, source, sinks)
    deliver(spark, source, [rec("b"), rec("c"), rec("c", 30.0)], 10)
    stored = ingest_stream.store_handled

    def lost(handled, *args):
        stored(handled, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest_stream, "store_handled", lost)
    query = run_state_stream(feed_stream(spark, source), sinks)
    try:
        query.awaitTermination()
    except Exception:
        pass
    assert query.exception() is not None
    monkeypatch.undo()
    assert run(spark, source, sinks) == [(3, 2, 0, 1), (3, 1, 0, 2)]
    assert clean(spark, sinks) == [("a", 20.0), ("b", 20.0), ("c", 20.0)]


def test_one_id_may_fill_a_batch(spark, root):
    source = f"{root}/in"
    deliver(spark, source, [rec("hot")] * 200 + [rec(None)] * 200, 0)
    assert run(spark, source, f"{root}/out") == [(400, 1, 200, 199)]


def tasks_with_rows(df):
    from pyspark.sql import functions as F

    return df.select(F.spark_partition_id()).distinct().count()


def test_files_of_keys_do_not_draw_all_records_into_one_task(spark, root, monkeypatch):
    from millrace.streaming import ingest_stream

    tasks, plain = [], ingest_stream.first_deliveries
    monkeypatch.setattr(ingest_stream, "first_deliveries", lambda df: (tasks.append(tasks_with_rows(df)), plain(df))[1])
    deliver(spark, f"{root}/in", [rec(f"r{i}") for i in range(300)], 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert run(spark, f"{root}/in", f"{root}/out") == [(300, 300, 0, 0)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tasks == [3]  # one for each file of the source


def test_a_batch_of_one_file_is_dealt_over_the_cores(spark, root, monkeypatch):
    from millrace.streaming import ingest_stream

    tasks = []
    monkeypatch.setattr(ingest_stream, "ingest_batch", lambda batch, *rest: tasks.append(tasks_with_rows(batch)))
    rows = [(rec("hot"), 0, 0)] * 400
    spark.createDataFrame(rows, FEED_SCHEMA).coalesce(1).write.parquet(f"{root}/in")
    ingest_stream.run_ingest_stream(feed_stream(spark, f"{root}/in"), f"{root}/out").awaitTermination()
    assert len(tasks) == 1 and tasks[0] >= spark.sparkContext.defaultParallelism
