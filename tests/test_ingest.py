"""Duplicates, replays, retries and accounting."""

import json

import pytest

from millrace.operators import ingest
from millrace.operators.keyed_tables import known_keys, without_keys
from millrace.streaming.ingest_stream import feed_stream, run_ingest_stream


def rec(record_id, temperature=20.0, **more):
    return json.dumps(
        {
            "record_id": record_id, "timestamp": "2026-01-01", "sensor_id": "s",
            "temperature": temperature, "humidity": 50.0,
        }
        | more
    )


def feed(spark, raws, batch_id=0, start=0):
    data = [(raw, batch_id, start + i) for i, raw in enumerate(raws)]
    return spark.createDataFrame(data, "raw string, batch_id long, arrival_seq long")


def counters(spark, root):
    metrics = ingest.read_sink(spark, root, "metrics").orderBy("batch_id").collect()
    return [(m["received"], m["clean"], m["dlq"], m["duplicates"]) for m in metrics]


def stored(spark, root, sink, *columns):
    return sorted(tuple(r) for r in ingest.read_sink(spark, root, sink).select(*columns).collect())


def test_redelivery_inside_a_batch(spark, root):
    ingest.ingest_batch(feed(spark, [rec("a"), rec("b"), rec("a"), rec("a", 30.0)]), 0, root)
    assert counters(spark, root) == [(4, 2, 0, 2)]
    assert stored(spark, root, "clean", "record_id", "temperature") == [("a", 20.0), ("b", 20.0)]


def test_redelivery_in_a_later_batch(spark, root):
    ingest.ingest_batch(feed(spark, [rec("a"), rec("b")]), 0, root)
    ingest.ingest_batch(feed(spark, [rec("b"), rec("c")]), 1, root)
    assert counters(spark, root) == [(2, 2, 0, 0), (2, 1, 0, 1)]
    assert stored(spark, root, "ledger", "record_key") == [('"a"',), ('"b"',), ('"c"',)]


def test_first_arrival_decides_even_when_invalid(spark, root):
    raws = [rec("good"), rec("good", 999.0), rec("bad", 999.0), rec("bad")]
    ingest.ingest_batch(feed(spark, raws), 0, root)
    assert counters(spark, root) == [(4, 1, 1, 2)]
    assert stored(spark, root, "clean", "record_id") == [("good",)]
    assert stored(spark, root, "dead_letter", "raw") == [(rec("bad", 999.0),)]


def test_records_without_an_id_are_never_duplicates(spark, root):
    raws = [rec(None), rec(None), "{}", "{}", "junk", "junk", rec({"k": 1}), rec({"k": 1})]
    for batch_id in (0, 1):
        ingest.ingest_batch(feed(spark, raws), batch_id, root)
    assert counters(spark, root) == [(8, 0, 8, 0), (8, 0, 8, 0)]
    assert stored(spark, root, "ledger", "record_key") == []


def test_keyless_records_with_one_or_no_arrival_number(spark, root):
    raws = ['{"x":1}', "[1]", "oops", "oops"]
    same = spark.createDataFrame([(r, 0, 7) for r in raws], "raw string, batch_id long, arrival_seq long")
    ingest.ingest_batch(same, 0, root)
    none = spark.createDataFrame([(r, 1, None) for r in raws], "raw string, batch_id long, arrival_seq long")
    ingest.ingest_batch(none, 1, root)
    assert counters(spark, root) == [(4, 0, 4, 0), (4, 0, 4, 0)]


def test_ties_of_one_id_keep_one_record(spark, root):
    raws = [rec("a"), rec("a", 30.0), rec("a")]
    tied = spark.createDataFrame([(r, 0, None) for r in raws], "raw string, batch_id long, arrival_seq long")
    ingest.ingest_batch(tied, 0, root)
    assert counters(spark, root) == [(3, 1, 0, 2)]


def test_clean_records_keep_every_member(spark, root):
    ingest.ingest_batch(feed(spark, [rec("a", site="north"), rec("b", 999.0, site="south")]), 0, root)
    assert [json.loads(r)["site"] for (r,) in stored(spark, root, "clean", "raw")] == ["north"]
    assert [json.loads(r)["site"] for (r,) in stored(spark, root, "dead_letter", "raw")] == ["south"]


def test_a_batch_whose_fetches_all_failed_is_counted(spark):
    attempts = spark.createDataFrame([(5, a, False) for a in (1, 2, 3, 4)], "batch_id long, attempt int, ok boolean")
    found = ingest.batch_metrics(feed(spark, [rec("a")]), attempts).orderBy("batch_id").collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 0, 0, 0, 0), (5, 0, 0, 0, 0, 3, 1)]


def test_empty_and_typed_ids(spark, root):
    raws = [rec(""), rec(""), rec(5), rec("5"), rec(5)]
    ingest.ingest_batch(feed(spark, raws), 0, root)
    assert counters(spark, root) == [(5, 1, 2, 2)]


def test_one_id_may_fill_the_batch(spark, root):
    raws = [rec("hot")] * 300 + [rec(f"r{i}") for i in range(300)] + [rec(None)] * 300
    ingest.ingest_batch(feed(spark, raws), 0, root)
    assert counters(spark, root) == [(900, 301, 300, 299)]


def test_retry_of_a_batch_changes_nothing(spark, root):
    first, second = feed(spark, [rec("a"), rec("b"), rec(None)]), feed(spark, [rec("b"), rec("c")])
    for batch, batch_id in [(first, 0), (first, 0), (second, 1), (second, 1)]:
        ingest.ingest_batch(batch, batch_id, root)
    assert counters(spark, root) == [(3, 2, 1, 0), (2, 1, 0, 1)]
    assert stored(spark, root, "clean", "record_id") == [("a",), ("b",), ("c",)]


def test_crash_before_the_ledger_is_written(spark, root, monkeypatch):
    whole = feed(spark, [rec("a"), rec("b")])
    write_ledger = ingest._write_ledger

    def fail(ids, root, batch_id):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_write_ledger", fail)
    with pytest.raises(RuntimeError):
        ingest.ingest_batch(whole, 0, root)
    monkeypatch.setattr(ingest, "_write_ledger", write_ledger)
    ingest.ingest_batch(whole, 0, root)
    assert counters(spark, root) == [(2, 2, 0, 0)]
    assert stored(spark, root, "clean", "record_id") == [("a",), ("b",)]


def test_empty_batch(spark, root):
    ingest.ingest_batch(feed(spark, [rec("a")]).limit(0), 0, root)
    assert counters(spark, root) == [(0, 0, 0, 0)]


def test_a_run_with_known_proportions(spark, root):
    """105 received: 39 clean, 32 dead letters, 34 duplicates, over ten batches and a replay."""
    faults = (
        ["humidity"] * 3 + ["sensor_id"] * 2 + ["temperature"] * 2  # removed
        + ["null"] * 6 + ["time"] * 9 + ["type"] * 6 + ["range"] * 4
    )
    change = {
        "null": {"temperature": None}, "time": {"timestamp": "not-a-date"},
        "type": {"temperature": "INVALID"}, "range": {"temperature": 999.99},
    }
    unique = []
    for i, fault in enumerate(faults):
        record = json.loads(rec(f"bad{i}"))
        if fault in change:
            record |= change[fault]
        else:
            del record[fault]
        unique.append(json.dumps(record))
    unique += [rec(f"good{i}") for i in range(39)]
    sent = unique + unique[:29]
    batches = [sent[i : i + 10] for i in range(0, 100, 10)] + [sent[:5]]
    log = [(0, 1, True), (1, 1, False), (1, 2, False), (1, 3, False), (1, 4, True)]
    log += [(7, 1, False), (7, 2, True), (10, 1, False), (10, 2, False), (10, 3, True)]
    attempts = spark.createDataFrame(log, "batch_id long, attempt int, ok boolean")
    for batch_id, batch in enumerate(batches):
        ingest.ingest_batch(feed(spark, batch, batch_id, batch_id * 100), batch_id, root, attempts)

    metrics = ingest.read_sink(spark, root, "metrics")
    assert tuple(ingest.total_metrics(metrics).first()) == (105, 39, 32, 34, 6, 0)
    summary = ingest.quality_summary(metrics).first()
    assert (summary["valid_pct"], summary["duplicate_pct"]) == (54.9, 32.4)
    assert (summary["fetch_retries"], summary["fetch_failures"]) == (6, 0)
    dead = ingest.read_sink(spark, root, "dead_letter")
    assert {tuple(r) for r in ingest.dlq_by_reason(dead).collect()} == {
        ("missing:humidity", 3), ("missing:sensor_id", 2), ("missing:temperature", 2),
        ("null_measure", 6), ("bad_timestamp", 9), ("bad_type", 6), ("temperature_range", 4),
    }
    assert ingest.read_sink(spark, root, "ledger").count() == 71
    whole = [feed(spark, b, i, i * 100) for i, b in enumerate(batches)]
    at_once = whole[0]
    for part in whole[1:]:
        at_once = at_once.union(part)
    assert sorted(tuple(r) for r in ingest.batch_metrics(at_once, attempts).collect()) == sorted(
        tuple(r) for r in metrics.select("batch_id", *ingest.COUNTERS).collect()
    )


def test_reconcile_finds_tampering(spark, root):
    ingest.ingest_batch(feed(spark, [rec("a"), rec("a"), "junk"]), 0, root)
    metrics, clean, dead = (
        ingest.read_sink(spark, root, s) for s in ("metrics", "clean", "dead_letter")
    )
    assert all(r["ok"] for r in ingest.reconcile(metrics, clean, dead).collect())
    checks = {r["rule"]: r for r in ingest.reconcile(metrics, clean.limit(0), dead).collect()}
    assert not checks["clean_stored"]["ok"] and checks["dlq_stored"]["ok"]
    wrong = metrics.withColumn("received", metrics["received"] + 1)
    checks = {r["rule"]: r["ok"] for r in ingest.reconcile(wrong, clean, dead).collect()}
    assert checks == {"clean_stored": True, "dlq_stored": True, "received_accounted": False}


def test_summary_of_nothing(spark, root):
    summary = ingest.quality_summary(ingest.read_sink(spark, root, "metrics")).first()
    assert summary["received"] == 0
    assert summary["valid_pct"] is None and summary["duplicate_pct"] is None


def test_fetch_accounting(spark):
    attempts = [(1, 1, True), (2, 1, False), (2, 2, False), (2, 3, True)]
    attempts += [(3, a, False) for a in (1, 2, 3, 4)]
    df = spark.createDataFrame(attempts, "batch_id long, attempt int, ok boolean")
    found = sorted(tuple(r) for r in ingest.fetch_accounting(df).collect())
    assert found == [(1, 0, 0, 0.0), (2, 2, 0, 0.6), (3, 3, 1, 1.4)]


def test_malformed_rows_are_set_aside(spark):
    stored_rows = feed(spark, [rec("a"), "{broken", "[]"])
    good, bad = ingest.split_malformed(stored_rows)
    assert good.count() == 2 and [r["raw"] for r in bad.collect()] == ["{broken"]


def test_stream_goes_on_after_a_restart(spark, root):
    source, sinks = f"{root}/feed", f"{root}/sinks"

    def run():
        query = run_ingest_stream(feed_stream(spark, source, files_per_batch=1), sinks)
        query.awaitTermination()
        assert query.exception() is None

    feed(spark, [rec("a"), rec("b"), "junk"]).coalesce(1).write.mode("append").parquet(source)
    run()
    feed(spark, [rec("b"), rec("c")], 1, 10).coalesce(1).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    assert stored(spark, sinks, "clean", "record_id") == [("a",), ("b",), ("c",)]
    total = ingest.total_metrics(ingest.read_sink(spark, sinks, "metrics")).first()
    assert tuple(total) == (5, 3, 1, 1, 0, 0)


def test_ledger_is_not_shuffled_for_a_small_batch(spark, root):
    from plans import plan_text

    ingest.ingest_batch(feed(spark, [rec(f"r{i}") for i in range(50)]), 0, root)
    first = ingest.first_deliveries(feed(spark, [rec("r1"), rec("x")])).persist()
    first.count()
    seen = known_keys(first, ingest.read_ledger(spark, root, 1), "record_key")
    text = plan_text(seen)
    ledger_join = text.index("LeftSemi")
    assert "BroadcastHashJoin" in text[ledger_join - 80 : ledger_join]
    fresh = without_keys(first, seen, "record_key")
    assert [r["record_key"] for r in fresh.collect()] == ['"x"']
    first.unpersist()


def test_ledger_is_not_shuffled_for_a_large_batch(spark, root):
    from plans import plan_text

    ingest.ingest_batch(feed(spark, [rec(f"r{i}") for i in range(50)]), 0, root)
    ingest.ingest_batch(feed(spark, [rec(f"r{i}") for i in range(40, 90)]), 1, root)
    first = ingest.first_deliveries(feed(spark, [rec("r1"), rec("r80"), rec("x")])).persist()
    first.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = known_keys(first, ingest.read_ledger(spark, root, 2), "record_key")
        text = plan_text(seen)
        join = text[text.index("LeftSemi") :]
        ledger_side = join[: join.index("FileScan")]
        assert "Bucketed: true" in text and "Exchange" not in ledger_side
        assert sorted(r["record_key"] for r in seen.collect()) == ['"r1"', '"r80"']
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        first.unpersist()


def test_compacted_ledger_remembers_every_id(spark, root):
    for batch_id in range(4):
        ingest.ingest_batch(feed(spark, [rec(f"r{batch_id}"), rec("all")]), batch_id, root)
    ingest.compact_ledger(spark, root, 2)
    assert stored(spark, root, "ledger", "record_key", "batch_id") == [
        ('"all"', 2), ('"r0"', 2), ('"r1"', 2), ('"r2"', 2), ('"r3"', 3),
    ]
    ingest.ingest_batch(feed(spark, [rec("r0"), rec("r3"), rec("new")]), 4, root)
    assert counters(spark, root)[-1] == (3, 1, 0, 2)
