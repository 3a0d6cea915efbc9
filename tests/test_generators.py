"""Generated rows stay in their ranges and do not depend on the partition layout."""

from pyspark.sql import functions as F

from millrace.operators.sessions import hot_keys, session_durations
from millrace.sources import generators as g

N = 20_000


def test_transactions(spark):
    tx = g.transactions(g.id_range(spark, N))
    first = tx.orderBy("transaction_id").first()
    assert first["transaction_id"] == "TXN_00000000" and str(first["timestamp"]) == "2025-01-01 00:00:00"
    s = tx.agg(
        F.min("user_id"), F.max("user_id"), F.min("amount"), F.max("amount"), F.avg("amount"),
        F.count_distinct("transaction_id"), F.max("timestamp"),
    ).first()
    assert s[0] >= 1000 and s[1] < 9999 and s[2] >= 5 and s[3] <= 5000
    assert abs(s[4] - 2502.5) < 40 and s[5] == N and str(s[6]) == "2025-01-01 05:33:19"
    for column, values in [("category", g.CATEGORIES), ("status", g.STATUSES)]:
        counts = {r[column]: r["count"] for r in tx.groupBy(column).count().collect()}
        assert set(counts) == set(values)
        assert all(abs(c - N / len(values)) < 0.05 * N / len(values) for c in counts.values())


def test_columns_are_not_tied_to_each_other(spark):
    tx = g.transactions(g.id_range(spark, N))
    cells = tx.groupBy("category", "status").count().agg(F.min("count"), F.max("count")).first()
    assert cells[0] > 0.85 * N / 20 and cells[1] < 1.15 * N / 20
    assert abs(tx.select(F.corr("user_id", "amount")).first()[0]) < 0.03


def test_session_log(spark):
    log = g.session_log(g.id_range(spark, N)).persist()
    per_session = log.groupBy("session_id").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("u"))
    s = per_session.agg(F.min("n"), F.max("n"), F.avg("n"), F.max("u"), F.count("*")).first()
    assert (s[0], s[1], s[3], s[4]) == (2, 20, 1, N) and abs(s[2] - 11) < 0.1
    t = log.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    assert t[0] >= g.BASE_TIMESTAMP_MS
    assert t[1] < g.BASE_TIMESTAMP_MS + g.PERIOD_MS + g.MAX_SESSION_MS
    longest = session_durations(log).agg(F.max("duration_ms"), F.avg("duration_ms")).first()
    assert longest[0] < g.MAX_SESSION_MS and longest[1] > 0.3 * g.MAX_SESSION_MS
    log.unpersist()


def test_skewed_log(spark):
    log = g.session_log(g.id_range(spark, N), hot_share=g.HOT_SHARE)
    top = hot_keys(log, k=1).first()
    assert top["user_id"] == g.HOT_USER and abs(top["share"] - 0.9) < 0.01


def test_layout_does_not_matter(spark):
    a = g.session_log(g.id_range(spark, 500))
    b = g.session_log(g.id_range(spark, 500).repartition(3))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
