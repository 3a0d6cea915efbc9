"""Registered queries: keyed tables and validated ingest, batch and stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.inputs import (
    ATTEMPTS, CLEAN_FIELDS, FEED, JUDGED, PEOPLE, attempts, faulty_newcomers, feed, gpa_changes,
    leavers, newcomers, people, table,
)
from millrace.functions.record_rules import with_record_key
from millrace.operators import checks, ingest, keyed_tables, stored_tables
from millrace.session import fresh_path, written
from millrace.streaming.ingest_stream import feed_stream, run_ingest_stream, run_state_stream


def _shown(df):
    """Decimals as doubles, so that both engines hand out the same type."""
    return df.withColumn("gpa", F.col("gpa").cast("double"))


# -- keyed tables -------------------------------------------------------------------------


def ordered_people(spark, sf_dir):
    return _shown(people(spark, sf_dir)).orderBy("id")


def insert_ignore(spark, sf_dir):
    target = people(spark, sf_dir)
    incoming = keyed_tables.with_defaults(
        newcomers(spark, sf_dir), target, "arrival_seq", time_column=None
    )
    return _shown(keyed_tables.insert_ignore(target, incoming, "email", "arrival_seq"))


def accepted_load(spark, sf_dir):
    """The same load with the table's rules enforced; no row breaks one."""
    target = people(spark, sf_dir)
    incoming = keyed_tables.with_defaults(
        newcomers(spark, sf_dir), target, "arrival_seq", time_column=None
    )
    return _shown(
        keyed_tables.insert_ignore(target, incoming, "email", "arrival_seq", checks.PEOPLE_RULES)
    )


def refused_load(spark, sf_dir):
    """Why a load of faulty sign-ups is refused: rows that break each rule."""
    target = people(spark, sf_dir)
    added = keyed_tables.new_rows(target, faulty_newcomers(spark, sf_dir), "email", "arrival_seq")
    return keyed_tables.broken_rules(added, target, checks.PEOPLE_RULES)


def update_by_key(spark, sf_dir):
    changes = gpa_changes(spark, sf_dir)
    return _shown(keyed_tables.update_by_key(people(spark, sf_dir), changes, "id", ["gpa"], "seq"))


def delete_by_key(spark, sf_dir):
    return _shown(keyed_tables.delete_by_key(people(spark, sf_dir), leavers(spark, sf_dir), "id"))


def _stored_people(spark, sf_dir) -> str:
    root = fresh_path(spark, "people")
    stored_tables.create(people(spark, sf_dir), root, "id", buckets=16)
    return root


def stored_changes(spark, sf_dir):
    """The stored table after an update, a delete and an insert, each of which rewrites only buckets it touches."""
    root = _stored_people(spark, sf_dir)
    stored_tables.update(spark, root, gpa_changes(spark, sf_dir), ["gpa"], "seq", checks.PEOPLE_RULES)
    stored_tables.delete(spark, root, leavers(spark, sf_dir))
    target = people(spark, sf_dir)
    incoming = keyed_tables.with_defaults(newcomers(spark, sf_dir), target, "arrival_seq", time_column=None)
    stored_tables.insert_ignore(spark, root, incoming, "email", "arrival_seq", checks.PEOPLE_RULES)
    return _shown(stored_tables.read(spark, root))


def stored_affected_rows(spark, sf_dir):
    """What each change reports: rows updated, deleted and inserted, one after another."""
    root = _stored_people(spark, sf_dir)
    updated = stored_tables.update(spark, root, gpa_changes(spark, sf_dir), ["gpa"], "seq")
    deleted = stored_tables.delete(spark, root, leavers(spark, sf_dir))
    incoming = keyed_tables.with_defaults(
        newcomers(spark, sf_dir), people(spark, sf_dir), "arrival_seq", time_column=None
    )
    inserted = stored_tables.insert_ignore(spark, root, incoming, "email", "arrival_seq")
    report = [("update", updated), ("delete", deleted), ("insert", inserted)]
    return spark.createDataFrame(report, "op string, rows bigint")


def stored_versions(spark, sf_dir):
    """Rows and sum of marks in each version of the stored table: earlier ones stay as they were."""
    root = _stored_people(spark, sf_dir)
    stored_tables.update(spark, root, gpa_changes(spark, sf_dir), ["gpa"], "seq")
    stored_tables.delete(spark, root, leavers(spark, sf_dir))
    versions = [
        stored_tables.read(spark, root, v).agg(
            F.count("*").alias("rows"), F.sum("gpa").cast("double").alias("total_gpa")
        ).withColumn("version", F.lit(v).cast("bigint"))
        for v in range(3)
    ]
    return reduce(DataFrame.unionByName, versions)


def affected_rows(spark, sf_dir):
    target = people(spark, sf_dir)
    added = keyed_tables.affected_rows(
        target, "email", "arrival_seq", inserts=newcomers(spark, sf_dir)
    )
    changed = keyed_tables.affected_rows(
        target, "id", "seq", updates=gpa_changes(spark, sf_dir), deletes=leavers(spark, sf_dir)
    )
    return added.unionByName(changed)


# -- validation ---------------------------------------------------------------------------


def validate_reason(spark, sf_dir):
    return ingest.validate(feed(spark, sf_dir)).select(
        "batch_id", "arrival_seq", "reason_code", "reason_value"
    )


def clean_rows(spark, sf_dir):
    return ingest.clean_rows(ingest.first_deliveries(feed(spark, sf_dir)))


def dlq_rows(spark, sf_dir):
    """Without failed_at, which is the time of the run."""
    return ingest.dead_letters(ingest.first_deliveries(feed(spark, sf_dir))).drop("failed_at")


def keyless_records(spark, sf_dir):
    """Records handled and received per reason, where records without an id share or lack arrival numbers."""
    keyed = with_record_key(feed(spark, sf_dir))
    number = F.when(F.col("arrival_seq") % 2 == 0, F.lit(7))
    loose = keyed.withColumn(
        "arrival_seq", F.when(F.col("record_key").isNull(), number).otherwise(F.col("arrival_seq"))
    )
    first = ingest.first_deliveries(loose.drop("record_key"))
    return first.groupBy("reason_code").agg(
        F.count("*").alias("records"), F.sum("deliveries").alias("received")
    )


def extra_members(spark, sf_dir):
    """Clean records that carry a member no rule knows: it stays."""
    source = feed(spark, sf_dir)
    raw = F.regexp_replace("raw", r'^\{"', '{"site":"north","')
    clean = ingest.clean_rows(ingest.first_deliveries(source.withColumn("raw", raw)))
    return clean.select("record_id", "raw")


def dlq_by_reason(spark, sf_dir):
    return ingest.dlq_by_reason(ingest.dead_letters(ingest.first_deliveries(feed(spark, sf_dir))))


def malformed_split(spark, sf_dir):
    good, bad = ingest.split_malformed(feed(spark, sf_dir))
    return good.withColumn("part", F.lit("good")).unionByName(
        bad.withColumn("part", F.lit("quarantined"))
    )


def drop_seen(spark, sf_dir):
    """Batch 1 against the ledger batch 0 leaves behind."""
    whole = feed(spark, sf_dir)
    earlier = ingest.first_deliveries(whole.filter(F.col("batch_id") == 0))
    ledger = earlier.filter(F.col("record_key").isNotNull()).select("record_key")
    return ingest.drop_seen(whole.filter(F.col("batch_id") == 1), ledger)


def _ingested(spark, sf_dir) -> str:
    """Both batches, then batch 0 delivered once more as batch 2."""
    root = fresh_path(spark, "ingest")
    whole = feed(spark, sf_dir)
    for batch_id, source in enumerate([0, 1, 0]):
        ingest.ingest_batch(
            whole.filter(F.col("batch_id") == source), batch_id, root, attempts(spark, sf_dir)
        )
    return root


def replay_adds_nothing(spark, sf_dir):
    """Counters per batch; the replay adds duplicates and the records that carry no id."""
    return ingest.read_sink(spark, _ingested(spark, sf_dir), "metrics")


def retry_adds_nothing(spark, sf_dir):
    """Counters when every batch runs twice, as after a crash before the commit."""
    root = fresh_path(spark, "retry")
    whole = feed(spark, sf_dir)
    for batch_id in (0, 0, 1, 1):
        ingest.ingest_batch(
            whole.filter(F.col("batch_id") == batch_id), batch_id, root, attempts(spark, sf_dir)
        )
    return ingest.read_sink(spark, root, "metrics")


def ledger_lookups(spark, sf_dir):
    """Per batch: ids asked for, ids that were handled before, and whether a file of the ledger had to be opened.

    Batch 2 is batch 0 under new ids, so its ids are new; batch 3 is batch 0 as it was.
    """
    root = fresh_path(spark, "lookups")
    whole = feed(spark, sf_dir)
    first = whole.filter(F.col("batch_id") == 0)
    renamed = first.withColumn("raw", F.regexp_replace("raw", '"record_id":"rec-', '"record_id":"new-'))
    named = F.col("record_key").startswith('"new-')
    batches = [first, whole.filter(F.col("batch_id") == 1), with_record_key(renamed).filter(named).drop("record_key"), first]
    reports = []
    for batch_id, batch in enumerate(batches):
        ids = with_record_key(batch).filter(F.col("record_key").isNotNull()).select("record_key").distinct()
        ids = written(ids, "ids")
        hits, in_batches, buckets = ingest.ledger_places(ids, root, batch_id)
        seen = ingest.known_keys(hits, ingest.ledger_part(spark, root, in_batches, buckets), "record_key")
        counts = ids.agg(F.count("*").alias("ids")).withColumn("seen", seen.agg(F.count("*")).scalar())
        reports.append(written(counts.select(
            F.lit(batch_id).cast("bigint").alias("batch_id"), "ids", "seen", F.lit(bool(in_batches)).alias("opened")
        ), "lookups"))
        ingest.ingest_batch(batch, batch_id, root)
    return reduce(DataFrame.unionByName, reports)


def replay_slice(spark, sf_dir):
    """The first five arrivals."""
    return feed(spark, sf_dir).orderBy("arrival_seq").limit(5)


# -- accounting ---------------------------------------------------------------------------


def ingest_metrics(spark, sf_dir):
    return ingest.batch_metrics(feed(spark, sf_dir), attempts(spark, sf_dir))


def reconcile(spark, sf_dir):
    root = _ingested(spark, sf_dir)
    return ingest.reconcile(
        ingest.read_sink(spark, root, "metrics"),
        ingest.read_sink(spark, root, "clean"),
        ingest.read_sink(spark, root, "dead_letter"),
    )


def reconcile_broken(spark, sf_dir):
    """The same checks where a batch's clean rows are lost and its counters double what was received."""
    root = _ingested(spark, sf_dir)
    metrics = ingest.read_sink(spark, root, "metrics")
    return ingest.reconcile(
        metrics.withColumn("received", F.col("received") * 2),
        ingest.read_sink(spark, root, "clean").filter(F.col("batch_id") != 0),
        ingest.read_sink(spark, root, "dead_letter"),
    )


def quality_summary(spark, sf_dir):
    return ingest.quality_summary(ingest.batch_metrics(feed(spark, sf_dir), attempts(spark, sf_dir)))


def fetch_accounting(spark, sf_dir):
    """Every event as a fetch that fails `event_id % 6` times before it succeeds."""
    fails = F.col("event_id") % 6
    attempts = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("batch_id"),
        fails.alias("fails"),
        F.explode(F.sequence(F.lit(1), F.least(fails + 1, F.lit(4)).cast("int"))).alias("attempt"),
    )
    return ingest.fetch_accounting(attempts.withColumn("ok", F.col("attempt") > F.col("fails")))


def ingest_stream(spark, sf_dir):
    """The feed as files, streamed through the ingest; the clean table at the end."""
    source, root = fresh_path(spark, "feed"), fresh_path(spark, "stream")
    whole = feed(spark, sf_dir)
    for batch_id in (0, 1):
        whole.filter(F.col("batch_id") == batch_id).write.mode("append").parquet(source)
    query = run_ingest_stream(feed_stream(spark, source, files_per_batch=4), root)
    query.awaitTermination()
    return ingest.read_sink(spark, root, "clean").drop("batch_id")


def _state_streamed(spark, sf_dir) -> str:
    """The feed streamed in two runs, the second from where the first stopped, with the ids in the state store."""
    source, root = fresh_path(spark, "feed"), fresh_path(spark, "stream")
    whole = feed(spark, sf_dir)
    for batch_id in (0, 1):
        whole.filter(F.col("batch_id") == batch_id).write.mode("append").parquet(source)
        run_state_stream(feed_stream(spark, source, files_per_batch=8), root).awaitTermination()
    return root


def ingest_state_stream(spark, sf_dir):
    """The clean table after a stream that keeps handled ids in the state store and was restarted once."""
    return ingest.read_sink(spark, _state_streamed(spark, sf_dir), "clean").drop("batch_id")


def state_stream_totals(spark, sf_dir):
    """The counters over all micro-batches of the same stream."""
    root = _state_streamed(spark, sf_dir)
    totals = ingest.total_metrics(ingest.read_sink(spark, root, "metrics"))
    return totals.select("received", "clean", "dlq", "duplicates")


QUERIES = {
    "ordered_people": ordered_people,
    "insert_ignore": insert_ignore,
    "accepted_load": accepted_load,
    "refused_load": refused_load,
    "update_by_key": update_by_key,
    "delete_by_key": delete_by_key,
    "affected_rows": affected_rows,
    "stored_changes": stored_changes,
    "stored_affected_rows": stored_affected_rows,
    "stored_versions": stored_versions,
    "validate_reason": validate_reason,
    "clean_rows": clean_rows,
    "dlq_rows": dlq_rows,
    "dlq_by_reason": dlq_by_reason,
    "keyless_records": keyless_records,
    "extra_members": extra_members,
    "malformed_split": malformed_split,
    "drop_seen": drop_seen,
    "replay_adds_nothing": replay_adds_nothing,
    "retry_adds_nothing": retry_adds_nothing,
    "ledger_lookups": ledger_lookups,
    "replay_slice": replay_slice,
    "ingest_metrics": ingest_metrics,
    "reconcile": reconcile,
    "reconcile_broken": reconcile_broken,
    "quality_summary": quality_summary,
    "fetch_accounting": fetch_accounting,
    "ingest_stream": ingest_stream,
    "ingest_state_stream": ingest_state_stream,
    "state_stream_totals": state_stream_totals,
}

# -- the same in SQL ----------------------------------------------------------------------

_PERSON = "id, full_name, email, CAST(gpa AS DOUBLE) AS gpa"

_CHANGED = f"""WITH {PEOPLE},
last_change AS (
    SELECT id, gpa FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM gpa_changes)
    WHERE rn = 1),
updated AS (
    SELECT p.id, full_name, email, CASE WHEN c.id IS NOT NULL THEN c.gpa ELSE p.gpa END AS gpa, c.id IS NOT NULL AS hit
    FROM people p LEFT JOIN last_change c ON p.id = c.id),
stayed AS (SELECT * FROM updated WHERE id NOT IN (SELECT id FROM leavers)),
later AS (
    SELECT (SELECT max(id) FROM people) + arrival_seq + 1 AS id, full_name, email, gpa
    FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY arrival_seq) AS rn FROM newcomers)
    WHERE rn = 1 AND email NOT IN (SELECT email FROM stayed))
"""

_BATCHES = f"""WITH {FEED}, {JUDGED}, {ATTEMPTS},
received AS (SELECT batch_id, count(*) AS received FROM feed GROUP BY batch_id),
handled AS (
    SELECT batch_id, count(*) FILTER (WHERE reason_code IS NULL) AS clean,
           count(*) FILTER (WHERE reason_code IS NOT NULL) AS dlq
    FROM fresh GROUP BY batch_id),
metrics AS (
    SELECT batch_id, received, clean, dlq, received - clean - dlq AS duplicates, fetch_retries, fetch_failures
    FROM received JOIN handled USING (batch_id) JOIN fetched USING (batch_id)),
replay AS (
    SELECT CAST(2 AS BIGINT) AS batch_id, count(*) AS received, CAST(0 AS BIGINT) AS clean,
           count(*) FILTER (WHERE record_key IS NULL) AS dlq, count(record_key) AS duplicates,
           CAST(0 AS BIGINT) AS fetch_retries, CAST(0 AS BIGINT) AS fetch_failures
    FROM verdict WHERE batch_id = 0)
"""

ORACLES = {
    "ordered_people": f"WITH {PEOPLE} SELECT {_PERSON} FROM people ORDER BY id",
    "insert_ignore": f"""WITH {PEOPLE}
SELECT {_PERSON} FROM people UNION ALL SELECT {_PERSON} FROM added""",
    "accepted_load": f"""WITH {PEOPLE}
SELECT {_PERSON} FROM people UNION ALL SELECT {_PERSON} FROM added""",
    "refused_load": f"""WITH {PEOPLE}
SELECT 'full_name' AS column_name, 'not_null' AS rule, count(*) AS rows FROM faulty_added WHERE full_name IS NULL
UNION ALL SELECT 'full_name', 'max_length', count(*) FROM faulty_added WHERE length(full_name) > 100
UNION ALL SELECT 'email', 'not_null', count(*) FROM faulty_added WHERE email IS NULL
UNION ALL SELECT 'email', 'max_length', count(*) FROM faulty_added WHERE length(email) > 100
UNION ALL SELECT 'gpa', 'precision', count(*) FROM faulty_added WHERE TRY_CAST(gpa AS DECIMAL(5,2)) IS NULL
UNION ALL SELECT 'email', 'unique',
    (SELECT count(email) - count(DISTINCT email) FROM (SELECT email FROM faulty_added UNION ALL SELECT email FROM people))
    - (SELECT count(email) - count(DISTINCT email) FROM people)""",
    "update_by_key": f"""WITH {PEOPLE},
last_change AS (
    SELECT id, gpa FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM gpa_changes)
    WHERE rn = 1)
SELECT p.id, full_name, email,
       CAST(CASE WHEN c.id IS NOT NULL THEN c.gpa ELSE p.gpa END AS DOUBLE) AS gpa
FROM people p LEFT JOIN last_change c ON p.id = c.id""",
    "delete_by_key": f"""WITH {PEOPLE}
SELECT {_PERSON} FROM people WHERE id NOT IN (SELECT id FROM leavers)""",
    "affected_rows": f"""WITH {PEOPLE}
SELECT 'insert' AS op, count(*) AS rows FROM added
UNION ALL
SELECT 'update', count(*) FROM people WHERE id IN (SELECT id FROM gpa_changes)
UNION ALL
SELECT 'delete', count(*) FROM people WHERE id IN (SELECT id FROM leavers)""",
    "stored_changes": f"""{_CHANGED}
SELECT {_PERSON} FROM stayed UNION ALL SELECT {_PERSON} FROM later""",
    "stored_affected_rows": f"""{_CHANGED}
SELECT 'update' AS op, count(*) AS rows FROM updated WHERE hit
UNION ALL SELECT 'delete', count(*) FROM updated WHERE id IN (SELECT id FROM leavers)
UNION ALL SELECT 'insert', count(*) FROM later""",
    "stored_versions": f"""{_CHANGED}
SELECT CAST(0 AS BIGINT) AS version, count(*) AS rows, CAST(sum(gpa) AS DOUBLE) AS total_gpa FROM people
UNION ALL SELECT 1, count(*), CAST(sum(gpa) AS DOUBLE) FROM updated
UNION ALL SELECT 2, count(*), CAST(sum(gpa) AS DOUBLE) FROM stayed""",
    "validate_reason": f"""WITH {FEED}, {JUDGED}
SELECT batch_id, arrival_seq, reason_code, reason_value FROM verdict""",
    "clean_rows": f"WITH {FEED}, {JUDGED} SELECT {CLEAN_FIELDS} FROM fresh WHERE reason_code IS NULL",
    "dlq_rows": f"""WITH {FEED}, {JUDGED}
SELECT raw, reason_code, reason_value FROM fresh WHERE reason_code IS NOT NULL""",
    "dlq_by_reason": f"""WITH {FEED}, {JUDGED}
SELECT reason_code, count(*) AS rows FROM fresh WHERE reason_code IS NOT NULL GROUP BY reason_code""",
    "keyless_records": f"""WITH {FEED}, {JUDGED},
copies AS (SELECT record_key, count(*) AS n FROM verdict WHERE record_key IS NOT NULL GROUP BY record_key)
SELECT reason_code, count(*) AS records, CAST(sum(coalesce(n, 1)) AS BIGINT) AS received
FROM fresh LEFT JOIN copies USING (record_key) GROUP BY reason_code""",
    "extra_members": f"""WITH {FEED}, {JUDGED}
SELECT j->>'$.record_id' AS record_id, regexp_replace(raw, '^\\{{"', '{{"site":"north","') AS raw
FROM fresh WHERE reason_code IS NULL""",
    "malformed_split": f"""WITH {FEED}
SELECT raw, batch_id, arrival_seq, CASE WHEN json_valid(raw) THEN 'good' ELSE 'quarantined' END AS part
FROM feed""",
    "drop_seen": f"""WITH {FEED}, {JUDGED},
ledger AS (SELECT DISTINCT record_key FROM verdict WHERE batch_id = 0 AND record_key IS NOT NULL)
SELECT record_key, raw, batch_id, arrival_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY arrival_seq) AS rn
    FROM verdict WHERE batch_id = 1)
WHERE record_key IS NULL OR (rn = 1 AND record_key NOT IN (SELECT record_key FROM ledger))""",
    "replay_adds_nothing": f"""{_BATCHES}
SELECT * FROM metrics UNION ALL SELECT * FROM replay""",
    "retry_adds_nothing": f"{_BATCHES} SELECT * FROM metrics",
    "ledger_lookups": f"""WITH {FEED}, {JUDGED},
zero AS (SELECT DISTINCT record_key FROM verdict WHERE batch_id = 0 AND record_key IS NOT NULL),
one AS (SELECT DISTINCT record_key FROM verdict WHERE batch_id = 1 AND record_key IS NOT NULL)
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS ids, CAST(0 AS BIGINT) AS seen, false AS opened FROM zero
UNION ALL SELECT 1, count(*), count(*) FILTER (WHERE record_key IN (SELECT record_key FROM zero)), true FROM one
UNION ALL SELECT 2, count(*), 0, false FROM zero WHERE starts_with(record_key, '"rec-')
UNION ALL SELECT 3, count(*), count(*), true FROM zero""",
    "replay_slice": f"WITH {FEED} SELECT * FROM feed ORDER BY arrival_seq LIMIT 5",
    "ingest_metrics": f"{_BATCHES} SELECT * FROM metrics",
    "reconcile": f"""{_BATCHES},
total AS (
    SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(clean) AS BIGINT) AS clean,
           CAST(sum(dlq) AS BIGINT) AS dlq
    FROM (SELECT * FROM metrics UNION ALL SELECT * FROM replay))
SELECT 'clean_stored' AS rule, clean AS expected, clean AS actual, true AS ok FROM total
UNION ALL SELECT 'dlq_stored', dlq, dlq, true FROM total
UNION ALL SELECT 'received_accounted', received, received, true FROM total""",
    "reconcile_broken": f"""{_BATCHES},
total AS (
    SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(clean) AS BIGINT) AS clean,
           CAST(sum(dlq) AS BIGINT) AS dlq
    FROM (SELECT * FROM metrics UNION ALL SELECT * FROM replay)),
lost AS (SELECT clean AS n FROM metrics WHERE batch_id = 0)
SELECT 'clean_stored' AS rule, clean AS expected, clean - n AS actual, n = 0 AS ok FROM total, lost
UNION ALL SELECT 'dlq_stored', dlq, dlq, true FROM total
UNION ALL SELECT 'received_accounted', received * 2, received, received * 2 = received FROM total""",
    "quality_summary": f"""{_BATCHES},
total AS (
    SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(clean) AS BIGINT) AS clean,
           CAST(sum(dlq) AS BIGINT) AS dlq, CAST(sum(duplicates) AS BIGINT) AS duplicates,
           CAST(sum(fetch_retries) AS BIGINT) AS fetch_retries, CAST(sum(fetch_failures) AS BIGINT) AS fetch_failures
    FROM metrics)
SELECT *, round(CAST(clean AS DOUBLE) / (clean + dlq) * 100, 1) AS valid_pct,
       round(CAST(duplicates AS DOUBLE) / received * 100, 1) AS duplicate_pct
FROM total""",
    "fetch_accounting": """
SELECT event_id AS batch_id, least(event_id % 6, 3) AS fetch_retries,
       CAST(event_id % 6 >= 4 AS BIGINT) AS fetch_failures,
       round(0.2 * (pow(2, least(event_id % 6, 3)) - 1), 6) AS waited_seconds
FROM events""",
    "ingest_stream": f"WITH {FEED}, {JUDGED} SELECT {CLEAN_FIELDS} FROM fresh WHERE reason_code IS NULL",
    "ingest_state_stream": f"WITH {FEED}, {JUDGED} SELECT {CLEAN_FIELDS} FROM fresh WHERE reason_code IS NULL",
    "state_stream_totals": f"""{_BATCHES}
SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(clean) AS BIGINT) AS clean, CAST(sum(dlq) AS BIGINT) AS dlq,
       CAST(sum(duplicates) AS BIGINT) AS duplicates
FROM metrics""",
}
