"""Validated ingest: drop what was seen, validate, split into clean and dead letter, account.

Feed: (raw STRING json, batch_id LONG, arrival_seq LONG), arrival_seq unique and increasing.

A batch writes five folders, `<sink>/batch_id=N`, each replaced as a whole, the ledger last.
The ledger is read for earlier batches only, so a batch that failed half-way and runs again
replaces its own output and neither loses nor doubles a record.

The ledger is bucketed by the record key, as a table of the session's catalog over the files below the
root. Beside it lies a Bloom filter of each batch's ids. The ids of a new batch are looked up in the filters; only
ids that some filter may hold are compared with the ledger, and only files of the batches and buckets those ids
point at are opened. Old batches can be joined into one by compact_ledger.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import share
from millrace.functions.record_rules import with_record_key, with_verdict
from millrace.operators.id_filter import FILTER_SCHEMA, filter_of, may_hold
from millrace.operators.keyed_tables import first_per_key, known_keys, without_keys
from millrace.session import delete_folder, make_folder, release, written

# The record's fields, the counters, and how often a fetch is tried.
RECORD_FIELDS = ["record_id", "timestamp", "sensor_id", "temperature", "humidity"]
COUNTERS = ["received", "clean", "dlq", "duplicates", "fetch_retries", "fetch_failures"]
FETCH_ATTEMPTS = 4
FETCH_BASE_WAIT = 0.2

# Chosen before the first batch, and the same for the life of a ledger.
LEDGER_BUCKETS = 16

SINK_SCHEMAS = {
    # `raw` is the record as it came, with members beyond the fields.
    "clean": "record_id string, timestamp string, sensor_id string, temperature double, humidity double, raw string",
    "dead_letter": "raw string, reason_code string, reason_value string, failed_at timestamp",
    "ledger": "record_key string",
    "ledger_filters": FILTER_SCHEMA,
    "metrics": ", ".join(f"{name} long" for name in COUNTERS),
}


# -- validation ---------------------------------------------------------------------------


def validate(feed: DataFrame) -> DataFrame:
    """The feed with reason_code (NULL when clean), reason_value, record_key and typed fields."""
    return with_verdict(feed)


def clean_rows(validated: DataFrame) -> DataFrame:
    """The typed fields, and the whole record as it came."""
    return validated.filter(F.col("reason_code").isNull()).select(*RECORD_FIELDS, "raw")


def dead_letters(validated: DataFrame) -> DataFrame:
    """The untouched record, why it failed and when."""
    return validated.filter(F.col("reason_code").isNotNull()).select(
        "raw", "reason_code", "reason_value", F.current_timestamp().alias("failed_at")
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_rows(validated), dead_letters(validated)


def dlq_by_reason(dead: DataFrame) -> DataFrame:
    return dead.groupBy("reason_code").agg(F.count("*").alias("rows"))


def split_malformed(stored: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Rows that parse as JSON, and the rows set aside because they do not."""
    parses = F.try_parse_json(F.col(raw)).isNotNull()
    return stored.filter(parses), stored.filter(~parses)


# -- idempotence --------------------------------------------------------------------------


def first_deliveries(feed: DataFrame) -> DataFrame:
    """One validated row per record id: its first delivery, and the number of deliveries.

    Records without an id (or with a nested one) are never copies of each other, whatever their
    arrival numbers. Validating before folding means one parse per record.
    """
    return first_per_key(validate(feed), "record_key", "arrival_seq", ties=F.xxhash64("raw"))


def drop_seen(feed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The feed without redelivered records; the first arrival of an id wins, valid or not."""
    first = first_per_key(with_record_key(feed), "record_key", "arrival_seq")
    fresh = without_keys(first, known_keys(first, ledger, "record_key"), "record_key")
    return fresh.select("record_key", *feed.columns)


# -- stored state -------------------------------------------------------------------------


def read_sink(spark: SparkSession, root: str, sink: str) -> DataFrame:
    schema = f"{SINK_SCHEMAS[sink]}, batch_id long"
    try:
        return spark.read.schema(schema).parquet(f"{root}/{sink}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _ledger_table(spark: SparkSession, root: str) -> str:
    """The ledger below `root` as a bucketed table of the session's catalog, with the batches found there."""
    make_folder(spark, f"{root}/ledger")
    name = f"ledger_{hashlib.md5(root.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (record_key STRING, batch_id BIGINT) USING parquet "
        f"PARTITIONED BY (batch_id) CLUSTERED BY (record_key) INTO {LEDGER_BUCKETS} BUCKETS "
        f"LOCATION '{root}/ledger'"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return name


def read_ledger(spark: SparkSession, root: str, before_batch: int) -> DataFrame:
    return spark.table(_ledger_table(spark, root)).filter(F.col("batch_id") < before_batch)


def ledger_places(keys: DataFrame, root: str, before_batch: int) -> tuple[DataFrame, list[int], list[int]]:
    """Keys that an earlier batch's filter may hold, and the batches and buckets of the ledger they point at.

    Batches without a filter (of a ledger that is older than the filters) count as if they held every key. The
    lists are short: batches that were not joined yet, and at most LEDGER_BUCKETS buckets.
    """
    spark = keys.sparkSession
    filters = read_sink(spark, root, "ledger_filters").filter(F.col("batch_id") < before_batch)
    bucket = F.pmod(F.hash("record_key"), F.lit(LEDGER_BUCKETS))
    asked = keys.filter(F.col("record_key").isNotNull()).select("record_key", bucket.alias("bucket"))
    listed = spark.sql(f"SHOW PARTITIONS {_ledger_table(spark, root)}").collect()
    stored = {b for b in (int(r["partition"].partition("=")[2]) for r in listed) if b < before_batch}
    bare = sorted(stored - {r["batch_id"] for r in filters.select("batch_id").distinct().collect()})
    hits = may_hold(filters, asked, "record_key")
    if bare:
        hits = hits.unionByName(asked.withColumn("batch_id", F.explode(F.array(*[F.lit(b) for b in bare]).cast("array<bigint>"))))
    hits = written(hits, "hits")
    places = hits.select("batch_id", "bucket").distinct().collect()
    return hits, sorted({r["batch_id"] for r in places}), sorted({r["bucket"] for r in places})


def ledger_part(spark: SparkSession, root: str, batches: list[int], buckets: list[int]) -> DataFrame:
    """The ids in these buckets of these batches. Other files are not opened: they are left out by their names."""
    if not batches:
        return spark.createDataFrame([], "record_key string, batch_id bigint")
    ledger = spark.table(_ledger_table(spark, root)).filter(F.col("batch_id").isin(batches))
    if len(buckets) < LEDGER_BUCKETS:
        numbers = "|".join(f"{b:05d}" for b in buckets)
        ledger = ledger.filter(F.col("_metadata.file_name").rlike(f"_({numbers})[.]"))
    return ledger.select("record_key", "batch_id")


def seen_before(first: DataFrame, root: str, batch_id: int) -> DataFrame:
    """The record keys of `first` (from first_per_key) that an earlier batch has handled."""
    hits, batches, buckets = ledger_places(first, root, batch_id)
    part = ledger_part(first.sparkSession, root, batches, buckets)
    return known_keys(hits, part, "record_key")


def _write_filter(ids: DataFrame, root: str, batch_id: int) -> None:
    _replace(filter_of(ids, "record_key", ids.count()), root, "ledger_filters", batch_id)


def _write_ledger(ids: DataFrame, root: str, batch_id: int) -> None:
    """Replaces the ids of one batch, a file a bucket."""
    spark = ids.sparkSession
    table = _ledger_table(spark, root)
    placed = ids.select("record_key").repartition(LEDGER_BUCKETS, "record_key")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT record_key FROM {{ids}}",
        ids=placed,
    )


def compact_ledger(spark: SparkSession, root: str, through_batch: int) -> None:
    """Joins the ids of all batches up to and including this one, so that few files are listed and opened.

    For batches that will not run again: a batch that did would find its own ids among the earlier ones.
    The joined ids are written before the old folders go, so a crash in between leaves ids twice, which
    changes nothing.
    """
    table = _ledger_table(spark, root)
    old = spark.table(table).filter(F.col("batch_id") <= through_batch)
    batches = [r["batch_id"] for r in old.select("batch_id").distinct().collect()]
    joined = written(old.select("record_key").distinct(), "ledger")
    _write_filter(joined, root, through_batch)
    _write_ledger(joined, root, through_batch)
    for batch_id in batches:
        if batch_id != through_batch:
            delete_folder(spark, _batch_path(root, "ledger_filters", batch_id))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch_id = {batch_id})")
            delete_folder(spark, _batch_path(root, "ledger", batch_id))
    release(joined)


def _batch_path(root: str, sink: str, batch_id: int) -> str:
    return f"{root}/{sink}/batch_id={batch_id}"


def _replace(df: DataFrame, root: str, sink: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch_path(root, sink, batch_id))


def ingest_batch(
    feed: DataFrame, batch_id: int, root: str, attempts: DataFrame | None = None
) -> None:
    """Handles one batch; running it again with the same batch_id changes nothing.

    `attempts` (batch_id, attempt, ok) is the log of fetches; without one no fetch failed.
    """
    first = first_deliveries(feed).persist()
    seen = None
    try:
        # The count also fills the cache, which tells Catalyst how small the batch is.
        received = first.agg(F.coalesce(F.sum("deliveries"), F.lit(0))).first()[0]
        seen = seen_before(first, root, batch_id).persist()
        seen.count()
        handled = without_keys(first, seen, "record_key")
        store_handled(handled, batch_id, root, received, attempts)
        # Written aside first: a table cannot be overwritten while it is read.
        ids = written(handled.filter(F.col("record_key").isNotNull()).select("record_key"), "ids")
        _write_filter(ids, root, batch_id)
        _write_ledger(ids, root, batch_id)
        release(ids)
    finally:
        first.unpersist()
        if seen is not None:
            seen.unpersist()


def store_handled(
    handled: DataFrame, batch_id: int, root: str, received: int, attempts: DataFrame | None = None
) -> None:
    """Replaces the clean records, dead letters and counters of one batch."""
    clean, dead = split(handled)
    _replace(clean, root, "clean", batch_id)
    _replace(dead, root, "dead_letter", batch_id)
    _replace(_stored_counters(handled.sparkSession, root, batch_id, received, attempts), root, "metrics", batch_id)


def _stored_counters(
    spark: SparkSession, root: str, batch_id: int, received: int, attempts: DataFrame | None
) -> DataFrame:
    """One metrics row. Counting what was just written reads no more than file footers."""

    def stored_rows(sink: str) -> Column:
        rows = spark.read.schema(SINK_SCHEMAS[sink]).parquet(_batch_path(root, sink, batch_id))
        return rows.agg(F.count("*")).scalar()

    counted = spark.range(0, 1, 1, 1).select(
        F.lit(received).cast("long").alias("received"),
        stored_rows("clean").alias("clean"),
        stored_rows("dead_letter").alias("dlq"),
        *_fetch_counters(attempts, batch_id),
    )
    return counted.withColumn("duplicates", F.col("received") - F.col("clean") - F.col("dlq")).select(*COUNTERS)


def _fetch_counters(attempts: DataFrame | None, batch_id: int) -> list[Column]:
    names = ["fetch_retries", "fetch_failures"]
    if attempts is None:
        return [F.lit(0).cast("long").alias(name) for name in names]
    mine = fetch_accounting(attempts.filter(F.col("batch_id") == batch_id))
    return [mine.agg(F.coalesce(F.sum(name), F.lit(0))).scalar().alias(name) for name in names]


# -- accounting ---------------------------------------------------------------------------


def batch_metrics(feed: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """Per-batch counters of a whole feed that starts from an empty ledger.

    The same figures ingest_batch stores, computed in one go: an id counts in the batch of
    its first arrival, every further delivery is a duplicate of the batch that brings it.
    """
    received = feed.groupBy("batch_id").agg(F.count("*").alias("received"))
    # The same choice as in first_deliveries, from verdicts without the records.
    verdicts = validate(feed).select("record_key", "arrival_seq", F.xxhash64("raw").alias("raw_hash"), "batch_id", "reason_code")
    first = first_per_key(verdicts, "record_key", "arrival_seq", ties=F.col("raw_hash"))
    handled = first.groupBy("batch_id").agg(
        F.count_if(F.col("reason_code").isNull()).alias("clean"),
        F.count_if(F.col("reason_code").isNotNull()).alias("dlq"),
    )
    zero = F.lit(0).cast("long")
    counted = received.join(handled, "batch_id", "left")
    if attempts is None:
        counted = counted.withColumn("fetch_retries", zero).withColumn("fetch_failures", zero)
    else:
        # A batch whose every fetch failed brought no record, and is counted all the same.
        counted = counted.join(fetch_accounting(attempts), "batch_id", "full_outer")
    counted = counted.select(
        "batch_id", *[F.coalesce(F.col(name), zero).alias(name) for name in COUNTERS if name != "duplicates"]
    )
    counted = counted.withColumn("duplicates", F.col("received") - F.col("clean") - F.col("dlq"))
    return counted.select("batch_id", *COUNTERS)


def total_metrics(metrics: DataFrame) -> DataFrame:
    """Counters over all batches; 0 before the first batch."""
    return metrics.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in COUNTERS])


def quality_summary(metrics: DataFrame) -> DataFrame:
    """Counters, with fetch retries and lost batches (fetch_failures), and shares in percent.

    Shares have one decimal and are NULL where the whole is 0.
    """
    total = total_metrics(metrics)
    unique = F.col("clean") + F.col("dlq")
    return total.select(
        "*",
        F.round(share("clean", unique) * 100, 1).alias("valid_pct"),
        F.round(share("duplicates", "received") * 100, 1).alias("duplicate_pct"),
    )


def reconcile(metrics: DataFrame, clean: DataFrame, dlq: DataFrame) -> DataFrame:
    """(rule, expected, actual, ok): stored rows against counters, counters against each other."""
    n_clean, n_dlq = clean.agg(F.count("*")).scalar(), dlq.agg(F.count("*")).scalar()
    total = total_metrics(metrics).withColumn("n_clean", n_clean).withColumn("n_dlq", n_dlq)

    def entry(rule: str, expected: Column, actual: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            expected.alias("expected"),
            actual.alias("actual"),
            (expected == actual).alias("ok"),
        )

    parts = reduce(Column.__add__, [F.col(c) for c in ("clean", "dlq", "duplicates")])
    return total.select(
        F.inline(
            F.array(
                entry("clean_stored", F.col("clean"), F.col("n_clean")),
                entry("dlq_stored", F.col("dlq"), F.col("n_dlq")),
                entry("received_accounted", F.col("received"), parts),
            )
        )
    )


def fetch_accounting(
    attempts: DataFrame, max_attempts: int = FETCH_ATTEMPTS, base: float = FETCH_BASE_WAIT
) -> DataFrame:
    """Per batch: retries, failures and seconds waited, from (batch_id, attempt, ok).

    A failed attempt is retried after base * 2^(attempt - 1); the last one allowed is a failure.
    """
    failed = ~F.col("ok")
    retried = failed & (F.col("attempt") < max_attempts)
    wait = F.when(retried, F.lit(base) * F.pow(F.lit(2.0), F.col("attempt") - 1)).otherwise(0.0)
    return attempts.groupBy("batch_id").agg(
        F.count_if(retried).alias("fetch_retries"),
        F.count_if(failed & (F.col("attempt") >= max_attempts)).alias("fetch_failures"),
        F.round(F.sum(wait), 6).alias("waited_seconds"),
    )
