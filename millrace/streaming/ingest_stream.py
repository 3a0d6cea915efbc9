"""The same ingest over a stream of micro-batches, with the ledger or with Spark's state store as its memory."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.record_rules import with_record_key
from millrace.operators.ingest import first_deliveries, ingest_batch, store_handled
from millrace.session import release, written

FEED_SCHEMA = "raw string, batch_id long, arrival_seq long"


def feed_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet feed files as a stream, oldest file first."""
    reader = spark.readStream.schema(FEED_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


# Validation costs far more than moving a record, so that a micro-batch of few files is dealt over all cores first.
ROW_GROUP_BYTES = 4 << 20


def _dealt(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch, evenly over twice as many tasks as there are cores."""
    return batch.repartition(2 * batch.sparkSession.sparkContext.defaultParallelism)


def run_ingest_stream(
    source: DataFrame, root: str, available_now: bool = True, interval: str = "30 seconds"
) -> StreamingQuery:
    """Starts the ingest of `source` into `root`.

    The progress log lives beside the sinks: micro-batch numbers and stored batch numbers
    belong together, and a restart goes on where the last run stopped.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        source.writeStream.option("checkpointLocation", f"{root}/progress")
        .trigger(**trigger)
        .foreachBatch(lambda batch, batch_id: ingest_batch(_dealt(batch), batch_id, root))
        .start()
    )


# Keys lie in RocksDB on the executors, beyond the heap, and only what a batch added goes to the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for a query that starts inside; it keeps them, the session does not."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def with_new_keys(source: DataFrame) -> DataFrame:
    """The records of a stream, and beside them one row for each record key that the stream never had before.

    The stream's state is the set of keys it has seen, for good and nothing else: no watermark forgets one. Records
    without a key are not part of it. `is_key` tells the two kinds of rows apart.
    """
    keys = with_record_key(source).select("record_key").filter(F.col("record_key").isNotNull())
    fresh = keys.dropDuplicates(["record_key"]).withColumn("is_key", F.lit(True))
    rows = source.withColumn("is_key", F.lit(False))
    return rows.unionByName(fresh, allowMissingColumns=True)


def _ingest_with_state(batch: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch of with_new_keys: the first delivery of each new key, and every record without a key.

    The batch is written once, so the state is asked once; a repeated batch starts from the state before it and
    replaces what it had stored. Records and keys lie in folders of their own: among the many small files of keys,
    Spark would put all files of records into one task.
    """
    batch = written(batch, "microbatch", by="is_key", row_group_bytes=ROW_GROUP_BYTES)
    rows = batch.filter(~F.col("is_key")).select("raw", "batch_id", "arrival_seq")
    fresh = batch.filter("is_key").select("record_key", F.lit(-1).cast("long").alias("own_row"), F.lit(True).alias("is_new"))
    # Joined as first_per_key has placed them: a record without a key has an own_row that no key has.
    first = first_deliveries(rows).join(fresh, ["record_key", "own_row"], "left")
    handled = written(first.filter(F.col("record_key").isNull() | F.col("is_new")).drop("is_new"), "handled")
    store_handled(handled, batch_id, root, rows.count())
    release(batch, handled)


def run_state_stream(
    source: DataFrame, root: str, available_now: bool = True, interval: str = "30 seconds"
) -> StreamingQuery:
    """Starts the ingest of `source` into `root` with the handled ids in the keyed state store instead of the ledger.

    A micro-batch looks up its own ids only, wherever the ids of all earlier ones lie. The state is below
    `<root>/progress` with the offsets: a restart goes on with both. A root belongs to one kind of ingest.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with _settings(source.sparkSession, STATE_STORE):
        return (
            with_new_keys(source)
            .writeStream.option("checkpointLocation", f"{root}/progress")
            .outputMode("append")
            .trigger(**trigger)
            .foreachBatch(lambda batch, batch_id: _ingest_with_state(batch, batch_id, root))
            .start()
        )
