"""Shuffle totals per job group, from Spark's own event log.

The log must be plain JSON: spark.eventLog.enabled=true, spark.eventLog.compress=false,
spark.eventLog.rolling.enabled=false, spark.eventLog.dir=<folder>.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = """
    Event string,
    `Stage IDs` array<int>,
    Properties map<string,string>,
    `Stage ID` int,
    `Stage Attempt ID` int,
    `Task End Reason` struct<Reason: string>,
    `Task Metrics` struct<
        `Shuffle Read Metrics`: struct<
            `Remote Bytes Read`: bigint, `Local Bytes Read`: bigint, `Total Records Read`: bigint>,
        `Shuffle Write Metrics`: struct<
            `Shuffle Bytes Written`: bigint, `Shuffle Records Written`: bigint>>
"""


def shuffle_totals(spark: SparkSession, event_log_path: str) -> DataFrame:
    """(job_group, write_mb, read_mb, write_records, stages, tasks) of successful tasks.

    Tasks are folded per stage before they meet the job groups; stages that a job lists but
    skipped have no task and do not count.
    """
    log = spark.read.schema(_SCHEMA).json(event_log_path)
    group = F.col("Properties").getItem("spark.jobGroup.id")
    stages = (
        log.filter((F.col("Event") == "SparkListenerJobStart") & group.isNotNull())
        .select(group.alias("job_group"), F.explode("Stage IDs").alias("stage_id"))
        .distinct()
    )
    read = F.col("Task Metrics.Shuffle Read Metrics")
    write = F.col("Task Metrics.Shuffle Write Metrics")
    tasks = (
        log.filter(
            (F.col("Event") == "SparkListenerTaskEnd")
            & (F.col("Task End Reason.Reason") == "Success")
        )
        .groupBy(F.col("Stage ID").alias("stage_id"))
        .agg(
            F.sum(write["Shuffle Bytes Written"]).alias("written"),
            F.sum(read["Remote Bytes Read"] + read["Local Bytes Read"]).alias("read"),
            F.sum(write["Shuffle Records Written"]).alias("records"),
            F.count("*").alias("tasks"),
        )
    )
    megabyte = 1024 * 1024
    return (
        stages.join(tasks, "stage_id")
        .groupBy("job_group")
        .agg(
            (F.sum("written") / megabyte).alias("write_mb"),
            (F.sum("read") / megabyte).alias("read_mb"),
            F.sum("records").alias("write_records"),
            F.count("*").alias("stages"),
            F.sum("tasks").alias("tasks"),
        )
    )
