"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes; `conf` adds or overrides."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to, below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/millrace/{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, by: str | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """`df` written once as Parquet and read back.

    Cuts the lineage (a lost executor costs a re-read, not a re-computation) and gives
    Catalyst the true size, so that it broadcasts the table only when it is small.
    With `by` there is a folder for each value of that column. A row group is read by one task, so smaller ones let
    more tasks read a file.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.partitionBy(by) if by else df.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def on_file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path, as objects of the session's JVM."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    """Makes a folder on any file system Spark knows, unless it is there."""
    files, target = on_file_system(spark, path)
    files.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder on any file system Spark knows, if it is there."""
    files, target = on_file_system(spark, path)
    files.delete(target, True)


def release(*tables: DataFrame) -> None:
    """Deletes tables from `written` when all that reads them has been written itself.

    Not before: a lost executor may make Spark read them again. Other DataFrames are left alone.
    """
    for table in tables:
        path = getattr(table, "_written_to", None)
        if path:
            delete_folder(table.sparkSession, path)
