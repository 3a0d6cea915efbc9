"""Surrogate keys that outlive a load: a value keeps the key it was first given, new values get the next ones.

A registry is a folder with one Parquet folder of (key, columns) per load that brought new values, and commits that list
them (see sources/commits). A load compares its distinct values with the registry, numbers the new ones in
sorted order range by range, and commits them after the last key so far. Old keys are never written again, and a
load that fails, or runs again, takes no numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.ordering import dense_keys
from millrace.session import delete_folder, release, written
from millrace.sources import commits


def registered(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(key, columns) of all loads up to this version, the latest by default."""
    found, state = commits.read(spark, root, version)
    if found == -1:
        raise FileNotFoundError(f"no registry at {root}")
    schema = StructType.fromJson(state["schema"])
    if not state["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in state["folders"]])


def extend(df: DataFrame, columns: list[str], key: str, root: str, key_type: str = "int") -> DataFrame:
    """The registry after adding the distinct values of `columns` in `df`. Values with a null have no key."""
    spark = df.sparkSession
    version, state = commits.read(spark, root)
    values = df.select(*columns).dropna()
    if version == -1:
        schema = values.select(F.lit(0).cast(key_type).alias(key), *columns).schema
        # Columns of a registry are as nullable as files make them.
        state = {"last": 0, "folders": [], "schema": StructType([type(f)(f.name, f.dataType) for f in schema]).jsonValue()}
    elif [f["name"] for f in state["schema"]["fields"]] != [key, *columns]:
        raise ValueError(f"the registry at {root} keys other columns")
    else:
        values = values.distinct().join(registered(spark, root, version), columns, "left_anti")
    fresh = written(dense_keys(values, columns, "__place", "bigint"), "keys")
    count = fresh.count()
    if count or version == -1:
        folder = f"keys/{uuid.uuid4().hex}"
        numbered = fresh.select((F.col("__place") + state["last"]).cast(key_type).alias(key), *columns)
        numbered.write.parquet(f"{root}/{folder}")
        try:
            commits.commit(spark, root, version, state | {"last": state["last"] + count, "folders": [*state["folders"], folder]})
        except commits.CommitConflict:
            delete_folder(spark, f"{root}/{folder}")
            raise
    release(fresh)
    return registered(spark, root)
