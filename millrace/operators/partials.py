"""Aggregates that are kept as mergeable states, one per batch, and folded when they are read.

A state is a table of keys and columns that merge by sum, least or greatest value. A new batch is folded on its own and
stored beside the others, so it costs its own rows, whatever came before; a repeated batch replaces what it had
stored. Readers fold the states of all batches. What is current is named by a commit (see sources/commits).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import amount_of_parts, amount_parts, share
from millrace.session import delete_folder
from millrace.sources import commits


@dataclass(frozen=True)
class State:
    """Which columns are keys, and how each other column merges: sum, min or max."""

    keys: tuple[str, ...]
    merge: dict[str, str]

    def fold(self, rows: DataFrame) -> DataFrame:
        folds = {"sum": F.sum, "min": F.min, "max": F.max}
        return rows.groupBy(*self.keys).agg(*[folds[how](c).alias(c) for c, how in self.merge.items()])


def _current(spark: SparkSession, root: str) -> tuple[int, dict]:
    version, state = commits.read(spark, root)
    return version, state or {"joined_through": None, "joined": None, "batches": {}, "schema": None}


def _write(rows: DataFrame, root: str) -> str:
    folder = f"states/{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/{folder}")
    return folder


def add_batch(rows: DataFrame, state: State, root: str, batch_id: int) -> None:
    """Folds the rows of one batch and makes them part of the aggregate, in place of what the batch held before."""
    spark = rows.sparkSession
    version, current = _current(spark, root)
    if current["joined_through"] is not None and batch_id <= current["joined_through"]:
        raise ValueError(f"batch {batch_id} was joined with others and cannot come again")
    folded = state.fold(rows)
    schema = StructType([type(f)(f.name, f.dataType) for f in folded.schema]).jsonValue()
    folder = _write(folded, root)
    replaced = current["batches"].get(str(batch_id))
    commits.commit(spark, root, version, current | {"schema": schema, "batches": current["batches"] | {str(batch_id): folder}})
    if replaced:
        delete_folder(spark, f"{root}/{replaced}")


def folded(spark: SparkSession, root: str, state: State) -> DataFrame:
    """The aggregate over all batches."""
    _, current = _current(spark, root)
    if current["schema"] is None:
        raise FileNotFoundError(f"no batch was stored at {root}")
    folders = [*filter(None, [current["joined"]]), *current["batches"].values()]
    return state.fold(spark.read.schema(StructType.fromJson(current["schema"])).parquet(*[f"{root}/{f}" for f in folders]))


def join_batches(spark: SparkSession, root: str, state: State) -> None:
    """Folds all batches so far into one state, for batches that will not come again."""
    version, current = _current(spark, root)
    if not current["batches"]:
        return
    folder = _write(folded(spark, root, state), root)
    through = max(int(b) for b in current["batches"])
    commits.commit(spark, root, version, current | {"joined_through": through, "joined": folder, "batches": {}})
    for old in [*filter(None, [current["joined"]]), *current["batches"].values()]:
        delete_folder(spark, f"{root}/{old}")


# -- daily revenue --------------------------------------------------------------------------

DAILY_REVENUE = State(("category", "status", "day"), {"transactions": "sum", "upper": "sum", "lower": "sum"})


def daily_amounts(tx: DataFrame, digits: int) -> DataFrame:
    """Transactions as rows of DAILY_REVENUE: a count, and the amount in two whole parts that add up exactly."""
    upper, lower = amount_parts("amount", digits)
    return tx.select(
        "category", "status", F.to_date("timestamp").alias("day"),
        F.lit(1).cast("bigint").alias("transactions"), upper.alias("upper"), lower.alias("lower"),
    )


def daily_revenue(spark: SparkSession, root: str, digits: int, status: str | None = None) -> DataFrame:
    """category, day, transactions, revenue over all batches, of one status or all."""
    kept = folded(spark, root, DAILY_REVENUE)
    if status is not None:
        kept = kept.filter(F.col("status") == status)
    return kept.groupBy("category", "day").agg(
        F.sum("transactions").alias("transactions"),
        amount_of_parts(F.sum("upper"), F.sum("lower"), digits).alias("revenue"),
    )


# -- sessions -------------------------------------------------------------------------------

SESSIONS = State(("user_id", "session_id"), {"events": "sum", "first_ms": "min", "last_ms": "max"})


def session_bounds(logs: DataFrame) -> DataFrame:
    """Events as rows of SESSIONS."""
    at = F.col("event_timestamp")
    return logs.select("user_id", "session_id", F.lit(1).cast("bigint").alias("events"), at.alias("first_ms"), at.alias("last_ms"))


def session_durations(spark: SparkSession, root: str) -> DataFrame:
    """(user_id, session_id, events, duration_ms) over all batches; a session may have events in several."""
    return folded(spark, root, SESSIONS).select("user_id", "session_id", "events", (F.col("last_ms") - F.col("first_ms")).alias("duration_ms"))


def average_session_duration(spark: SparkSession, root: str) -> DataFrame:
    """One row: mean duration and number of sessions over all batches."""
    sums = session_durations(spark, root).agg(F.sum("duration_ms").alias("total"), F.count("*").alias("sessions"))
    return sums.select(share("total", "sessions").alias("avg_duration_ms"), "sessions")
