"""Insert-ignore, update and delete by key as batch operations that return the new table.

Plain Parquet tables cannot change in place: write the result to a new path, then switch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.checks import Rule, check_rules
from millrace.session import written


def first_per_key(
    df: DataFrame, key: str, order_by: str, copies: str = "deliveries", ties: Column | None = None
) -> DataFrame:
    """The first row per key in the order of `order_by`, with a copy count.

    Ties in `order_by` (a null comes first) go by `ties`, then by the other columns. Rows with a null key are no
    copies of each other: each stays a row of its own, told apart by its place in its partition. The
    copies of a key are folded before the shuffle, so one key may hold any share of the rows.
    """
    rest = [c for c in df.columns if c not in (key, order_by)]
    own_row = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long"))
    folded = (
        df.withColumn("own_row", own_row)
        .groupBy(key, "own_row")
        .agg(F.min(F.struct(order_by, *([ties.alias("ties")] if ties is not None else []), *rest)).alias("first"), F.count("*").alias(copies))
    )
    return folded.select(key, "own_row", *[f"first.{c}" for c in (order_by, *rest)], copies)


def known_keys(first: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The keys of `first` (from first_per_key) that `known` holds already.

    `known` may be far larger than `first`: while the keys of `first` are few they are
    broadcast, and `known` is read (its key column only) but never shuffled.
    """
    wanted = first.filter(F.col(key).isNotNull()).select(key)
    return known.select(key).join(wanted, key, "left_semi").distinct()


def without_keys(first: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of `first` (from first_per_key) whose key is not in `known`; null keys all stay."""
    marked = known.withColumn("own_row", F.lit(-1).cast("long"))
    return first.join(marked, [key, "own_row"], "left_anti")


def broken_rules(added: DataFrame, rest: DataFrame, rules: list[Rule]) -> DataFrame:
    """(column_name, rule, rows): what `added` would break in a table that holds `rest` too.

    For `unique`, rows counts the values of `added` that occur in it before or in `rest`. Every rule reads
    `added`, so it is written once, unless it has been: left in the plan, the joins that make it are pushed below
    the groups of the unique rule, where they sort rows that were not folded.
    """
    if not hasattr(added, "_written_to"):
        added = written(added.select(*dict.fromkeys(r.column for r in rules)), "added")
    row_rules = [r for r in rules if r.kind != "unique"]
    reports = [check_rules(added, row_rules)] if row_rules else []
    for rule in rules:
        if rule.kind == "unique":
            value = F.col(rule.column)
            new = added.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count("*").alias("n"))
            old = rest.select(value.alias("v")).join(new, "v", "left_semi").distinct().withColumn("old", F.lit(1))
            taken = F.coalesce(F.sum(F.col("n") - 1 + F.coalesce("old", F.lit(0))), F.lit(0))
            reports.append(
                new.join(old, "v", "left").agg(taken.alias("rows")).select(
                    F.lit(rule.column).alias("column_name"), F.lit("unique").alias("rule"), "rows"
                )
            )
    return reduce(DataFrame.unionByName, reports)


def refuse_if_broken(df: DataFrame, rules: list[Rule], rest: DataFrame | None = None) -> None:
    """Raises when `df` breaks a rule, alone or beside `rest`: a load is taken as a whole or not at all."""
    report = check_rules(df, rules) if rest is None else broken_rules(df, rest, rules)
    broken = [r for r in report.collect() if r["rows"]]
    if broken:
        found = ", ".join(f"{r['column_name']} {r['rule']} ({r['rows']} rows)" for r in broken)
        raise ValueError(f"rules broken: {found}")


def new_rows(target: DataFrame, incoming: DataFrame, key: str, order_by: str) -> DataFrame:
    """What insert-ignore would add: the first arrival per key, unless the target has the key.

    Rows with a null key are among them, so that rules can refuse them.
    """
    first = first_per_key(incoming, key, order_by)
    return without_keys(first, known_keys(first, target, key), key).select(*incoming.columns)


def with_defaults(
    rows: DataFrame, target: DataFrame, order_by: str, id_column: str = "id",
    time_column: str | None = "created_at",
) -> DataFrame:
    """Adds the column defaults: an id that continues the target's ids, and the load time.

    Ids follow the arrival number, so they are unique and increasing but have gaps where an
    arrival was ignored. No ordering of the rows is needed for that.
    """
    last_id = target.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    rows = rows.withColumn(id_column, (last_id + F.col(order_by) + 1).cast("long"))
    return rows.withColumn(time_column, F.current_timestamp()) if time_column else rows


def insert_ignore(
    target: DataFrame, incoming: DataFrame, key: str, order_by: str, rules: list[Rule] | None = None
) -> DataFrame:
    """Target plus new rows. `incoming` has the target's columns and the arrival number.

    With `rules` the rows to add are written first and checked, beside the target; one broken rule
    refuses the whole load (ValueError). A row with a null key is never inserted.
    """
    added = new_rows(target, incoming, key, order_by).select(*target.columns)
    if rules:
        added = written(added, "added")
        refuse_if_broken(added, rules, target)
    return target.unionByName(added.filter(F.col(key).isNotNull()))


def last_change_per_key(changes: DataFrame, key: str, cols: list[str], order_by: str) -> DataFrame:
    return (
        changes.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(order_by, *cols)).alias("change"))
    )


def update_by_key(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    cols: list[str],
    order_by: str,
    rules: list[Rule] | None = None,
) -> DataFrame:
    """Sets `cols` from the last change per key. A NULL in the change is written as NULL.

    With `rules` the new values are checked as they come, before they are cast to the target's
    types, and uniqueness in the table that results; one broken rule refuses the whole update.
    """
    if rules:
        last = last_change_per_key(changes, key, cols, order_by).join(target.select(key), key, "left_semi")
        row_rules = [r for r in rules if r.kind != "unique" and r.column in cols]
        if row_rules:
            refuse_if_broken(last.select(key, "change.*"), row_rules)
    joined = target.join(last_change_per_key(changes, key, cols, order_by), key, "left")
    hit = F.col("change").isNotNull()
    updated = joined.select(
        *[
            F.when(hit, F.col(f"change.{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in cols
            else F.col(c)
            for c in target.columns
        ]
    )
    distinct = [r for r in rules or [] if r.kind == "unique" and r.column in cols]
    if distinct:
        updated = written(updated, "updated")
        refuse_if_broken(updated, distinct)
    return updated


def delete_by_key(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti")


def affected_rows(
    target: DataFrame,
    key: str,
    order_by: str,
    inserts: DataFrame | None = None,
    updates: DataFrame | None = None,
    deletes: DataFrame | None = None,
) -> DataFrame:
    """(op, rows): how many rows each operation adds, changes or removes on this target."""
    hit = {}
    if inserts is not None:
        hit["insert"] = new_rows(target, inserts, key, order_by).filter(F.col(key).isNotNull())
    if updates is not None:
        hit["update"] = target.join(updates.select(key).distinct(), key, "left_semi")
    if deletes is not None:
        hit["delete"] = target.join(deletes.select(key).distinct(), key, "left_semi")
    counts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(op).alias("op"), "rows")
        for op, rows in hit.items()
    ]
    return reduce(DataFrame.unionByName, counts)
