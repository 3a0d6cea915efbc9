"""Checks on whole tables: lost rows, broken keys, broken rules, differing results."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hour_number_text
from millrace.operators.dimensional import Tables, with_hour
from millrace.operators.ordering import numbered_within
from millrace.session import written


def unmatched_rows(tx: DataFrame, values: Tables) -> DataFrame:
    """(dimension, value, rows): source values without a key, and how many rows they would lose.

    Values are counted before they meet the dimension, so a value that fills a third of the
    source costs one row in the join.
    """
    source = with_hour(tx)
    pairs = [
        ("category", "category", "category_name"),
        ("status", "status", "status_name"),
        ("hour", "hour_number", "hour_number"),
    ]
    found = []
    for dimension, column, dim_column in pairs:
        counts = source.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("rows"))
        known = values[dimension].select(F.col(dim_column).alias("v"))
        shown = hour_number_text("v") if dimension == "hour" else F.col("v")
        found.append(
            counts.join(known, "v", "left_anti").select(
                F.lit(dimension).alias("dimension"), shown.alias("value"), "rows"
            )
        )
    return reduce(DataFrame.unionByName, found)


def load_guard(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: rows in, rows out, and whether they agree."""
    n_in = source.agg(F.count("*")).scalar()
    return (
        loaded.agg(F.count("*").alias("loaded_rows"))
        .select(n_in.alias("source_rows"), "loaded_rows")
        .withColumn("ok", F.col("source_rows") == F.col("loaded_rows"))
    )


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a null: (key..., rows, problem)."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .withColumn("problem", F.when(any_null, "null").when(F.col("rows") > 1, "duplicate"))
        .filter(F.col("problem").isNotNull())
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent and the child rows that carry them. A null key is allowed."""
    used = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("child_rows"))
    known = parent.select(F.col(pk).alias("__pk"))
    return used.join(known, used[fk] == known["__pk"], "left_anti")


@dataclass(frozen=True)
class Rule:
    """A column rule: not_null, max_length=n, precision=(digits, scale) or unique."""

    column: str
    kind: str
    limit: int = 0
    scale: int = 0


def not_null(column: str) -> Rule:
    return Rule(column, "not_null")


def max_length(column: str, limit: int) -> Rule:
    return Rule(column, "max_length", limit)


def precision(column: str, digits: int, scale: int) -> Rule:
    return Rule(column, "precision", digits, scale)


def unique(column: str) -> Rule:
    return Rule(column, "unique")


# The rules of the keyed table people(id, full_name, email, gpa, created_at).
PEOPLE_RULES = [
    not_null("full_name"), max_length("full_name", 100),
    not_null("email"), max_length("email", 100), unique("email"),
    precision("gpa", 5, 2),
]


def _breaks(rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "max_length":
        return c.isNotNull() & (F.char_length(c) > rule.limit)
    return c.isNotNull() & c.try_cast(f"decimal({rule.limit},{rule.scale})").isNull()


def check_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(column_name, rule, rows): rows that break each rule, 0 included.

    The row rules share one scan. A load is refused as a whole when any count is above 0.
    For `unique`, rows counts every non-null occurrence beyond the first.
    """
    row_rules = [r for r in rules if r.kind != "unique"]
    reports = []
    if row_rules:
        counted = df.agg(
            *[F.count_if(_breaks(r)).alias(f"rule_{i}") for i, r in enumerate(row_rules)]
        )
        entries = [
            F.struct(
                F.lit(r.column).alias("column_name"),
                F.lit(r.kind).alias("rule"),
                F.col(f"rule_{i}").alias("rows"),
            )
            for i, r in enumerate(row_rules)
        ]
        reports.append(counted.select(F.inline(F.array(*entries))))
    for rule in rules:
        if rule.kind == "unique":
            groups = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).count()
            reports.append(
                groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("rows")).select(
                    F.lit(rule.column).alias("column_name"), F.lit("unique").alias("rule"), "rows"
                )
            )
    return reduce(DataFrame.unionByName, reports)


def _close(a: Column, b: Column, rtol: float, atol: float) -> Column:
    gap = F.abs(a.cast("double") - b.cast("double"))
    return a.eqNullSafe(b) | F.coalesce(gap <= atol + rtol * F.abs(b.cast("double")), F.lit(False))


# The leaves and branches of the tree of checksums that `unlike` compares.
LEAVES, BRANCHES = 1 << 20, 1 << 10
# Rows of both sides in a leaf that one task may pair; a leaf above holds a key that fills many tasks.
MOST_ROWS = 1 << 20

_WIDTHS = [{"byte", "short", "integer", "long"}, {"float", "double"}]


def _comparable(a: DataFrame, b: DataFrame, columns: list[str]) -> tuple[list[Column], list[Column]]:
    """The columns of both sides, in one type where whole numbers or floats of two widths stand for one value."""
    left, right = [], []
    for c in columns:
        types = {a.schema[c].dataType.typeName(), b.schema[c].dataType.typeName()}
        wide = next((w for w, kind in zip(("long", "double"), _WIDTHS) if len(types) > 1 and types <= kind), None)
        left.append(F.col(c).cast(wide) if wide else F.col(c))
        right.append(F.col(c).cast(wide) if wide else F.col(c))
    return left, right


def _row_hash(columns: list[Column]) -> Column:
    """A hash of whole rows; a null in one column is told from a null in another."""
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


Pair = tuple[DataFrame, DataFrame]


def unlike(a: DataFrame, b: DataFrame, keys: list[str], leaf: str) -> tuple[Pair, Pair] | None:
    """The rows of `a` and `b` in those ranges of key hashes where the tables differ; None where they are equal.

    They come as two pairs: ranges of at most MOST_ROWS rows, which have equal keys of both sides in one range, and
    all others.

    Each range has a checksum that does not depend on the order of its rows: their number, sums and exclusive-or of
    row hashes. Tables are first compared by BRANCHES ranges; only where those differ, by LEAVES ranges. Both
    comparisons move one row a range and task, and never a row of the tables. Different rows have equal checksums
    with a chance of about 2^-64.
    """
    columns = [*keys, *[c for c in a.columns if c not in keys]]
    sides = [
        (df.withColumn(leaf, F.xxhash64(*values[: len(keys)]).bitwiseAND(LEAVES - 1)), _row_hash(values), sign)
        for df, values, sign in zip((a, b), _comparable(a, b, columns), (1, -1))
    ]

    def differing(place: Column, within: list[int] | None = None) -> DataFrame:
        branch = F.col(leaf).bitwiseAND(BRANCHES - 1)
        parts = []
        for df, hashed, sign in sides:
            rows = df if within is None or len(within) == BRANCHES else df.filter(branch.isin(within))
            parts.append(rows.select(place.alias("place"), hashed.alias("h"), F.lit(sign).alias("sign")))
        low, high = F.col("h").bitwiseAND(0xFFFFFF), F.shiftrightunsigned("h", 24).bitwiseAND(0xFFFFFF)
        sums = reduce(DataFrame.union, parts).groupBy("place").agg(
            F.sum("sign").alias("n"), F.sum(F.col("sign") * low).alias("low"), F.sum(F.col("sign") * high).alias("high"),
            F.bit_xor("h").alias("mixed"), F.count("*").alias("rows"),
        )
        return sums.filter("n <> 0 or low <> 0 or high <> 0 or mixed <> 0").select("place", "rows")

    branches = [r["place"] for r in differing(F.col(leaf).bitwiseAND(BRANCHES - 1)).collect()]
    if not branches:
        return None
    leaves = written(differing(F.col(leaf), branches), "leaves")
    kinds = [(a.schema[k].dataType, b.schema[k].dataType) for k in keys]
    # Keys of other types may be equal and have other hashes.
    hashed_alike = all(x == y or any({x.typeName(), y.typeName()} <= w for w in _WIDTHS) for x, y in kinds)
    small = (F.col("rows") <= MOST_ROWS) & F.lit(hashed_alike)
    large = leaves.filter(~small).count()

    def inside(some: DataFrame) -> Pair:
        # At most LEAVES numbers, so they may be broadcast whatever the tables hold.
        some = F.broadcast(some.select("place"))
        return tuple(df.join(some, F.col(leaf) == F.col("place"), "left_semi").drop(leaf) for df, _, _ in sides)

    nothing = a.filter(F.lit(False)), b.filter(F.lit(False))
    return inside(leaves.filter(small)) if hashed_alike else nothing, inside(leaves.filter(~small)) if large else nothing


def _paired(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of both sides paired by key, within a key in the order of their values, from one shuffle by key.

    Columns: the keys by number (k0...), in_a, in_b, the values of `a` (a0...) and of `b` (b0...).
    """
    places = range(len(values))

    def side(df: DataFrame, mine: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
            F.lit(mine == "a").alias("from_a"),
            *[
                (F.col(values[i]) if name == mine else F.lit(None).cast(other.schema[values[i]].dataType)).alias(f"{name}{i}")
                for name, other in (("a", a), ("b", b))
                for i in places
            ],
        )

    key = [f"k{i}" for i in range(len(keys))]
    columns = [f"{name}{i}" for name in "ab" for i in places]
    rows = side(a, "a").union(side(b, "b")).repartition(*key)
    order = columns or ["from_a"]
    numbered = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*key, "from_a").orderBy(*order)).cast("long"))
    # A number holds one row of a side at most, so the largest value is the only one.
    return numbered.groupBy(*key, "copy").agg(
        F.max("from_a").alias("in_a"),
        F.max(~F.col("from_a")).alias("in_b"),
        *[F.max(c).alias(c) for c in columns],
    )


def _paired_in_ranges(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The same as _paired where a key may hold any share of the rows: they are numbered range by range."""
    left, right = (
        numbered_within(side, keys, values, "copy").withColumn("here", F.lit(True)).alias(name)
        for name, side in (("a", a), ("b", b))
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "copy"]]
    here = F.col("a.here").isNotNull()
    return left.join(right, same, "full_outer").select(
        *[F.when(here, F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(f"k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.col("a.copy"), F.col("b.copy")).alias("copy"),
        here.alias("in_a"),
        F.col("b.here").isNotNull().alias("in_b"),
        *[F.col(f"{name}.{c}").alias(f"{name}{i}") for name in "ab" for i, c in enumerate(values)],
    )


def differences(
    a: DataFrame, b: DataFrame, keys: list[str], rtol: float = 1e-9, atol: float = 0.0
) -> DataFrame:
    """Rows of `a` and `b` that do not agree; none means the results are equal.

    Numbers agree within atol + rtol * |b|, everything else must be equal, null equals null.
    Rows are paired by key; rows that share a key are paired in the order of their values.
    Returns keys, `side` (left_only, right_only, both) and the columns of both sides.
    Checksums of key ranges come first (see `unlike`): equal tables are not moved, and of others only the ranges
    that differ are paired row by row: by one shuffle of both sides, and in ranges where a key is too large for a task.
    """
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    values = [c for c in a.columns if c not in keys]
    numeric = {
        f.name
        for f in a.schema
        if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")
    }
    found = unlike(a, b.select(*a.columns), keys, "__leaf")
    if found is None:
        found = ((a.filter(F.lit(False)), b.filter(F.lit(False))),) * 2
        paired = _paired(*found[0], keys, values)
    else:
        paired = _paired(*found[0], keys, values).unionByName(_paired_in_ranges(*found[1], keys, values))
    agree = [
        _close(F.col(f"a{i}"), F.col(f"b{i}"), rtol, atol) if c in numeric else F.col(f"a{i}").eqNullSafe(F.col(f"b{i}"))
        for i, c in enumerate(values)
    ]
    all_agree = reduce(Column.__and__, agree, F.col("in_a") & F.col("in_b"))
    side = F.when(~F.col("in_b"), "left_only").when(~F.col("in_a"), "right_only").otherwise("both")
    return paired.filter(~all_agree).select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
        side.alias("side"),
        *[F.col(f"a{i}").alias(f"{c}_left") for i, c in enumerate(values)],
        *[F.col(f"b{i}").alias(f"{c}_right") for i, c in enumerate(values)],
    )
