"""Deletes runs of lines that repeat an earlier run, found by winnowing over line hashes.

The lines of a text are its parts between \\n, trimmed; blank lines take no part and stay. A run is
`window` consecutive lines, or one line of at least `long_line_words` words. A line goes if a run that
covers it also starts earlier: in a smaller doc_id (null first), or before in the same document.
So the first occurrence of every line stays.

How it is found, by DataFrame functions only:

1. Every line is hashed in its row; of each `window` consecutive hashes the smallest is a
   fingerprint, and so is each long line. A run that repeats holds the same fingerprint wherever it
   stands, so it is enough to look near fingerprints that occur more than once.
2. Fingerprints are counted by hash (folded before they are shuffled).
3. Around each fingerprint with several places, every run that covers it is compared, to the left and
   to the right; since each run of a longer match covers a fingerprint, a match is followed to its ends.
4. A run's hash is folded to its first place; the others are deleted. Rows with a hot hash are only
   folded or joined to the one row of that hash, never paired with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shingles import let
from millrace.session import written


def _hash(text: Column) -> Column:
    """60 bits of MD5, so that SQL engines can compute the same."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def with_lines(docs: DataFrame, long_line_words: int) -> DataFrame:
    """d (the doc_id) and, of its lines that are not blank, in order: h (hashes), at (line numbers from 1), long."""
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.trim(x).alias("line"), (i + 1).alias("at"))),
        lambda x: x["line"] != "",
    )
    return (
        docs.select(F.col("doc_id").alias("d"), lines.alias("lines"))
        .select(
            "d",
            F.transform("lines", lambda x: _hash(x["line"])).alias("h"),
            F.transform("lines", lambda x: x["at"]).alias("at"),
            F.transform("lines", lambda x: F.size(F.split(x["line"], " ")) >= long_line_words).alias("long"),
        )
    )


def repeated_lines(docs: DataFrame, window: int = 2, long_line_words: int = 50) -> DataFrame:
    """doc_id and `gone`, the numbers (from 1) of its lines that go; one row per doc_id that loses lines.

    doc_id should tell documents apart: rows that share one lose the lines that any of them loses.
    """
    if window < 2:
        raise ValueError("a run needs at least two lines")
    lines = written(with_lines(docs, long_line_words), "lines").where(F.size("h") > 0)
    n, w = F.size("h"), F.lit(window)

    # Fingerprints: the smallest hash of each window (its first place), and long lines.
    minima = F.transform(
        F.sequence(F.lit(1), F.greatest(n - w + 1, F.lit(1))),
        lambda i: i + F.array_position(F.slice("h", i, w), F.array_min(F.slice("h", i, w))).cast("int") - 1,
    )
    longs = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("long", i))
    prints = lines.select("d", "h", F.explode(F.array_distinct(F.concat(minima, longs))).alias("pos"))
    prints = prints.select("d", F.element_at("h", F.col("pos")).alias("f"), "pos")
    several = prints.groupBy("f").agg(F.count("*").alias("times")).where("times > 1").select("f")
    near = prints.join(several, "f", "left_semi").groupBy("d").agg(F.collect_set("pos").alias("near"))

    # All runs that cover such a place, and the long lines there, each a run of one.
    joined = lines.alias("l").join(near.alias("n"), F.expr("l.d <=> n.d")).select("l.d", "h", "at", "long", "near")
    starts = F.filter(
        F.array_distinct(F.flatten(F.transform("near", lambda p: F.sequence(F.greatest(p - w + 1, F.lit(1)), p)))),
        lambda i: i + w - 1 <= n,
    )
    runs = F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice("h", i, w)).alias("run"), F.slice("at", i, w).alias("covers")))
    singles = F.transform(
        F.filter("near", lambda p: F.element_at("long", p)),
        lambda p: F.struct(F.element_at("h", p).alias("run"), F.slice("at", p, 1).alias("covers")),
    )
    placed = joined.select("d", F.explode(F.concat(runs, singles)).alias("r")).select("d", "r.run", "r.covers")
    placed = written(placed.withColumn("len", F.size("covers")), "runs")
    at = F.element_at("covers", 1)
    first = (
        placed.groupBy("run", "len")
        .agg(F.min(F.struct("d", at.alias("at"))).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select("run", "len", F.col("first.d").alias("fd"), F.col("first.at").alias("fat"))
    )
    later = placed.join(first, ["run", "len"]).where(~(F.col("d").eqNullSafe(F.col("fd")) & (at == F.col("fat"))))
    return later.groupBy(F.col("d").alias("doc_id")).agg(F.array_distinct(F.flatten(F.collect_list("covers"))).alias("gone"))


def without_repeats(docs: DataFrame, window: int = 2, long_line_words: int = 50) -> DataFrame:
    """`docs`, every row and column, its text without repeated lines; then n_lines and n_removed.

    n_lines counts the lines that were not blank. Kept lines, blank ones included, stand in their order
    joined by \\n, unchanged. A null text stays null with no lines. Columns already called n_lines or
    n_removed are replaced.
    """
    gone = repeated_lines(docs, window, long_line_words).select(F.col("doc_id").alias("__d"), F.col("gone").alias("__gone"))
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__d"]), "left")
    text, taken = docs["text"], gone["__gone"]
    kept = let(
        F.split(text, "\n"),
        lambda all: F.transform(F.array_except(F.sequence(F.lit(1), F.size(all)), taken), lambda i: F.element_at(all, i)),
    )
    untouched = taken.isNull() | text.isNull()
    out = {c: docs[f"`{c}`"] for c in docs.columns}
    out["text"] = F.when(untouched, text).otherwise(F.concat_ws("\n", kept))
    out["n_lines"] = F.when(text.isNull(), 0).otherwise(F.size(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")))
    out["n_removed"] = F.when(untouched, 0).otherwise(F.size(taken))
    return rows.select(*[value.alias(name) for name, value in out.items()])
