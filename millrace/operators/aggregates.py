"""Plain aggregates and the reports over timing samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import exact_sum, share
from millrace.operators.ordering import running_total
from millrace.session import written


def sum_by(
    df: DataFrame, key: str, value: str, out: str = "total", digits: int | None = None
) -> DataFrame:
    """Sum per non-null key; a key with nothing but nulls sums to 0. `digits` as in exact_sum."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(exact_sum(value, digits), F.lit(0.0)).alias(out))
    )


def filtered_stats(
    df: DataFrame, predicate: Column, value: str, digits: int | None = None
) -> DataFrame:
    """One row: how many rows pass, and the mean of the values among them that are not NULL or NaN."""
    return (
        df.filter(predicate)
        .agg(
            F.count("*").alias("count"),
            exact_sum(value, digits).alias("total"),
            F.count(F.when(~F.isnan(value), F.col(value))).alias("present"),
        )
        .select("count", share("total", "present").alias("mean_amount"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows), ordered by name."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def timing_summary(
    df: DataFrame, label: str = "label", value: str = "seconds", spread: float = 0.001, accuracy: int = 10_000
) -> DataFrame:
    """Exact median, min, max and number of samples per label.

    A mergeable quantile sketch of each label gives two values with the median between them: ranks `spread` to either
    side, which is ten times the sketch's error. A second pass counts the samples below, and folds those between;
    only these, two in a thousand and ties folded, are put in order to pick the medians by rank. No label has to fit in
    a task, and no ordered copy of the samples is made.
    """
    samples = df.filter(F.col(value).isNotNull()).select(label, value)
    near = F.percentile_approx(value, [0.5 - spread, 0.5 + spread], accuracy)
    shape = samples.groupBy(label).agg(
        F.count("*").alias("runs"), F.min(value).alias("min_seconds"), F.max(value).alias("max_seconds"), near.alias("near")
    )
    # The sketch has no place for NaN, which counts as the greatest value.
    odd = F.isnan(F.col("max_seconds").cast("double"))
    labels = written(shape.select(
        label, "runs", "min_seconds", "max_seconds",
        F.when(odd, F.col("min_seconds")).otherwise(F.col("near")[0]).alias("low"),
        F.when(odd, F.col("max_seconds")).otherwise(F.col("near")[1]).alias("high"),
    ), "labels")
    same_label = F.col(f"s.{label}").eqNullSafe(F.col(f"l.{label}"))
    met = samples.alias("s").join(labels.alias("l"), same_label).filter(F.col(f"s.{value}") <= F.col("l.high"))
    between = F.when(F.col(f"s.{value}") >= F.col("l.low"), F.col(f"s.{value}"))
    folded = met.groupBy(F.col(f"s.{label}").alias(label), between.alias(value)).agg(F.count("*").alias("copies"))
    folded = written(folded, "near-median")
    below = folded.filter(F.col(value).isNull()).select(label, F.col("copies").alias("below"))

    ranked = running_total(folded.filter(F.col(value).isNotNull()), [label, value], "copies", "through")
    starts = ranked.groupBy(label).agg(F.min(F.col("through") - F.col("copies")).alias("base"))
    starts = starts.alias("s").join(below.alias("b"), F.col(f"s.{label}").eqNullSafe(F.col(f"b.{label}")), "left")
    starts = starts.select(f"s.{label}", (F.col("base") - F.coalesce("below", F.lit(0))).alias("base")).alias("s")
    placed = ranked.alias("r").join(starts, F.col(f"r.{label}").eqNullSafe(F.col(f"s.{label}"))).join(
        labels.alias("l"), F.col(f"r.{label}").eqNullSafe(F.col(f"l.{label}"))
    )
    last = F.col("r.through") - F.col("s.base")
    first = last - F.col("r.copies") + 1

    def value_at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col(f"r.{value}")))

    lower = value_at(F.expr("(l.runs + 1) div 2"))
    upper = value_at(F.expr("l.runs div 2 + 1"))
    return placed.groupBy(F.col(f"l.{label}").alias(label), "min_seconds", "max_seconds", "runs").agg(
        ((lower + upper) / 2).alias("median_seconds")
    ).select(label, "median_seconds", "min_seconds", "max_seconds", "runs")


def speedup_against(
    df: DataFrame, baseline: str, label: str = "label", value: str = "seconds"
) -> DataFrame:
    """Mean per label, how many times faster than the baseline, and how many times larger."""
    means = df.groupBy(label).agg(F.avg(value).alias("mean_seconds"))
    base = means.filter(F.col(label) == baseline).select("mean_seconds").scalar()
    return means.select(
        label,
        "mean_seconds",
        F.try_divide(base, F.col("mean_seconds")).alias("speedup"),
        F.try_divide(F.col("mean_seconds"), base).alias("ratio"),
    )


def fit_scaling(timings: DataFrame, by: str) -> DataFrame:
    """Least squares for T(n) = t_seq + t_par / n over (cores, seconds), per `by`.

    Negative parts are set to 0. With one core count there is no fit: all NULL.
    """
    inverse = F.lit(1.0) / F.col("cores")
    parts = timings.groupBy(by).agg(
        F.greatest(F.regr_intercept("seconds", inverse), F.lit(0.0)).alias("t_seq"),
        F.greatest(F.regr_slope("seconds", inverse), F.lit(0.0)).alias("t_par"),
        (F.min("cores") < F.max("cores")).alias("fitted"),
    )
    fitted = F.col("fitted")
    parts = parts.select(
        by,
        F.when(fitted, F.col("t_seq")).alias("t_seq"),
        F.when(fitted, F.col("t_par")).alias("t_par"),
    ).withColumn("p", share("t_par", F.col("t_seq") + F.col("t_par")))
    return parts.withColumn(
        "s_max",
        F.when(F.col("p") < 1, 1 / (1 - F.col("p"))).when(F.col("p") == 1, F.lit(float("inf"))),
    )


def scaling_table(timings: DataFrame, by: str) -> DataFrame:
    """Per `by` and core count: measured and modelled speed-up, efficiency, Karp-Flatt metric."""
    per_count = timings.groupBy(by, "cores").agg(F.avg("seconds").alias("seconds"))
    single = timings.filter(F.col("cores") == 1).groupBy(by).agg(F.avg("seconds").alias("single"))
    n, p = F.col("cores"), F.col("p")
    measured = F.try_divide(F.col("single"), F.col("seconds"))
    table = (
        per_count.join(single, by, "left")
        .join(fit_scaling(timings, by).select(by, "p"), by)
        .withColumn("speedup_measured", measured)
    )
    s = F.col("speedup_measured")
    return table.select(
        by,
        "cores",
        "seconds",
        s.alias("speedup_measured"),
        F.try_divide(F.lit(1.0), (1 - p) + p / n).alias("speedup_model"),
        (s / n).alias("efficiency"),
        F.when(n > 1, (F.try_divide(F.lit(1.0), s) - 1 / n) / (1 - 1 / n)).alias("karp_flatt"),
    )
