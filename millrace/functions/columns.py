"""Column expressions shared by the operators. All of them run in the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(text: str | Column) -> Column:
    """Text to TIMESTAMP_NTZ. Bad text is an error, not a null."""
    return col(text).cast("timestamp_ntz")


def hour_number(ts: str | Column) -> Column:
    """Hours since 1970 as INT: names the hour, as a cheap join key."""
    return F.unix_date(F.to_date(col(ts))) * 24 + F.hour(col(ts))


def hour_number_date(number: str | Column) -> Column:
    return F.date_from_unix_date(F.floor(col(number) / 24).cast("int"))


def hour_number_text(number: str | Column) -> Column:
    """The hour as yyyy-MM-dd HH:00."""
    hour = F.lpad(F.pmod(col(number), F.lit(24)).cast("string"), 2, "0")
    return F.concat(hour_number_date(number).cast("string"), F.lit(" "), hour, F.lit(":00"))


def second_text(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ as yyyy-MM-dd HH:mm:ss. date_format would go through the session's zone."""
    return F.substring(col(ts).cast("string"), 1, 19)


def epoch_millis(ts: str | Column) -> Column:
    """Whole milliseconds since 1970, rounded down."""
    return F.floor(F.unix_micros(col(ts).cast("timestamp")) / 1000).cast("long")


def exact_sum(value: str | Column, digits: int | None = None) -> Column:
    """Sum as DOUBLE, the same on every run and in any order. NaN and NULL are skipped.

    With `digits`, values must be amounts with that many decimals, and the sum is that of the
    decimals; a value with more of them (or an infinite one) is an error, never rounded.
    Without, any doubles are summed: each is cut into limbs of 30 bits, and the limbs are summed
    apart as LONG. The result is within one unit in the last place of the true sum of the values,
    less 2^-71 for each value below 2^-18 (a limb ends there). Beyond 2^82 a value is an error.
    Both are about as fast as a sum of doubles; a DECIMAL sum takes four times as long.
    """
    v = col(value).cast("double")
    return _limb_sum(v) if digits is None else _decimal_sum(v, digits)


def amount_parts(value: str | Column, digits: int) -> tuple[Column, Column]:
    """An amount with `digits` decimals as two LONG parts of its whole units, whose sums do not overflow.

    A value with more decimals (or an infinite one) is an error, never rounded. NaN and NULL have no parts.
    """
    v = col(value).cast("double")
    scaled = F.rint(v * 10**digits)
    fits = (scaled / 10**digits == v) & (F.abs(scaled) < float(1 << 53))
    misfit = F.raise_error(F.concat(F.lit(f"not an amount with {digits} decimals: "), v.cast("string")))
    units = F.when(~F.isnan(v) & fits, scaled.cast("long")).when(v.isNotNull() & ~F.isnan(v), misfit.cast("long"))
    return F.shiftright(units, 20), units.bitwiseAND(0xFFFFF)


def amount_of_parts(upper: Column, lower: Column, digits: int) -> Column:
    """The amount, as DOUBLE, of sums of its two parts."""
    units = upper.cast("decimal(19,0)") * 0x100000 + lower.cast("decimal(19,0)")
    return (units * F.lit(Decimal(1).scaleb(-digits))).cast("double")


def _decimal_sum(v: Column, digits: int) -> Column:
    upper, lower = amount_parts(v, digits)
    return amount_of_parts(F.sum(upper), F.sum(lower), digits)


def _limb_sum(v: Column) -> Column:
    infinity = float("inf")
    rest = F.when(~F.isnan(v) & (F.abs(v) != infinity), v)
    sums = []
    for shift in (-20, 10, 40):
        limb = (rest * 2.0**shift).cast("long")  # towards zero, so that nothing is lost below
        sums.append(F.sum(limb))
        rest = rest - limb.cast("double") * 2.0**-shift
    sums.append(F.sum(F.rint(rest * 2.0**70).cast("long")))

    def carried(limbs: list[Column]) -> list[Column]:
        out, carry = [], F.lit(0).cast("long")
        for limb in limbs[:0:-1]:
            out.append((limb + carry).bitwiseAND((1 << 30) - 1))
            carry = F.shiftright(limb + carry, 30)
        return [limbs[0] + carry, *out[::-1]]

    def joined(limbs: list[Column]) -> Column:
        a, b, c, d = (x.cast("double") for x in carried(limbs))
        return a * 2.0**20 + (b * 2.0**-10 + (c * 2.0**-40 + d * 2.0**-70))

    finite = F.when(carried(sums)[0] < 0, -joined([-x for x in sums])).otherwise(joined(sums))
    largest, smallest = F.max(F.when(~F.isnan(v), v)), F.min(v)
    return (
        F.when((largest == infinity) & (smallest == -infinity), F.lit(float("nan")))
        .when(largest == infinity, largest)
        .when(smallest == -infinity, smallest)
        .otherwise(finite)
    )


def round_even(value: str | Column, digits: int = 2) -> Column:
    """Half-to-even rounding."""
    return F.bround(col(value), digits)


def share(part: str | Column, whole: str | Column, digits: int | None = None) -> Column:
    """part / whole, NULL when the whole is 0."""
    ratio = F.try_divide(col(part).cast("double"), col(whole).cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def with_group(
    df: DataFrame, name: str, mapping: dict[str, str], out: str, default: str = "Other"
) -> DataFrame:
    """Adds `out`: the group `mapping` gives for `name`, or `default` when it gives none."""
    if not mapping:
        return df.withColumn(out, F.lit(default))
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(out, F.coalesce(pairs[F.col(name)], F.lit(default)))


def salt(key: str | Column, buckets: int) -> Column:
    """A bucket in [0, buckets) that depends on nothing but the key."""
    return F.pmod(F.hash(col(key)), F.lit(buckets))


def with_salt(df: DataFrame, key: str, buckets: int = 32, out: str = "salt") -> DataFrame:
    return df.withColumn(out, salt(key, buckets))


def mixed(value: str | Column, stream: int) -> Column:
    """A reproducible integer in [0, 2147483647) from an integer key.

    It depends only on the key and the stream number, so that the output of a generator does
    not change with the partition layout.
    """
    start = (col(value).cast("long") % 2147483647 * 48271 + (stream * 7919 + 1)) % 2147483647
    squared = (start * start + stream * 104729) % 2147483647
    return (squared * 69621 + 12345) % 2147483647
