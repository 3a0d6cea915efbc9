"""Ordered rules for semi-structured sensor records held as JSON text.

The first rule that fails names the reason; NULL means the record is clean. The steps are
separate projections on purpose: one projection with all of it makes a generated method too
long for the JVM's compiler, and runs several times slower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names, their order, and the accepted ranges (bounds included).
REQUIRED_KEYS = ["record_id", "timestamp", "sensor_id", "temperature", "humidity"]
TEMPERATURE_RANGE = (-50.0, 100.0)
HUMIDITY_RANGE = (0.0, 100.0)

TEXT_FIELDS = ["record_id", "timestamp", "sensor_id"]
MEASURES = ["temperature", "humidity"]

# ISO 8601 as the usual parsers accept it: a calendar or week date, extended or basic, then
# optionally one separator of any kind, a time of day (extended or basic, with a fraction of any
# number of digits after a point or comma) and an offset below 24 hours.
_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d)?|[0-5]\d(?:[0-5]\d)?)?(?:[.,]\d+)?"
ISO_SHAPE = (
    r"^(?:(\d{4})(-?)(\d{2})\2(\d{2})|(\d{4})(-?)W(\d{2})(?:\6([1-7]))?)"
    rf"(?:[\s\S]{_CLOCK}(?:Z|[+-]{_CLOCK})?)?$"
)

_RECORD = "struct<" + ",".join(f"{key}:variant" for key in REQUIRED_KEYS) + ">"


def with_record(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds `record`: the required members as VARIANT, NULL when the text is not a JSON object.

    A member that is absent is NULL; one that holds a JSON null is a VARIANT null. Of members with
    one name the last counts, as parsers of JSON have it; Spark has a setting for that, which this
    switches on in the session.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df.withColumn("record", F.try_variant_get(F.try_parse_json(F.col(raw)), "$", _RECORD))


def record_key(record_id: Column, kind: Column) -> Column:
    """The id as text, a string in quotes so that "5" and 5 stay apart.

    NULL for a null, absent or nested id.
    """
    text = F.try_variant_get(record_id, "$", "string")
    return F.when(kind == "STRING", F.concat(F.lit('"'), text, F.lit('"'))).when(
        ~kind.rlike("^(VOID|ARRAY|OBJECT)"), text
    )


def with_record_key(df: DataFrame) -> DataFrame:
    """Adds record_key and nothing else."""
    record_id = F.col("record.record_id")
    keyed = with_record(df).withColumn("record_key", record_key(record_id, F.schema_of_variant(record_id)))
    return keyed.drop("record")


def is_iso_timestamp(text: Column) -> Column:
    """Whether the text is an ISO 8601 date or timestamp whose day exists, in the years 1 to 9999."""

    def part(group: int) -> Column:
        return F.regexp_extract(text, ISO_SHAPE, group)

    calendar = F.concat_ws("-", part(1), part(3), part(4)).try_cast("date").isNotNull()
    # The fourth of January is always in week 1; week 53 exists in a year whose last days reach it.
    fourth = F.concat(part(5), F.lit("-01-04")).try_cast("date")
    week = part(7).try_cast("int")
    monday = F.date_add(F.date_trunc("week", fourth).cast("date"), (week - 1) * 7)
    day = F.coalesce(part(8).try_cast("int"), F.lit(1))
    by_week = F.when(week.between(1, 52), True).when(week == 53, F.weekofyear(monday) == 53).otherwise(False)
    by_week = by_week & (F.year(F.date_add(monday, day - 1)) <= 9999)
    year = F.when(part(5) == "", part(1)).otherwise(part(5))
    shaped = text.rlike(ISO_SHAPE) & (year != "0000")
    return shaped & F.when(part(5) == "", calendar).otherwise(by_week)


def _with_typed_fields(df: DataFrame) -> DataFrame:
    """Adds the JSON type of each member, and the members as text or number."""
    return df.select(
        "*",
        *[F.schema_of_variant(f"record.{key}").alias(f"{key}_type") for key in REQUIRED_KEYS],
        *[F.try_variant_get(f"record.{key}", "$", "string").alias(key) for key in TEXT_FIELDS],
        *[F.try_variant_get(f"record.{key}", "$", "double").alias(key) for key in MEASURES],
    )


def _reason() -> Column:
    kind = {key: F.col(f"{key}_type") for key in REQUIRED_KEYS}

    def filled_text(key: str) -> Column:
        return (kind[key] == "STRING") & (F.length(key) > 0)

    def number(key: str) -> Column:
        # true and false are BOOLEAN, so they are no numbers here.
        return kind[key].isin("BIGINT", "DOUBLE") | kind[key].startswith("DECIMAL")

    good_time = (kind["timestamp"] == "STRING") & is_iso_timestamp(F.col("timestamp"))
    rules = [(F.col("record").isNull(), "not_object")]
    rules += [(F.col(f"record.{key}").isNull(), f"missing:{key}") for key in REQUIRED_KEYS]
    rules += [
        (~filled_text("record_id"), "bad_record_id"),
        (~filled_text("sensor_id"), "bad_sensor_id"),
        (~good_time, "bad_timestamp"),
        ((kind["temperature"] == "VOID") | (kind["humidity"] == "VOID"), "null_measure"),
        (~(number("temperature") & number("humidity")), "bad_type"),
        (~F.col("temperature").between(*TEMPERATURE_RANGE), "temperature_range"),
        (~F.col("humidity").between(*HUMIDITY_RANGE), "humidity_range"),
    ]
    reason = F
    for fails, code in rules:
        reason = reason.when(fails, F.lit(code))
    return reason


def _reason_value() -> Column:
    """The offending member as JSON text. Of two measures the first that is no number."""
    code = F.col("reason_code")
    temperature_type = F.col("temperature_type")
    temperature_is_number = temperature_type.isin("BIGINT", "DOUBLE") | temperature_type.startswith(
        "DECIMAL"
    )
    offender = (
        F.when(code == "bad_record_id", F.col("record.record_id"))
        .when(code == "bad_sensor_id", F.col("record.sensor_id"))
        .when(code == "bad_timestamp", F.col("record.timestamp"))
        .when((code == "bad_type") & temperature_is_number, F.col("record.humidity"))
        .when(code.isin("bad_type", "temperature_range"), F.col("record.temperature"))
        .when(code == "humidity_range", F.col("record.humidity"))
    )
    return F.to_json(offender)


def with_verdict(df: DataFrame) -> DataFrame:
    """Adds record_key, reason_code, reason_value and the typed fields from one parse of `raw`."""
    typed = _with_typed_fields(with_record(df))
    # A generator, though of one row: a filter on the reason stops here instead of being
    # pushed below, where it would repeat the parse and every rule.
    judged = typed.select("*", F.explode(F.array(_reason())).alias("reason_code"))
    return judged.select(
        *df.columns,
        record_key(F.col("record.record_id"), F.col("record_id_type")).alias("record_key"),
        "reason_code",
        _reason_value().alias("reason_value"),
        *REQUIRED_KEYS,
    )
