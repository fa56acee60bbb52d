"""Landed JSON payloads of weather services.

Each landed record holds one station's payload with the station as a field.
Weather payloads are columnar, one array per measure; sun payloads are a list
of records. A payload that cannot be used drops its own records and no others.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.functions.calendar import service_date
from sowcast.functions.clock import from_twelve_hour

# The services' field names, and the columns they become.
FORECAST_FIELDS = {
    "time": "date",
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "precipitation_sum": "precipitation",
}
HISTORY_FIELDS = {
    "time": "date",
    "temperature_2m_min": "temp_min",
    "temperature_2m_max": "temp_max",
    "soil_temperature_0_to_7cm_mean": "soil_temp_0_7cm",
    "soil_temperature_7_to_28cm_mean": "soil_temp_7_to_28cm",
}
SUN_FIELDS = {
    "date": "date",
    "nautical_twilight_begin": "morning_twilight",
    "sunrise": "sunrise",
    "solar_noon": "solar_noon",
    "sunset": "sunset",
    "nautical_twilight_end": "evening_twilight",
    "day_length": "day_length",
}
SUN_CLOCKS = ("morning_twilight", "sunrise", "solar_noon", "sunset", "evening_twilight")

_CORRUPT = "_corrupt_record"


def _read_json(spark: SparkSession, path: str | list[str], schema: str, multi_line: bool) -> DataFrame:
    return (
        spark.read.schema(f"{schema}, {_CORRUPT} STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def _columnar_payloads(
    spark: SparkSession, path: str | list[str], fields: dict[str, str], multi_line: bool
) -> tuple[DataFrame, Column]:
    arrays = ", ".join(f"{f}: ARRAY<{'DATE' if f == 'time' else 'DOUBLE'}>" for f in fields)
    payloads = _read_json(spark, path, f"city STRING, daily STRUCT<{arrays}>", multi_line)
    days = F.size("daily.time")
    usable = F.col(_CORRUPT).isNull() & F.col("city").isNotNull() & F.col("daily.time").isNotNull()
    for field in fields:
        usable &= F.coalesce(F.size(f"daily.{field}") == days, F.lit(False))
    return payloads, usable


def read_columnar(
    spark: SparkSession, path: str | list[str], fields: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """One row per station and day from payloads of parallel arrays.

    Payloads that do not parse, lack a field, or have arrays of unequal length
    are skipped. ``multi_line`` reads one document per file instead of one per
    line; such files cannot be split.
    """
    payloads, usable = _columnar_payloads(spark, path, fields, multi_line)
    days = F.arrays_zip(*[F.col(f"daily.{f}").alias(f) for f in fields])
    return (
        payloads.where(usable)
        .select("city", F.inline(days))
        .select(*[F.col(f).alias(c) for f, c in fields.items()], "city")
    )


def skipped_payloads(
    spark: SparkSession, path: str | list[str], fields: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """The payloads that :func:`read_columnar` skips, with their station if known."""
    payloads, usable = _columnar_payloads(spark, path, fields, multi_line)
    reason = F.when(F.col(_CORRUPT).isNotNull(), "malformed").otherwise("missing or unequal arrays")
    return payloads.where(~usable).select("city", reason.alias("reason"))


def read_forecast(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Past and forecast days: date, temp_max, temp_min, precipitation, city."""
    return read_columnar(spark, path, FORECAST_FIELDS, multi_line)


def read_history(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Daily air and soil temperatures since records began."""
    return read_columnar(spark, path, HISTORY_FIELDS, multi_line)


def _sun_payloads(spark: SparkSession, path: str | list[str], multi_line: bool) -> tuple[DataFrame, Column]:
    record = ", ".join(f"{f}: STRING" for f in SUN_FIELDS)
    payloads = _read_json(spark, path, f"city STRING, results ARRAY<STRUCT<{record}>>", multi_line)
    return payloads, F.col(_CORRUPT).isNull() & F.col("city").isNotNull() & F.col("results").isNotNull()


def read_sun(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Sun times per station and day, converted from 12-hour to 24-hour text.

    Dates may be written month first. A time that cannot be read is null; a record
    without a readable date, and a payload without station or records, is skipped.
    """
    payloads, usable = _sun_payloads(spark, path, multi_line)
    days = payloads.where(usable).select("city", F.inline("results")).withColumnsRenamed(SUN_FIELDS)
    return days.select(
        "city",
        service_date("date").alias("date"),
        *[from_twelve_hour(c).alias(c) for c in SUN_CLOCKS],
        "day_length",
    ).where(F.col("date").isNotNull())


def skipped_sun(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """What :func:`read_sun` skips: a row per payload, or per record without a date."""
    payloads, usable = _sun_payloads(spark, path, multi_line)
    reason = F.when(F.col(_CORRUPT).isNotNull(), "malformed").otherwise("no station or records")
    records = payloads.where(usable).select("city", F.explode("results.date").alias("date"))
    undated = records.where(service_date("date").isNull()).select("city", F.lit("no date").alias("reason"))
    return payloads.where(~usable).select("city", reason.alias("reason")).union(undated)
