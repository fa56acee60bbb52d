"""Averages per calendar day, beside sun times."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf, project_to_year
from sowcast.functions.clock import decimal_hours

SUN_COLUMNS = ("morning_twilight", "sunrise", "solar_noon", "sunset", "evening_twilight", "day_length")
CLIMATE_COLUMNS = ("avg_min_temp", "avg_max_temp", "avg_shallow_soil_temp", "avg_deep_soil_temp")


def daily_climatology(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Mean temperatures per city and calendar day over all years, each day
    projected on the as-of year. Partial averages make this one shuffle of at
    most 366 rows per city and input task."""
    return history.groupBy("city", project_to_year("date", as_of).alias("date")).agg(
        F.avg("temp_min").alias("avg_min_temp"),
        F.avg("temp_max").alias("avg_max_temp"),
        F.avg("soil_temp_0_7cm").alias("avg_shallow_soil_temp"),
        F.avg("soil_temp_7_to_28cm").alias("avg_deep_soil_temp"),
    )


def daily_data(sun: DataFrame, climatology: DataFrame) -> DataFrame:
    """Sun times and climate averages of the days that have both."""
    return sun.join(climatology, ["city", "date"]).select("date", "city", *SUN_COLUMNS, *CLIMATE_COLUMNS)


def seasonal_conditions(
    sun: DataFrame, daily: DataFrame, freeze_dates: DataFrame, band_days: int = 5
) -> DataFrame:
    """Sun times as decimal hours beside the day's mean low, high and soil
    temperature, with the last freeze and the band of days around it."""
    clocks = ("morning_twilight", "sunrise", "sunset", "evening_twilight")
    last_freeze = F.col("avg_last_freeze_all_time")
    hours = sun.select("city", "date", *[decimal_hours(c).alias(c) for c in clocks])
    climate = daily.select("city", "date", "avg_shallow_soil_temp", "avg_min_temp", "avg_max_temp")
    freezes = freeze_dates.select(
        "city",
        last_freeze.alias("last_freeze"),
        F.date_sub(last_freeze, band_days).alias("freeze_band_start"),
        F.date_add(last_freeze, band_days).alias("freeze_band_end"),
    )
    return hours.join(climate, ["city", "date"], "left").join(freezes, "city", "left")


def daylight_bands(sun: DataFrame) -> DataFrame:
    """Per city, how many days have each twilight, and whether a band between
    them can be drawn, which takes at least one of each."""
    return sun.groupBy("city").agg(
        F.count("morning_twilight").alias("morning_days"),
        F.count("evening_twilight").alias("evening_days"),
        ((F.count("morning_twilight") > 0) & (F.count("evening_twilight") > 0)).alias("has_band"),
    )
