"""What a gardener looks at today: current, recent and forecast conditions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf, as_of_date, long_day, short_day, week_start, weekday_name
from sowcast.functions.clock import clock_label
from sowcast.functions.labels import (
    UNKNOWN,
    degrees_label,
    irrigation_flag,
    is_irrigation_needed,
    rain_label,
    rain_only_status,
    rounded_degrees_label,
)
from sowcast.functions.rounding import round_half_even
from sowcast.operators.relational import top_n_per_key
from sowcast.operators.weather import latest_weeks


def today_conditions(cities: DataFrame, daily: DataFrame, sun: DataFrame, as_of: AsOf = None) -> DataFrame:
    """High, low, sunrise and sunset of the as-of day for every city; a city
    without data keeps its row, with nulls and dashes."""
    today = as_of_date(as_of)

    def on_the_day(df: DataFrame, *columns: str) -> DataFrame:
        return df.where(F.col("date") == today).select("city", *columns).dropDuplicates(["city"])

    weather = on_the_day(daily, "temp_max", "temp_min")
    clocks = on_the_day(sun, "sunrise", "sunset")
    return (
        cities.select("city")
        .distinct()
        .join(weather, "city", "left")
        .join(clocks, "city", "left")
        .select(
            "city",
            weekday_name(today).alias("weekday"),
            long_day(today).alias("day"),
            F.col("temp_max").cast("int").alias("high"),
            F.col("temp_min").cast("int").alias("low"),
            degrees_label("temp_max", "°F").alias("high_label"),
            degrees_label("temp_min", "°F").alias("low_label"),
            clock_label("sunrise").alias("sunrise"),
            clock_label("sunset").alias("sunset"),
        )
    )


def recent_weeks(
    daily: DataFrame,
    tracker: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
    tracker_weeks: int = 5,
    enough: float = 0.5,
    horizon: int = 7,
) -> DataFrame:
    """Weekly mean high and low and rainfall of the last ``days`` days.

    Where one of the city's latest tracker weeks matches, its whole-week
    rainfall and status are shown; other weeks are ``Unknown``. A city with no
    tracker rows at all gets a two-way status from its own rainfall. Tracker weeks
    that begin ``horizon`` days or more from the as-of day on, beyond the forecast,
    are not looked at.
    """
    today = as_of_date(as_of)
    weeks = (
        daily.where((F.col("date") >= F.date_sub(today, days)) & (F.col("date") < today))
        .groupBy("city", week_start("date").alias("week_start"))
        .agg(
            round_half_even(F.avg("temp_max"), 1).alias("avg_high"),
            round_half_even(F.avg("temp_min"), 1).alias("avg_low"),
            round_half_even(F.sum("precipitation"), 2).alias("own_rain"),
        )
    )
    # at most tracker_weeks entries per city, so one join on the city answers
    # both "which week matches" and "is there a tracker at all"
    tracked = (
        latest_weeks(tracker.where(F.col("week_start") < F.date_add(today, horizon)), tracker_weeks)
        .groupBy("city")
        .agg(F.collect_list(F.struct("week_start", "total_rainfall", "irrigation_status")).alias("tracked"))
    )
    this_week = F.filter("tracked", lambda t: t["week_start"] == F.col("week_start"))
    own_status = rain_only_status("own_rain", enough)
    status = F.when(F.col("tracked").isNull(), own_status).otherwise(
        F.coalesce("match.irrigation_status", F.lit(UNKNOWN))
    )
    return (
        weeks.join(tracked, "city", "left")
        .withColumn("match", F.explode_outer(this_week))
        .select(
            "city",
            "week_start",
            short_day("week_start").alias("week_label"),
            "avg_high",
            "avg_low",
            rounded_degrees_label("avg_high").alias("high_label"),
            rounded_degrees_label("avg_low").alias("low_label"),
            F.coalesce("match.total_rainfall", "own_rain").alias("total_precip"),
            status.alias("irrigation_status"),
        )
        .withColumn("is_needed", is_irrigation_needed("irrigation_status"))
        .withColumn("flag", irrigation_flag("irrigation_status"))
    )


def forecast(daily: DataFrame, as_of: AsOf = None, days: int = 10) -> DataFrame:
    """The next ``days`` rows per city from the as-of day on, rounded and labelled."""
    upcoming = daily.where(F.col("date") >= as_of_date(as_of))
    rain = round_half_even(F.coalesce(F.col("precipitation"), F.lit(0.0)), 2)
    return top_n_per_key(upcoming, ["city"], [F.asc("date")], days).select(
        "city",
        "date",
        short_day("date").alias("date_label"),
        round_half_even("temp_max").alias("temp_max"),
        round_half_even("temp_min").alias("temp_min"),
        rain.alias("precipitation"),
        rounded_degrees_label("temp_max").alias("high_label"),
        rounded_degrees_label("temp_min").alias("low_label"),
        rain_label(rain).alias("rain_label"),
    )


def forecast_range(forecast_rows: DataFrame) -> DataFrame:
    """Lowest low and highest high of each city's forecast."""
    return forecast_rows.groupBy("city").agg(
        F.min("temp_min").alias("y_min"), F.max("temp_max").alias("y_max")
    )
