"""Daily weather and weekly rainfall against irrigation need."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.functions.calendar import week_start
from sowcast.functions.labels import irrigation_status
from sowcast.functions.rounding import round_half_up
from sowcast.operators.relational import top_n_per_key


def daily_weather(raw_weather: DataFrame) -> DataFrame:
    """Raw weather plus ``temp_avg``, the rounded middle of high and low."""
    return raw_weather.select(
        "city",
        "date",
        round_half_up((F.col("temp_max") + F.col("temp_min")) / 2, 1).alias("temp_avg"),
        "temp_max",
        "temp_min",
        "precipitation",
    )


def irrigation_tracker(daily: DataFrame, needed: float = 1.0, light: float = 0.5) -> DataFrame:
    """Rainfall per city and week beside the need, with a status.

    The status compares the *rounded* total, so a week of exactly one inch in
    decimal text counts as enough.
    """
    weekly = daily.groupBy("city", week_start(F.col("date").cast("date")).alias("week_start")).agg(
        round_half_up(F.sum("precipitation"), 3).alias("total_rainfall")
    )
    return tracker_of_weeks(weekly, needed, light)


def tracker_of_weeks(weekly: DataFrame, needed: float = 1.0, light: float = 0.5) -> DataFrame:
    """The tracker from rounded totals per city and week."""
    need = F.lit(float(needed))
    return weekly.select(
        "city",
        "week_start",
        "total_rainfall",
        need.alias("rainfall_needed"),
        round_half_up(F.col("total_rainfall") - need, 3).alias("surplus_deficit"),
        irrigation_status("total_rainfall", need, light).alias("irrigation_status"),
    )


def latest_weeks(tracker: DataFrame, weeks: int = 5) -> DataFrame:
    """The last ``weeks`` tracker rows of every city, future weeks included."""
    return top_n_per_key(tracker, ["city"], [F.desc("week_start")], weeks)
