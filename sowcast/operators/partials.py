"""Aggregates in parts that can be stored and merged.

Averages are kept as sums and counts, freezes as the latest and the first day, so that
new observations add rows of their own instead of a pass over all that came before. A
part is one row per city and day number, year or week. ``merged`` unites parts of any
number of batches; the functions after it turn them into the datasets that the whole
history gives. Sums of doubles may differ in the last bits, as they do with the order of
rows anyway.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf, nth_day_of_year, week_start
from sowcast.functions.rounding import round_half_up

#: measure of the history -> its average's name
_MEASURES = {
    "temp_min": "avg_min_temp",
    "temp_max": "avg_max_temp",
    "soil_temp_0_7cm": "avg_shallow_soil_temp",
    "soil_temp_7_to_28cm": "avg_deep_soil_temp",
}
#: table of parts -> the keys of a part
KEYS = {
    "climate_parts": ("city", "day_number"),
    "freeze_parts": ("city", "year"),
    "rain_parts": ("city", "week_start"),
}
_MERGED_BY = {"sum": F.sum, "count": F.sum, "last": F.max, "first": F.min}


def climate_parts(history: DataFrame) -> DataFrame:
    """Sum and count of each measure per city and day of the year: 366 rows a city at most."""
    sums = [F.sum(m).alias(f"sum_{m}") for m in _MEASURES]
    counts = [F.count(m).alias(f"count_{m}") for m in _MEASURES]
    return history.groupBy("city", F.dayofyear("date").alias("day_number")).agg(*sums, *counts)


def freeze_parts(history: DataFrame, threshold: float = 32.0) -> DataFrame:
    """The last freeze up to June and the first one after, per city and year that has either."""
    early = F.month("date") <= 6
    return (
        history.where(F.col("temp_min") <= threshold)
        .groupBy("city", F.year("date").alias("year"))
        .agg(F.max(F.when(early, F.col("date"))).alias("last_freeze"), F.min(F.when(~early, F.col("date"))).alias("first_freeze"))
    )


def rain_parts(daily: DataFrame) -> DataFrame:
    return daily.groupBy("city", week_start(F.col("date").cast("date")).alias("week_start")).agg(
        F.sum("precipitation").alias("sum_precipitation")
    )


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One part per key, of any number. A column's name tells how its parts unite."""
    values = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[_MERGED_BY[c.split("_")[0]](c).alias(c) for c in values])


def climatology_of_parts(parts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """What :func:`sowcast.operators.climate.daily_climatology` gives for the history."""
    whole = merged(parts, KEYS["climate_parts"])
    # two day numbers of unequal years may fall on one day of the as-of year
    days = whole.withColumn("date", nth_day_of_year(F.col("day_number"), as_of)).drop("day_number")
    sums = merged(days, ("city", "date"))

    def average(measure: str):
        count = F.col(f"count_{measure}")
        return F.when(count > 0, F.col(f"sum_{measure}") / count)

    return sums.select("city", "date", *[average(m).alias(name) for m, name in _MEASURES.items()])


def freezes_of_parts(parts: DataFrame) -> DataFrame:
    """What :func:`sowcast.operators.freeze.freeze_by_year` gives for the history."""
    return merged(parts, KEYS["freeze_parts"]).where(F.col("last_freeze").isNotNull() & F.col("first_freeze").isNotNull())


def weekly_rain_of_parts(parts: DataFrame) -> DataFrame:
    """Rainfall per city and week, rounded as the tracker compares it."""
    total = round_half_up(F.col("sum_precipitation"), 3).alias("total_rainfall")
    return merged(parts, KEYS["rain_parts"]).select("city", "week_start", total)


#: how each table of parts comes from observations
OF_HISTORY = {"climate_parts": climate_parts, "freeze_parts": freeze_parts, "rain_parts": rain_parts}
