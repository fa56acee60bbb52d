"""Last and first freeze dates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf, as_of_date, month_and_day, nth_day_of_year
from sowcast.functions.labels import freeze_caption
from sowcast.functions.rounding import round_half_up

# column suffix -> years looked back (None: all years)
LOOK_BACKS = {"all_time": None, "ten_years": 10, "five_years": 5}


def freeze_by_year(history: DataFrame, threshold: float = 32.0) -> DataFrame:
    """Per city and year, the last freeze up to June and the first one after.

    Years without a freeze in either half are left out. Both halves come from
    one pass over the history: one scan, one shuffle of at most a row per city,
    year and input task.
    """
    early = F.month("date") <= 6
    return (
        history.where(F.col("temp_min") <= threshold)
        .groupBy("city", F.year("date").alias("year"))
        .agg(
            F.max(F.when(early, F.col("date"))).alias("last_freeze"),
            F.min(F.when(~early, F.col("date"))).alias("first_freeze"),
        )
        .where(F.col("last_freeze").isNotNull() & F.col("first_freeze").isNotNull())
    )


def average_freeze_dates(by_year: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Mean day-of-year of both freezes over each look-back, on the as-of year.

    A look-back of n years starts in the as-of year minus n, inclusive, and is
    null for a city without such a year.
    """
    this_year = F.year(as_of_date(as_of))

    def average(day: str, years: int | None):
        number = F.dayofyear(day)
        if years is not None:
            number = F.when(F.col("year") >= this_year - years, number)
        return nth_day_of_year(round_half_up(F.avg(number)), as_of)

    return by_year.groupBy("city").agg(
        *[
            average(day, years).alias(f"avg_{day}_{suffix}")
            for day in ("last_freeze", "first_freeze")
            for suffix, years in LOOK_BACKS.items()
        ]
    )


def freeze_callout(freeze_dates: DataFrame) -> DataFrame:
    """The all-time last freeze as text, with a caption."""
    return freeze_dates.select(
        "city",
        month_and_day("avg_last_freeze_all_time").alias("freeze_date"),
        freeze_caption("city").alias("caption"),
    )
