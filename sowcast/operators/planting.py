"""Planting windows per city and plant group."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sowcast.functions.rounding import round_half_up
from sowcast.functions.search import skip_while, widths_up_to

GROUP = ("growing_season", "harvest_type")


def plant_groups(plants: DataFrame) -> DataFrame:
    """Mean requirements of the plants of each season and harvest type."""
    return plants.groupBy(*GROUP).agg(
        F.avg("weeks_indoor_before_transplant").alias("avg_weeks_indoor"),
        F.avg("days_to_maturity").alias("avg_days_to_maturity"),
        F.avg("max_viable_temp_f").alias("avg_max_viable_temp"),
        F.avg("min_viable_temp_f").alias("avg_min_viable_temp"),
    )


def _block_maxima(highs: Column) -> Column:
    """The largest of every stretch of 1, 2, 4, ... values, the widest stretches first:
    ``tops[i]`` of a level is the largest of the ``width`` values from i on."""
    single = F.array(F.struct(F.lit(1).alias("width"), highs.alias("tops")))
    wider = F.filter(F.reverse(widths_up_to(F.size(highs))), lambda width: width > 1)

    def widen(levels: Column, width: Column) -> Column:
        tops, half = F.get(levels, F.lit(0))["tops"], (width / 2).cast("int")
        places = F.sequence(F.lit(0), F.size(tops) - half - 1)
        both = F.transform(places, lambda i: F.greatest(F.get(tops, i), F.get(tops, i + half)))
        return F.concat(F.array(F.struct(width.alias("width"), both.alias("tops"))), levels)

    return F.aggregate(wider, single, widen)


def _starts(daily: DataFrame, freeze_dates: DataFrame, groups: DataFrame, buckets: int) -> DataFrame:
    """Outdoor start per city and group, with what tells the city's hot days apart.

    Each city's days become one row. Only days on which the soil is warmer than ever
    before can be a start, and the start for a minimum is the first of them above it:
    their temperatures rise, so it is found by halving. Cities and groups meet by an
    equi-join on a temperature bucket, for the buckets that a city's soil reaches; every
    pair that is warm enough is a result row, so that cities, days and groups are never
    multiplied out. Buckets are bounded by quantiles of the groups' minimums, so that
    each holds about as many groups, whatever their spread.

    ``hot`` are the days that are hotter than the least demanding maximum, in order, and
    ``maxima`` their block maxima by powers of two, from which the first day above any
    maximum, from any day on, is found in as many steps as the number of days has digits.
    """
    minimum = F.col("avg_min_viable_temp")
    soil = F.col("avg_shallow_soil_temp")
    high = F.col("avg_max_temp")
    lowest = groups.select(F.min(minimum)).scalar()
    highest = groups.select(F.max(minimum)).scalar()
    smallest_maximum = groups.select(F.min("avg_max_viable_temp")).scalar()
    shares = F.array(*[F.lit(n / buckets) for n in range(1, buckets)]).cast("array<double>")
    bounds = groups.select(F.percentile_approx(minimum, shares)).scalar() if buckets > 1 else shares

    def bucket(temp: Column) -> Column:
        return F.size(F.filter("bounds", lambda bound: bound <= temp))

    # One row per city and day, however often the input repeats a day: the
    # highest reading decides whether a bound was passed.
    days = daily.groupBy("city", "date").agg(
        F.max(soil).alias("avg_shallow_soil_temp"), F.max(high).alias("avg_max_temp")
    )
    city_days = Window.partitionBy("city").orderBy("date")
    warmest_before = F.max(soil).over(city_days.rowsBetween(Window.unboundedPreceding, -1))
    new_top = soil.isNotNull() & (F.col("warmest_before").isNull() | (soil > F.col("warmest_before")))
    is_hot = F.coalesce(high > smallest_maximum, F.lit(False))
    # in order, each list by itself, so that what is not asked for is not computed
    tops = F.sort_array(F.collect_list(F.when(new_top, F.struct("date", soil.alias("soil")))))
    hot = F.sort_array(F.collect_list(F.when(is_hot, F.struct("date", high.alias("high")))))
    cities = (
        days.join(freeze_dates.select("city", "avg_last_freeze_all_time"), "city")
        .where(F.col("date") > F.col("avg_last_freeze_all_time"))
        .withColumn("warmest_before", warmest_before)
        .groupBy("city")
        .agg(tops.alias("tops"), hot.alias("hot"))
        .withColumn("top", F.get("tops", F.size("tops") - 1)["soil"])
        .where(F.col("top") > lowest)
        .withColumn("widths", widths_up_to(F.size("tops")))
        .withColumn("hot_widths", widths_up_to(F.size("hot")))
        .withColumn("maxima", _block_maxima(F.col("hot")["high"]))
    )
    covered = (
        cities.withColumn("lowest", lowest)
        .withColumn("highest", F.least("top", highest))
        .withColumn("bounds", bounds)
        .withColumn("bucket", F.explode(F.sequence(bucket(F.col("lowest")), bucket(F.col("highest")))))
        .drop("lowest", "highest", "bounds")
    )
    dealt = groups.withColumn("bounds", bounds).withColumn("bucket", bucket(minimum)).drop("bounds")
    colder = skip_while("widths", F.lit(0), lambda at, width: F.get("tops", at + width - 1)["soil"] <= minimum)
    return (
        covered.join(dealt, "bucket")
        .where(minimum < F.col("top"))
        .withColumn("outdoor_start", F.get("tops", colder)["date"])
    )


_START_COLUMNS = (
    "city",
    *GROUP,
    "avg_weeks_indoor",
    "avg_days_to_maturity",
    "avg_max_viable_temp",
    "outdoor_start",
)


def outdoor_start(
    daily: DataFrame, freeze_dates: DataFrame, groups: DataFrame, buckets: int = 64
) -> DataFrame:
    """First day after the average last freeze whose soil is warmer than the
    group's minimum, per city and group. Pairs without such a day have no row.

    ``buckets`` only sets how finely the join divides temperatures.
    """
    return _starts(daily, freeze_dates, groups, buckets).select(*_START_COLUMNS)


def temperature_limit(
    daily: DataFrame, freeze_dates: DataFrame, groups: DataFrame, buckets: int = 64
) -> DataFrame:
    """Outdoor starts with the first day, from the start on, whose mean high is
    above the group's maximum; null if it never gets that hot."""
    maximum = F.col("avg_max_viable_temp")
    begin = skip_while("hot_widths", F.lit(0), lambda at, width: F.get("hot", at + width - 1)["date"] < F.col("outdoor_start"))
    first = F.aggregate(
        "maxima",
        F.col("begin"),
        lambda at, level: at + F.when(F.get(level["tops"], at) <= maximum, level["width"]).otherwise(F.lit(0)),
    )
    starts = _starts(daily, freeze_dates, groups, buckets).withColumn("begin", begin)
    limit = F.when(maximum.isNotNull(), F.get("hot", first)["date"])
    return starts.select(*_START_COLUMNS, limit.alias("temp_limit_date"))


def planting_windows(limits: DataFrame) -> DataFrame:
    """When to start indoors, move outdoors and stop, per city and group."""
    outdoor = F.col("outdoor_start")
    weeks_in_days = round_half_up(F.col("avg_weeks_indoor") * 7).cast("int")
    mature = F.date_add(outdoor, round_half_up("avg_days_to_maturity").cast("int"))
    return (
        limits.withColumn("planting_start", F.date_sub(outdoor, weeks_in_days))
        .withColumn("planting_end", F.least(mature, F.coalesce("temp_limit_date", mature)))
        .select(
            "city",
            *GROUP,
            "planting_start",
            "outdoor_start",
            "planting_end",
            F.datediff("planting_end", "planting_start").alias("planting_range"),
        )
    )


def cities_with_windows(daily: DataFrame, freeze_dates: DataFrame, groups: DataFrame) -> DataFrame:
    """Cities in which some group can be planted, without computing any window: the
    soil gets warmer after the last freeze than the least demanding group needs."""
    lowest = groups.select(F.min("avg_min_viable_temp")).scalar()
    return (
        daily.join(freeze_dates.select("city", "avg_last_freeze_all_time"), "city")
        .where((F.col("date") > F.col("avg_last_freeze_all_time")) & (F.col("avg_shallow_soil_temp") > lowest))
        .select("city")
        .distinct()
    )


def planting_calendar(daily: DataFrame, freeze_dates: DataFrame, plants: DataFrame) -> DataFrame:
    """Planting windows straight from daily data, freeze dates and plants."""
    return planting_windows(temperature_limit(daily, freeze_dates, plant_groups(plants)))
