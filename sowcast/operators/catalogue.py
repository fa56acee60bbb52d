"""Plants: the catalogue, and answers for the plants selected in each city.

A *selection* is a table of (city, common_name) pairs, of any size. Every
question is answered by equi-joins from it, so its result has as many rows as
were selected, and plants and cities are never paired with each other.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf, as_of_date
from sowcast.functions.labels import pollinator_icons, sow_label, viability_label
from sowcast.functions.search import skip_while, widths_up_to
from sowcast.operators.planting import GROUP
from sowcast.operators.relational import keep_where, shuffle_again

POLLINATOR_FLAGS = {
    "bees": "attracts_bees",
    "butterflies": "attracts_butterflies",
    "hummingbirds": "attracts_hummingbirds",
}


def plant_catalogue(
    plants: DataFrame,
    growing_season: str | None = None,
    harvest_type: str | None = None,
    pollinator: str | None = None,
) -> DataFrame:
    """The plant table under display names, with whichever filters are given."""
    chosen = keep_where(
        plants,
        F.col("growing_season") == growing_season if growing_season else None,
        F.col("harvest_type") == harvest_type if harvest_type else None,
        F.col(POLLINATOR_FLAGS[pollinator]) if pollinator else None,
    )
    return chosen.select(
        F.col("common_name").alias("Plant"),
        F.col("plant_family").alias("Family"),
        F.col("growing_season").alias("Season"),
        F.col("harvest_type").alias("Type"),
        sow_label("Direct", "wk").alias("Sow"),
        pollinator_icons().alias("Pollinators"),
    )


def filter_options(cities: DataFrame, plants: DataFrame) -> DataFrame:
    """The values a user can filter by, in order: cities with planting windows (from
    the stored windows, say), and the plants' seasons and types, read once."""
    lists = F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).alias("value")) for c in GROUP])
    of_plants = plants.select(F.inline(lists))
    of_cities = cities.select(F.lit("city").alias("filter"), F.col("city").alias("value"))
    return of_plants.union(of_cities).distinct().orderBy("filter", "value")


def selected_plants(selection: DataFrame, plants: DataFrame) -> DataFrame:
    """The plants selected in each city; selecting a name twice changes nothing."""
    # plants are never broadcast: a compressed file looks smaller than its rows in the driver
    return selection.select("city", "common_name").distinct().join(plants.hint("merge"), "common_name")


def weekly_viability(
    daily: DataFrame,
    plants: DataFrame,
    selection: DataFrame,
    as_of: AsOf = None,
    days: int = 7,
    good_days: int = 4,
) -> DataFrame:
    """For each selected plant, how many of the next ``days`` days have a high
    inside the plant's band (bounds included), and whether those are enough.

    A city without any forecast day has no rows; one with fewer days than asked
    for still counts out of ``days``.
    """
    today = as_of_date(as_of)
    # The city's different highs in order, each with the number of days up to it, are kept
    # in its row, so a band takes two searches, however many days there are; repeated
    # days are counted before the shuffle.
    so_far = F.sum("n").over(Window.partitionBy("city").orderBy("temp_max"))
    counted = (
        daily.where((F.col("date") >= today) & (F.col("date") < F.date_add(today, days)))
        .groupBy("city", "temp_max")
        .agg(F.count(F.when(F.col("temp_max").isNotNull(), 1)).alias("n"))
        .withColumn("so_far", so_far)
    )
    high = F.when(F.col("temp_max").isNotNull(), F.struct("temp_max", "so_far"))
    highs = counted.groupBy("city").agg(F.sort_array(F.collect_list(high)).alias("highs"))
    highs = highs.withColumn("widths", widths_up_to(F.size("highs")))

    def days_until(passes: Callable[[Column], Column]) -> Column:
        at = skip_while("widths", F.lit(0), lambda at, width: passes(F.get("highs", at + width - 1)["temp_max"]))
        return F.coalesce(F.get("highs", at - 1)["so_far"], F.lit(0))

    coolest, warmest = F.col("min_viable_temp_f"), F.col("max_viable_temp_f")
    inside = days_until(lambda high: high <= warmest) - days_until(lambda high: high < coolest)
    viable_days = F.when(coolest <= warmest, inside).otherwise(F.lit(0)).cast("long")
    good = F.col("viable_days") >= good_days
    return (
        selected_plants(selection, plants)
        .join(shuffle_again(highs, "city"), "city")
        .withColumn("viable_days", viable_days)
        .select(
            "city",
            "common_name",
            "plant_family",
            sow_label("Direct Sow", " wks indoor").alias("sow_method"),
            "viable_days",
            good.alias("is_good"),
            viability_label("viable_days", days, good).alias("viability"),
            pollinator_icons(" ").alias("pollinators"),
        )
    )


def planting_segments(plants: DataFrame, windows: DataFrame, selection: DataFrame) -> DataFrame:
    """Each selected plant's intervals: ``Indoor start`` if it begins before the
    outdoor start, and ``Outdoor``."""
    indoor = F.struct(
        F.col("planting_start").alias("start"),
        F.col("outdoor_start").alias("finish"),
        F.lit("Indoor start").alias("segment"),
    )
    outdoor = F.struct(
        F.col("outdoor_start").alias("start"),
        F.col("planting_end").alias("finish"),
        F.lit("Outdoor").alias("segment"),
    )
    starts_indoors = F.col("planting_start") < F.col("outdoor_start")
    pieces = F.when(starts_indoors, F.array(indoor, outdoor)).otherwise(F.array(outdoor))
    return (
        selected_plants(selection, plants)
        .join(windows, ["city", *GROUP])
        .select(
            "city",
            F.col("common_name").alias("task"),
            F.col("growing_season").alias("season"),
            pollinator_icons().alias("pollinators"),
            F.explode(pieces).alias("piece"),
        )
        .select("city", "task", "season", "piece.*", "pollinators")
    )


def planting_export(plants: DataFrame, windows: DataFrame, selection: DataFrame) -> DataFrame:
    """The selected plants and their planting windows under display names, after the city."""
    return (
        selected_plants(selection, plants)
        .join(windows, ["city", *GROUP])
        .select(
            "city",
            F.col("common_name").alias("Plant"),
            F.col("plant_family").alias("Family"),
            F.col("growing_season").alias("Season"),
            F.col("harvest_type").alias("Type"),
            F.col("ideal_temp_min_f").alias("Ideal Min"),
            F.col("ideal_temp_max_f").alias("Ideal Max"),
            F.col("min_viable_temp_f").alias("Min Viable"),
            F.col("max_viable_temp_f").alias("Max Viable"),
            F.col("days_to_maturity").alias("Days to Maturity"),
            sow_label("Direct Sow", " weeks indoor").alias("Sow Method"),
            F.col("square_feet_needed").alias("Sq Ft"),
            F.col("planting_start").alias("Planting Start"),
            F.col("outdoor_start").alias("Outdoor Start"),
            F.col("planting_end").alias("Planting End"),
        )
    )
