"""Histories that grow by batches, without reading what came before.

A batch of observations leaves parts (:mod:`sowcast.operators.partials`) that are
published beside the earlier ones. Readers unite them, a few hundred rows per city and
batch, until :func:`compact_history` replaces them by their union. A batch may also
replace all that was known of its cities, as after a correction.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.functions.calendar import AsOf
from sowcast.operators import partials
from sowcast.operators.climate import daily_data
from sowcast.operators.freeze import average_freeze_dates
from sowcast.operators.planting import planting_calendar
from sowcast.operators.relational import shuffle_again
from sowcast.operators.weather import tracker_of_weeks
from sowcast.sources.snapshots import Version, new_run_id, publish, read_parts, write_version

CITIES = "replaced_cities"  # cities of which a batch tells all there is to know


def _add(spark: SparkSession, root: str, tables: dict[str, DataFrame], adds: bool) -> None:
    run_id = new_run_id()
    versions = []
    for table, rows in tables.items():
        v = write_version(rows, root, table, run_id)
        versions.append(Version(v.table, v.path, v.format, v.schema, v.row_count, adds))
    publish(spark, root, versions)


def start_history(spark: SparkSession, root: str, observations: DataFrame) -> None:
    """Publish the parts of a first batch, in place of any that were there before.
    Observations have the columns of the history and ``precipitation``."""
    _add(spark, root, _batch(observations, replace_cities=False), adds=False)


def append_days(spark: SparkSession, root: str, observations: DataFrame) -> None:
    """Add a batch of days that were not known before. Reads the batch only."""
    _add(spark, root, _batch(observations, replace_cities=False), adds=True)


def replace_cities(spark: SparkSession, root: str, observations: DataFrame) -> None:
    """Add a batch that holds all days of its cities; what earlier batches told of them
    no longer counts. Reads the batch only."""
    _add(spark, root, _batch(observations, replace_cities=True), adds=True)


def _batch(observations: DataFrame, replace_cities: bool) -> dict[str, DataFrame]:
    tables = {table: of(observations) for table, of in partials.OF_HISTORY.items()}
    cities = observations.select("city").distinct()
    return {**tables, CITIES: cities if replace_cities else cities.limit(0)}


def _valid(spark: SparkSession, root: str, *tables: str) -> list[DataFrame]:
    """The parts that count, as of one moment: of each city those since it was last replaced."""

    def numbered(parts: dict[int, DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [rows.withColumn("batch", F.lit(n)) for n, rows in parts.items()])

    found = read_parts(spark, root, [*tables, CITIES])
    since = shuffle_again(numbered(found[CITIES]).groupBy("city").agg(F.max("batch").alias("since")), "city")

    def since_replaced(parts: DataFrame) -> DataFrame:
        return parts.join(since, "city", "left").where("since IS NULL OR batch >= since").drop("batch", "since")

    return [since_replaced(numbered(found[table])) for table in tables]


def compact_history(spark: SparkSession, root: str) -> None:
    """Replace all parts by their union. Reads parts only, no observations."""
    valid = _valid(spark, root, *partials.KEYS)
    tables = {table: partials.merged(parts, keys) for (table, keys), parts in zip(partials.KEYS.items(), valid)}
    cities = spark.createDataFrame([], "city STRING")
    _add(spark, root, {**tables, CITIES: cities}, adds=False)


def climatology(spark: SparkSession, root: str, as_of: AsOf = None) -> DataFrame:
    (climate,) = _valid(spark, root, "climate_parts")
    return partials.climatology_of_parts(climate, as_of)


def freeze_dates(spark: SparkSession, root: str, as_of: AsOf = None) -> DataFrame:
    (freezes,) = _valid(spark, root, "freeze_parts")
    return average_freeze_dates(partials.freezes_of_parts(freezes), as_of)


def tracker(spark: SparkSession, root: str) -> DataFrame:
    (rain,) = _valid(spark, root, "rain_parts")
    return tracker_of_weeks(partials.weekly_rain_of_parts(rain))


def planting_windows(spark: SparkSession, root: str, sun: DataFrame, plants: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Planting windows from all batches so far."""
    climate, freezes = _valid(spark, root, "climate_parts", "freeze_parts")
    daily = daily_data(sun, partials.climatology_of_parts(climate, as_of))
    return planting_calendar(daily, average_freeze_dates(partials.freezes_of_parts(freezes), as_of), plants)
