"""Batch jobs over the table store.

Every stage writes its table and reads it back, so a lost executor costs at
most the stage that was running, and no plan grows over the whole chain.
"""

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from sowcast.functions.calendar import AsOf
from sowcast.operators.catalogue import filter_options
from sowcast.operators.climate import daily_climatology, daily_data
from sowcast.operators.freeze import average_freeze_dates, freeze_by_year
from sowcast.operators.planting import planting_calendar
from sowcast.operators.weather import daily_weather, irrigation_tracker
from sowcast.sources.payloads import read_forecast, read_history, read_sun
from sowcast.sources.snapshots import Version, new_run_id, publish, published_counts, read_all_published, read_published, write_version

AUDITED = (
    "six_weeks_weather",
    "irrigation_tracker",
    "sun_times",
    "daily_data",
    "avg_freeze_dates",
    "planting_gantt",
    "plants",
)
BY_CITY_AND_DAY = ("city", "date")
FILTER_OPTIONS = "filter_options"  # a row for each value that users can filter by

# What ingests land for the next rebuild, under names of their own: the tables that
# users read change with those built from them.
LANDED_HISTORY, LANDED_SUN = "landed_history", "landed_sun"


class _Build:
    """Collects the table versions that one run writes, to publish them together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run_id = spark, root, new_run_id()
        self.versions: list[Version] = []

    def put(self, table: str, df: DataFrame, format: str = "parquet", sort_by: tuple = ()) -> DataFrame:
        version = write_version(df, self.root, table, self.run_id, format, sort_by)
        self.versions.append(version)
        return version.read(self.spark)

    def publish(self) -> None:
        publish(self.spark, self.root, self.versions)


def _put_weather(build: _Build, raw_weather: DataFrame, raw_format: str) -> None:
    raw = build.put("raw_weather", raw_weather, raw_format)
    daily = build.put("six_weeks_weather", daily_weather(raw), sort_by=BY_CITY_AND_DAY)
    build.put("irrigation_tracker", irrigation_tracker(daily), sort_by=("city", "week_start"))


def full_rebuild(
    spark: SparkSession,
    root: str,
    raw_weather: DataFrame,
    history: DataFrame,
    sun: DataFrame,
    plants: DataFrame,
    as_of: AsOf = None,
) -> None:
    """Build all ten tables, and the list of filter options, in dependency order and
    publish them together.

    Tables that do not depend on each other are built at the same time, so that
    the last tasks of one leave no executors idle.
    """
    build = _Build(spark, root)
    with ThreadPoolExecutor(max_workers=4) as pool:

        def start(work: Callable, *args, **kwargs) -> Future:
            # job groups and scheduler pools of the caller hold in the thread too
            return pool.submit(inheritable_thread_target(spark)(work), *args, **kwargs)

        weather = start(_put_weather, build, raw_weather, "parquet")
        plants_table = start(build.put, "plants", plants)
        sun_table = start(build.put, "sun_times", sun, sort_by=BY_CITY_AND_DAY)
        observed = build.put("temp_soil_historical", history)
        freezes = start(
            build.put,
            "avg_freeze_dates",
            average_freeze_dates(freeze_by_year(observed), as_of),
            sort_by=("city",),
        )
        climatology = build.put("avg_temp_daily", daily_climatology(observed, as_of), sort_by=BY_CITY_AND_DAY)
        daily = build.put("daily_data", daily_data(sun_table.result(), climatology), sort_by=BY_CITY_AND_DAY)
        windows = build.put(
            "planting_gantt",
            planting_calendar(daily, freezes.result(), plants_table.result()),
            sort_by=("city", "growing_season", "harvest_type"),
        )
        build.put(FILTER_OPTIONS, filter_options(windows.select("city"), plants_table.result()))
        weather.result()
    build.publish()


def _replace_raw(spark: SparkSession, root: str, table: str, rows: DataFrame) -> bool:
    if rows.isEmpty():
        return False
    build = _Build(spark, root)
    build.put(table, rows, "csv")
    build.publish()
    return True


def ingest_history(spark: SparkSession, root: str, landed: str, multi_line: bool = False) -> bool:
    """Replace the history that the next rebuild starts from by newly landed payloads.
    Returns False, and changes nothing, if no payload is usable."""
    return _replace_raw(spark, root, LANDED_HISTORY, read_history(spark, landed, multi_line))


def ingest_sun(spark: SparkSession, root: str, landed: str, multi_line: bool = False) -> bool:
    """Replace the landed sun times by newly landed payloads, as :func:`ingest_history` does."""
    return _replace_raw(spark, root, LANDED_SUN, read_sun(spark, landed, multi_line))


def rebuild_from_landed(spark: SparkSession, root: str, plants: DataFrame, as_of: AsOf = None) -> None:
    """A full rebuild from what forecast refreshes and ingests have landed under the
    root, as it stands at the start, and the plants."""
    landed = read_all_published(spark, root, ["raw_weather", LANDED_HISTORY, LANDED_SUN])
    full_rebuild(spark, root, landed["raw_weather"], landed[LANDED_HISTORY], landed[LANDED_SUN], plants, as_of)


def refresh_forecast(spark: SparkSession, root: str, landed: str, multi_line: bool = False) -> bool:
    """Replace raw weather and the two tables built from it by newly landed
    payloads. Returns False, and changes nothing, if no payload is usable."""
    raw = read_forecast(spark, landed, multi_line)
    if raw.isEmpty():
        return False
    build = _Build(spark, root)
    _put_weather(build, raw, "csv")
    build.publish()
    return True


def build_audit(spark: SparkSession, root: str) -> DataFrame:
    """Number of rows of each published table that users query, at one moment. They were
    counted when the tables were written; no table is read."""
    return published_counts(spark, root, AUDITED)


def stored_filter_options(spark: SparkSession, root: str) -> DataFrame:
    """What users can filter by, in order, from the list that the last rebuild stored."""
    return read_published(spark, root, FILTER_OPTIONS).orderBy("filter", "value")


def add_plants(spark: SparkSession, root: str, plants: DataFrame) -> None:
    """Publish further plants, together with the filter options that they bring: the stored
    list is united with theirs, and no other table is read. Windows of new groups come with
    the next rebuild."""
    current = read_all_published(spark, root, ["plants", FILTER_OPTIONS])
    build = _Build(spark, root)
    build.put("plants", current["plants"].unionByName(plants))
    options = current[FILTER_OPTIONS].union(filter_options(spark.createDataFrame([], "city STRING"), plants))
    build.put(FILTER_OPTIONS, options.distinct().orderBy("filter", "value"))
    build.publish()
