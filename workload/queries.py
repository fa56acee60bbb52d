"""One query per dataset and operator, over the whole benchmark tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.operators import catalogue, climate, conditions, freeze, planting, relational, weather
from sowcast.plans import increments, jobs, questions
from sowcast.sources import payloads, schemas, snapshots, tables
from sowcast.sources.scratch import scratch_dir
from workload.bindings import AS_OF, Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# weather and irrigation


@query
def daily_weather(i: Inputs) -> DataFrame:
    return weather.daily_weather(i.raw_weather)


@query
def irrigation_tracker(i: Inputs) -> DataFrame:
    return weather.irrigation_tracker(daily_weather(i))


@query
def irrigation_latest5(i: Inputs) -> DataFrame:
    return weather.latest_weeks(irrigation_tracker(i))


# freeze dates


@query
def freeze_by_year(i: Inputs) -> DataFrame:
    return freeze.freeze_by_year(i.history)


@query
def avg_freeze_dates(i: Inputs) -> DataFrame:
    return freeze.average_freeze_dates(freeze_by_year(i), AS_OF)


@query
def freeze_callout(i: Inputs) -> DataFrame:
    return freeze.freeze_callout(avg_freeze_dates(i))


# climate


@query
def climatology_daily(i: Inputs) -> DataFrame:
    return climate.daily_climatology(i.history, AS_OF)


@query
def daily_data(i: Inputs) -> DataFrame:
    return climate.daily_data(i.sun, climatology_daily(i))


@query
def seasonal_conditions(i: Inputs) -> DataFrame:
    return climate.seasonal_conditions(i.sun, daily_data(i), avg_freeze_dates(i))


@query
def daylight_bands(i: Inputs) -> DataFrame:
    return climate.daylight_bands(i.sun)


# planting windows


@query
def group_params(i: Inputs) -> DataFrame:
    return planting.plant_groups(i.plants)


@query
def outdoor_start(i: Inputs) -> DataFrame:
    return planting.outdoor_start(daily_data(i), avg_freeze_dates(i), group_params(i))


@query
def temp_limit(i: Inputs) -> DataFrame:
    return planting.temperature_limit(daily_data(i), avg_freeze_dates(i), group_params(i))


@query
def planting_windows(i: Inputs) -> DataFrame:
    return planting.planting_calendar(daily_data(i), avg_freeze_dates(i), i.plants)


@query
def planting_windows_smooth(i: Inputs) -> DataFrame:
    """Planting windows in a climate whose highs rise day by day up to the summer."""
    return planting.planting_calendar(i.smooth_daily, avg_freeze_dates(i), i.plants)


# conditions


@query
def today_conditions(i: Inputs) -> DataFrame:
    return conditions.today_conditions(i.stations, daily_weather(i), i.sun, AS_OF)


@query
def recent_weeks(i: Inputs) -> DataFrame:
    return conditions.recent_weeks(daily_weather(i), irrigation_tracker(i), AS_OF)


@query
def recent_weeks_no_tracker(i: Inputs) -> DataFrame:
    daily = daily_weather(i)
    return conditions.recent_weeks(daily, irrigation_tracker(i).where(F.lit(False)), AS_OF)


@query
def forecast_next10(i: Inputs) -> DataFrame:
    return conditions.forecast(daily_weather(i), AS_OF)


@query
def forecast_range(i: Inputs) -> DataFrame:
    return conditions.forecast_range(forecast_next10(i))


# plants


@query
def plant_catalogue(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants)


@query
def plant_catalogue_by_season(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants, growing_season="ECONOMY")


@query
def plant_catalogue_by_type(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants, harvest_type="Brand#17")


@query
def plant_catalogue_for_bees(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants, growing_season="ECONOMY", pollinator="bees")


@query
def plant_catalogue_for_butterflies(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants, pollinator="butterflies")


@query
def plant_catalogue_for_hummingbirds(i: Inputs) -> DataFrame:
    return catalogue.plant_catalogue(i.plants, pollinator="hummingbirds")


@query
def filter_options(i: Inputs) -> DataFrame:
    cities = planting.cities_with_windows(daily_data(i), avg_freeze_dates(i), group_params(i))
    return catalogue.filter_options(cities, i.plants)


@query
def weekly_viability(i: Inputs) -> DataFrame:
    return catalogue.weekly_viability(daily_weather(i), i.plants, i.selection, AS_OF)


@query
def viability_next_28_days(i: Inputs) -> DataFrame:
    return catalogue.weekly_viability(daily_weather(i), i.plants, i.selection, AS_OF, days=28)


@query
def planting_segments(i: Inputs) -> DataFrame:
    return catalogue.planting_segments(i.plants, planting_windows(i), i.selection)


@query
def planting_export(i: Inputs) -> DataFrame:
    return catalogue.planting_export(i.plants, planting_windows(i), i.selection)


@query
def selection_semi_join(i: Inputs) -> DataFrame:
    return relational.keep_selected(i.plants, i.selection, ["common_name"])


@query
def picked_plants(i: Inputs) -> DataFrame:
    """The segments of the plants that were picked in each city, with their place in the
    order in which a city's segments are shown."""
    segments = catalogue.planting_segments(i.plants, planting_windows(i), i.picks)
    return relational.with_display_place(segments, "planting_segments")


@query
def windows_of_picked_cities(i: Inputs) -> DataFrame:
    """The segments of picked plants that hummingbirds visit, from a history written by city
    of which only the cities of such picks are read."""
    flowers = i.plants.where("attracts_hummingbirds").select("common_name")
    picks = relational.keep_selected(i.picks, flowers, ["common_name"])
    path = f"{scratch_dir(i.spark, 'by-city')}/history"
    tables.write_by_city(i.history, path)
    own = tables.read_cities(i.spark, path, picks, schemas.HISTORY)
    windows = questions.windows_of_cities(own, i.sun, i.plants, picks, AS_OF)
    return catalogue.planting_segments(i.plants, windows, picks)


@query
def segments_of_bucketed_windows(i: Inputs) -> DataFrame:
    """The segments of selected plants, from windows stored in buckets by city and group,
    which are not shuffled again for each question."""
    path = scratch_dir(i.spark, "bucketed")
    name = "windows_" + path.rpartition("-")[2]
    tables.write_bucketed(planting_windows(i), name, path, ["city", *planting.GROUP], buckets=8)
    return catalogue.planting_segments(i.plants, i.spark.table(name), i.selection)


@query
def selection_in_list(i: Inputs) -> DataFrame:
    return relational.keep_values(i.plants, "growing_season", ["ECONOMY", "PROMO"])


# sources and sinks


def _land(i: Inputs, lines: DataFrame, label: str) -> str:
    path = f"{scratch_dir(i.spark, label)}/landed"
    lines.write.options(**tables.FAST_GZIP).text(path, compression="gzip")
    return path


@query
def json_forecast_rows(i: Inputs) -> DataFrame:
    return payloads.read_forecast(i.spark, _land(i, i.forecast_payloads(), "forecast"))


@query
def json_history_rows(i: Inputs) -> DataFrame:
    return payloads.read_history(i.spark, _land(i, i.history_payloads(), "history"))


@query
def json_sun_rows(i: Inputs) -> DataFrame:
    return payloads.read_sun(i.spark, _land(i, i.sun_payloads(), "sun"))


@query
def json_bad_records(i: Inputs) -> DataFrame:
    return payloads.read_forecast(i.spark, _land(i, i.forecast_payloads(faults=True), "faults"))


@query
def json_skipped_payloads(i: Inputs) -> DataFrame:
    landed = _land(i, i.forecast_payloads(faults=True), "faults")
    skipped = payloads.skipped_payloads(i.spark, landed, payloads.FORECAST_FIELDS)
    return skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("skipped"))


@query
def json_sun_skipped(i: Inputs) -> DataFrame:
    """What is skipped of partly faulty sun payloads, and the days that are left."""
    landed = _land(i, i.sun_payloads(faults=True), "sun-faults")
    skipped = payloads.skipped_sun(i.spark, landed).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    left = payloads.read_sun(i.spark, landed).agg(F.count(F.lit(1)).alias("records"))
    return skipped.union(left.select(F.lit("read").alias("reason"), "records"))


def _csv(i: Inputs, df: DataFrame, label: str, **options) -> str:
    path = f"{scratch_dir(i.spark, label)}/csv"
    tables.write_csv(df, path, **options)
    return path


@query
def csv_weather_roundtrip(i: Inputs) -> DataFrame:
    return tables.read_weather_csv(i.spark, _csv(i, i.raw_weather, "weather"))


@query
def csv_weather_inferred(i: Inputs) -> DataFrame:
    return tables.read_csv(i.spark, _csv(i, i.raw_weather, "weather"))


@query
def csv_history_roundtrip(i: Inputs) -> DataFrame:
    return tables.read_history_csv(i.spark, _csv(i, i.history, "history"))


@query
def csv_sun_roundtrip(i: Inputs) -> DataFrame:
    month_first = i.sun.withColumn("date", F.date_format("date", "M/d/yyyy"))
    return tables.read_sun_csv(i.spark, _csv(i, month_first, "sun"))


@query
def csv_mixed_headers(i: Inputs) -> DataFrame:
    """Files with the columns in two orders, read together."""
    path = f"{scratch_dir(i.spark, 'mixed')}/csv"
    year = F.year("date")
    tables.write_csv(i.raw_weather.where(year < 1995), f"{path}/part=1")
    late = i.raw_weather.where((year >= 1995) | year.isNull())
    tables.write_csv(late.select("city", "precipitation", "temp_min", "temp_max", "date"), f"{path}/part=2")
    return tables.read_csv(i.spark, [f"{path}/part=1", f"{path}/part=2"], schemas.RAW_WEATHER, mixed_headers=True)


@query
def csv_three_headers(i: Inputs) -> DataFrame:
    """Files of three shapes: the usual one, columns in another order, and further columns
    of which one has a comma in its name."""
    path = f"{scratch_dir(i.spark, 'shapes')}/csv"
    year = F.coalesce(F.year("date"), F.lit(0))
    tables.write_csv(i.raw_weather.where(year < 1995), f"{path}/part=1")
    middle = i.raw_weather.where((year >= 1995) & (year < 1998))
    tables.write_csv(middle.select("city", "precipitation", "temp_min", "temp_max", "date"), f"{path}/part=2")
    late = i.raw_weather.where(year >= 1998)
    tables.write_csv(late.select(F.lit("x").alias("read by, if known"), "*", year.alias("year")), f"{path}/part=3")
    parts = [f"{path}/part={n}" for n in (1, 2, 3)]
    return tables.read_csv(i.spark, parts, schemas.RAW_WEATHER, mixed_headers=True)


@query
def csv_skipped_values(i: Inputs) -> DataFrame:
    """Rows of each city whose high is text, and how many highs are left."""
    high = F.when(F.col("temp_min") < 32, "warm").otherwise(F.col("temp_max").cast("string"))
    path = _csv(i, i.raw_weather.withColumn("temp_max", high), "unreadable")
    bad = tables.unreadable_rows(i.spark, path, schemas.RAW_WEATHER).groupBy("city").agg(F.count("line").alias("unreadable"))
    left = tables.read_weather_csv(i.spark, path).groupBy("city").agg(F.count("temp_max").alias("highs"))
    return left.join(bad, "city", "left").select("city", F.coalesce("unreadable", F.lit(0)).alias("unreadable"), "highs")


@query
def csv_plants_roundtrip(i: Inputs) -> DataFrame:
    return tables.read_plants_csv(i.spark, _csv(i, i.plants, "plants"))


@query
def csv_export(i: Inputs) -> DataFrame:
    export = relational.for_display(planting_export(i), "planting_export")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in export.schema)
    # as text the rows are five times as large as the tables that they come from
    return tables.read_csv(i.spark, _csv(i, export, "export", compression="gzip"), columns)


# jobs


def _rebuild(i: Inputs) -> str:
    root = f"{scratch_dir(i.spark, 'rebuild')}/tables"
    jobs.full_rebuild(i.spark, root, i.raw_weather, i.history, i.sun, i.plants, AS_OF)
    return root


@query
def full_rebuild(i: Inputs) -> DataFrame:
    return snapshots.read_published(i.spark, _rebuild(i), "planting_gantt")


@query
def stored_filter_options(i: Inputs) -> DataFrame:
    """The filter options that a rebuild stores, after some plants were added later."""
    root = f"{scratch_dir(i.spark, 'options')}/tables"
    late = F.col("growing_season") == "PROMO"
    jobs.full_rebuild(i.spark, root, i.raw_weather, i.history, i.sun, i.plants.where(~late), AS_OF)
    jobs.add_plants(i.spark, root, i.plants.where(late))
    return jobs.stored_filter_options(i.spark, root)


@query
def build_audit(i: Inputs) -> DataFrame:
    return jobs.build_audit(i.spark, _rebuild(i))


def _in_batches(i: Inputs, compact: bool) -> str:
    """A history that came in three batches of years, after which some stations were corrected."""
    root = f"{scratch_dir(i.spark, 'batches')}/tables"
    year = F.coalesce(F.year("date"), F.lit(0))
    corrected = i.stations.where("s_acctbal < 2000").select("city")
    known = i.observations.join(corrected.withColumn("wrong", F.lit(1)), "city", "left")
    # what was first told of the stations that are corrected later was ten degrees too cold
    off = F.when(F.col("wrong").isNull(), 0).otherwise(10)
    told = known.select("city", "date", "precipitation", *[(F.col(c) - off).alias(c) for c in ("temp_max", "temp_min", "soil_temp_0_7cm", "soil_temp_7_to_28cm")])
    increments.start_history(i.spark, root, told.where(year < 1995))
    increments.append_days(i.spark, root, told.where((year >= 1995) & (year < 1998)))
    if compact:
        increments.compact_history(i.spark, root)
    increments.append_days(i.spark, root, told.where(year >= 1998))
    increments.replace_cities(i.spark, root, relational.keep_selected(i.observations, corrected, ["city"]))
    if compact:
        increments.compact_history(i.spark, root)
    return root


@query
def climatology_in_batches(i: Inputs) -> DataFrame:
    return increments.climatology(i.spark, _in_batches(i, compact=False), AS_OF)


@query
def tracker_in_batches(i: Inputs) -> DataFrame:
    return increments.tracker(i.spark, _in_batches(i, compact=False))


@query
def windows_in_batches(i: Inputs) -> DataFrame:
    """Planting windows of a history in batches whose parts were united in between."""
    return increments.planting_windows(i.spark, _in_batches(i, compact=True), i.sun, i.plants, AS_OF)


@query
def forecast_refresh(i: Inputs) -> DataFrame:
    """The tracker after a refresh from partly faulty payloads and another from useless ones."""
    root = f"{scratch_dir(i.spark, 'refresh')}/tables"
    jobs.refresh_forecast(i.spark, root, _land(i, i.forecast_payloads(faults=True), "good"))
    useless = i.forecast_payloads().select(F.translate("value", "{", "[").alias("value"))
    jobs.refresh_forecast(i.spark, root, _land(i, useless, "bad"))
    return snapshots.read_published(i.spark, root, "irrigation_tracker")


@query
def history_ingest(i: Inputs) -> DataFrame:
    root = f"{scratch_dir(i.spark, 'ingest')}/tables"
    jobs.ingest_history(i.spark, root, _land(i, i.history_payloads(), "history"))
    return snapshots.read_published(i.spark, root, jobs.LANDED_HISTORY)


@query
def sun_ingest(i: Inputs) -> DataFrame:
    root = f"{scratch_dir(i.spark, 'ingest')}/tables"
    jobs.ingest_sun(i.spark, root, _land(i, i.sun_payloads(), "sun"))
    return snapshots.read_published(i.spark, root, jobs.LANDED_SUN)


@query
def rebuild_from_landed(i: Inputs) -> DataFrame:
    """Planting windows after all inputs were ingested and everything was rebuilt from them."""
    root = f"{scratch_dir(i.spark, 'landed')}/tables"
    jobs.refresh_forecast(i.spark, root, _land(i, i.forecast_payloads(), "forecast"))
    jobs.ingest_history(i.spark, root, _land(i, i.history_payloads(), "history"))
    jobs.ingest_sun(i.spark, root, _land(i, i.sun_payloads(), "sun"))
    jobs.rebuild_from_landed(i.spark, root, i.plants, AS_OF)
    return snapshots.read_published(i.spark, root, "planting_gantt")
