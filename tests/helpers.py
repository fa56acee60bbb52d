"""Small ways to write inputs and read results in tests."""

from datetime import date, timedelta

from sowcast.sources import schemas


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    found = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in found), key=lambda row: [str(v) for v in row])


def weather(spark, *entries):
    """Raw weather from (city, day, high, low, rain)."""
    data = [(day(d), hi, lo, rain, city) for city, d, hi, lo, rain in entries]
    return spark.createDataFrame(data, schemas.RAW_WEATHER)


def history(spark, *entries):
    """History from (city, day, low, high, shallow soil, deep soil)."""
    data = [(day(d), lo, hi, shallow, deep, city) for city, d, lo, hi, shallow, deep in entries]
    return spark.createDataFrame(data, schemas.HISTORY)


PLANT_DEFAULTS = {
    "common_name": "Kale",
    "plant_family": "Brassica",
    "growing_season": "Cool Season",
    "harvest_type": "Leaf",
    "weeks_indoor_before_transplant": 4,
    "days_to_maturity": 60,
    "min_viable_temp_f": 45.0,
    "max_viable_temp_f": 75.0,
    "ideal_temp_min_f": 55.0,
    "ideal_temp_max_f": 65.0,
    "square_feet_needed": 1.5,
    "direct_sow": False,
    "attracts_bees": False,
    "attracts_butterflies": False,
    "attracts_hummingbirds": False,
}


def plants(spark, *entries):
    """Plants from dicts of the columns that differ from the defaults."""
    data = [tuple({**PLANT_DEFAULTS, **e}.values()) for e in entries]
    return spark.createDataFrame(data, schemas.PLANTS)


def daily(spark, *entries):
    """Daily climate from (city, day, mean high, mean shallow soil)."""
    data = [(city, day(d), float(hi), None if soil is None else float(soil)) for city, d, hi, soil in entries]
    return spark.createDataFrame(data, "city STRING, date DATE, avg_max_temp DOUBLE, avg_shallow_soil_temp DOUBLE")


def last_freezes(spark, **by_city):
    data = [(city, day(d)) for city, d in by_city.items()]
    return spark.createDataFrame(data, "city STRING, avg_last_freeze_all_time DATE")


def groups(spark, *entries):
    """Plant groups from (season, type, weeks, maturity, maximum, minimum)."""
    schema = (
        "growing_season STRING, harvest_type STRING, avg_weeks_indoor DOUBLE, avg_days_to_maturity DOUBLE, "
        "avg_max_viable_temp DOUBLE, avg_min_viable_temp DOUBLE"
    )
    return spark.createDataFrame([tuple(e) for e in entries], schema)


def selection(spark, *pairs):
    return spark.createDataFrame(list(pairs), "city STRING, common_name STRING")


def days_from(start: str, count: int) -> list[str]:
    return [(day(start) + timedelta(n)).isoformat() for n in range(count)]
