"""What must hold for any input, on the benchmark-shaped tables and on random ones."""

import datetime
import os
import random

import pytest
from helpers import groups, history, plants, rows, selection, weather
from pyspark.sql import functions as F

from sowcast.operators import catalogue, climate, conditions, freeze, planting, weather as weather_ops
from workload.bindings import AS_OF, Inputs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def inputs(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no benchmark tables")
    return Inputs(spark, SF_DIR)


@pytest.fixture(scope="module")
def built(inputs):
    freezes = freeze.average_freeze_dates(freeze.freeze_by_year(inputs.history), AS_OF)
    daily = climate.daily_data(inputs.sun, climate.daily_climatology(inputs.history, AS_OF))
    return daily.cache(), freezes.cache()


def random_calendar(seed, cities=5, days=60):
    rng = random.Random(seed)
    first = datetime.date(2026, 4, 1)
    return [
        (f"city{c}", first + datetime.timedelta(d), rng.choice([60, 70, 80, 90, 95.5]), rng.choice([None, *range(40, 80)]))
        for c in range(cities)
        for d in sorted(rng.sample(range(days), rng.randint(1, days)))
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("buckets", [1, 64])
def test_windows_equal_brute_force(spark, seed, buckets):
    rng = random.Random(seed + 100)
    calendar = random_calendar(seed)
    freezes = {f"city{c}": datetime.date(2026, 4, rng.randint(1, 20)) for c in range(4)}
    wanted_groups = [
        (f"s{n}", "t", 1.0, 30.0, rng.choice([65.0, 85.0, 99.0, None]), rng.choice([None, 30.0, *map(float, range(40, 85, 3))]))
        for n in range(25)
    ]
    expected = []
    for season, kind, weeks, maturity, hottest, coolest in wanted_groups:
        for city, freeze_day in freezes.items():
            mine = [(d, hi, soil) for c, d, hi, soil in calendar if c == city]
            warm = [d for d, _, soil in mine if d > freeze_day and None not in (soil, coolest) and soil > coolest]
            if warm:
                hot = [d for d, hi, _ in mine if d >= min(warm) and hottest is not None and hi > hottest]
                expected.append((city, season, min(warm), min(hot, default=None)))

    # one city repeats its days many times, and a few days with other readings
    calendar = calendar + [r for r in calendar if r[0] == "city0"] * 20
    calendar = calendar + [(c, d, hi - 5, s and s - 5) for c, d, hi, s in calendar[::7]]
    daily = spark.createDataFrame(
        [(c, d, float(hi), None if s is None else float(s)) for c, d, hi, s in calendar],
        "city STRING, date DATE, avg_max_temp DOUBLE, avg_shallow_soil_temp DOUBLE",
    )
    freeze_rows = spark.createDataFrame(list(freezes.items()), "city STRING, avg_last_freeze_all_time DATE")
    group_rows = groups(spark, *wanted_groups)
    got = planting.temperature_limit(daily, freeze_rows, group_rows, buckets)
    starts = planting.outdoor_start(daily, freeze_rows, group_rows, buckets)
    assert rows(starts) == rows(got.drop("temp_limit_date"))
    assert rows(got, "city", "growing_season", "outdoor_start", "temp_limit_date") == sorted(
        expected, key=lambda row: [str(v) for v in row]
    )


def test_one_pass_freezes_equal_the_self_join(inputs):
    cold = inputs.history.where("temp_min <= 32").select("city", "date", F.year("date").alias("year"))
    last = cold.where(F.month("date") <= 6).groupBy("city", "year").agg(F.max("date").alias("last_freeze"))
    first = cold.where(F.month("date") > 6).groupBy("city", "year").agg(F.min("date").alias("first_freeze"))
    assert rows(freeze.freeze_by_year(inputs.history)) == rows(last.join(first, ["city", "year"]))


def test_window_dates_are_in_order(inputs, built):
    daily, freezes = built
    windows = planting.planting_calendar(daily, freezes, inputs.plants)
    checked = windows.join(freezes, "city").join(
        planting.plant_groups(inputs.plants), ["growing_season", "harvest_type"]
    )
    wrong = checked.where(
        (F.col("outdoor_start") <= F.col("avg_last_freeze_all_time"))
        | (F.col("planting_end") < F.col("outdoor_start"))
        | (F.datediff("planting_end", "outdoor_start") > F.col("avg_days_to_maturity") + 0.5)
    )
    assert windows.count() > 0
    assert wrong.isEmpty()


def test_all_cities_at_once_equal_each_city_alone(spark, inputs, built):
    daily, freezes = built
    raw = inputs.raw_weather.cache()
    cities = [r.city for r in raw.select("city").distinct().orderBy("city").collect()]

    def answers(only=None):
        def pick(df):
            return df if only is None else df.where(F.col("city") == only)

        day_rows = weather_ops.daily_weather(pick(raw))
        tracker = weather_ops.irrigation_tracker(day_rows)
        return {
            "windows": rows(planting.planting_calendar(pick(daily), pick(freezes), inputs.plants)),
            "recent": rows(conditions.recent_weeks(day_rows, tracker, AS_OF)),
            "forecast": rows(conditions.forecast(day_rows, AS_OF)),
            "viability": rows(catalogue.weekly_viability(day_rows, inputs.plants, pick(inputs.selection), AS_OF)),
        }

    together = answers()
    alone = [answers(city) for city in cities[:3]]
    for name, found in together.items():
        column = 1 if name == "viability_by_plant" else 0
        few = [r for r in found if r[column] in cities[:3]]
        assert few == sorted((r for a in alone for r in a[name]), key=lambda row: [str(v) for v in row])


def test_order_and_partitioning_do_not_matter(inputs):
    plain = inputs.history
    shuffled = inputs.history.repartition(7).orderBy(F.rand(3))
    for build in (
        freeze.freeze_by_year,
        lambda h: climate.daily_climatology(h, AS_OF),
        lambda h: freeze.average_freeze_dates(freeze.freeze_by_year(h), AS_OF),
    ):
        assert rows(build(plain)) == rows(build(shuffled))


def test_a_city_with_most_rows_and_many_copies(spark):
    """One city holds nearly all rows, most of them copies of one day."""
    copies = [("Hot", "2026-02-28", 60.0, 30.0, 0.125)] * 3000
    others = [(f"c{n}", "2026-02-28", 60.0, 30.0, 0.125) for n in range(20)]
    raw = weather(spark, *copies, *others).repartition(8)
    day_rows = weather_ops.daily_weather(raw)
    tracker = weather_ops.irrigation_tracker(day_rows)
    assert rows(tracker.where("city = 'Hot'"), "total_rainfall") == [(375.0,)]
    assert conditions.forecast(day_rows, "2026-02-28").where("city = 'Hot'").count() == 10
    chosen = selection(spark, *[("Hot", f"p{n}") for n in range(200)], *[(f"c{n}", "p0") for n in range(20)])
    table = plants(spark, *[{"common_name": f"p{n}"} for n in range(200)])
    got = catalogue.weekly_viability(day_rows, table, chosen, "2026-02-28")
    assert rows(got.groupBy("city", "viable_days").count().where("city = 'Hot'")) == [("Hot", 3000, 200)]
    seen = history(spark, *[("Hot", "2020-02-01", 20.0, 40.0, 50.0, 50.0)] * 3000, ("Hot", "2020-10-01", 20.0, 40.0, 50.0, 50.0))
    assert rows(freeze.freeze_by_year(seen), "city", "year") == [("Hot", 2020)]
    assert climate.daily_climatology(seen, "2026-02-28").count() == 2


@pytest.mark.parametrize("days", [1, 7, 365])
def test_viable_days_equal_brute_force(spark, days):
    rng = random.Random(days)
    first = datetime.date(2026, 2, 28)
    forecast = [
        (f"city{c}", first + datetime.timedelta(d), rng.choice([None, *(x / 2 for x in range(80, 200))]))
        for c in range(4)
        for d in rng.sample(range(400), 300)
        for _ in range(rng.choice([1, 1, 2]))  # some days twice
    ]
    forecast += [("only nulls", first, None)]
    bands = {f"p{n}": (rng.choice([None, *map(float, range(40, 100))]), rng.choice([None, *map(float, range(40, 100))])) for n in range(60)}
    table = plants(spark, *[{"common_name": n, "min_viable_temp_f": lo, "max_viable_temp_f": hi} for n, (lo, hi) in bands.items()])
    cities = sorted({c for c, _, _ in forecast}) + ["no forecast"]
    chosen = selection(spark, *[(c, n) for c in cities for n in bands])
    daily = spark.createDataFrame(forecast, "city STRING, date DATE, temp_max DOUBLE")
    got = catalogue.weekly_viability(daily, table, chosen, "2026-02-28", days=days)
    expected = []
    for c in cities:
        mine = [t for city, d, t in forecast if city == c and 0 <= (d - first).days < days]
        for n, (lo, hi) in bands.items():
            if mine:
                expected.append((c, n, sum(None not in (t, lo, hi) and lo <= t <= hi for t in mine)))
    assert rows(got, "city", "common_name", "viable_days") == sorted(expected, key=lambda row: [str(v) for v in row])
