"""Histories in batches against the same history at once."""

import random

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from sowcast.operators import climate, freeze, weather
from sowcast.plans import increments
from sowcast.sources import snapshots

COLUMNS = "city STRING, date DATE, temp_min DOUBLE, temp_max DOUBLE, soil_temp_0_7cm DOUBLE, soil_temp_7_to_28cm DOUBLE, precipitation DOUBLE"
AS_OF = "2026-02-28"


@pytest.fixture(scope="module")
def observations(spark):
    rng = random.Random(3)
    days = [f"{y}-{m:02d}-{d:02d}" for y in (2021, 2022, 2023, 2024) for m in (1, 2, 6, 7, 12) for d in (1, 15, 28)] + ["2024-02-29", "2024-12-31"]
    data = []
    for city in ("Bend", "Eugene", "Salem"):
        for d in days:
            # eighths, so that sums do not depend on their order
            values = [rng.choice([None, *(n / 8 for n in range(160, 640))]) for _ in range(5)]
            data.append((city, day(d), *values))
    return spark.createDataFrame(data, COLUMNS).cache()


def expected(observations):
    return [
        rows(climate.daily_climatology(observations, AS_OF)),
        rows(freeze.average_freeze_dates(freeze.freeze_by_year(observations), AS_OF)),
        rows(weather.irrigation_tracker(observations)),
    ]


def found(spark, root):
    return [
        rows(increments.climatology(spark, root, AS_OF)),
        rows(increments.freeze_dates(spark, root, AS_OF)),
        rows(increments.tracker(spark, root)),
    ]


def test_batches_of_any_cut_equal_the_whole(spark, observations, tmp_path):
    for n in range(2):
        root = str(tmp_path / f"root{n}")
        cut = F.pmod(F.xxhash64("city", "date"), F.lit(3))  # also inside years and weeks
        increments.start_history(spark, root, observations.where(cut == 0))
        increments.append_days(spark, root, observations.where(cut == 1))
        if n:
            increments.compact_history(spark, root)
        increments.append_days(spark, root, observations.where(cut == 2))
        increments.append_days(spark, root, observations.limit(0))
        assert found(spark, root) == expected(observations)


def test_replaced_cities_forget_earlier_batches_only(spark, observations, tmp_path):
    root = str(tmp_path / "root")
    early, late = F.year("date") < 2023, F.year("date") >= 2023
    bend = F.col("city") == "Bend"
    increments.start_history(spark, root, observations.withColumn("temp_min", F.when(bend, 0.0).otherwise(F.col("temp_min"))).where(early))
    increments.replace_cities(spark, root, observations.where(bend & early))
    increments.append_days(spark, root, observations.where(late))
    want = expected(observations)
    assert found(spark, root) == want
    increments.compact_history(spark, root)
    assert found(spark, root) == want
    # a city that is replaced again, by less
    increments.replace_cities(spark, root, observations.where(bend & late))
    assert found(spark, root) == expected(observations.where(~bend | late))


def test_a_batch_reads_nothing_of_the_others(spark, observations, tmp_path):
    root = str(tmp_path / "root")
    increments.start_history(spark, root, observations)
    for path in tmp_path.glob("root/*_parts/v=*/part-*.parquet"):
        path.write_bytes(b"not a table")  # reading it would fail
    increments.append_days(spark, root, observations)
    parts = snapshots.read_parts(spark, root, ["climate_parts"])["climate_parts"]
    assert len(parts) == 2 and list(parts.values())[1].count() > 0


def test_logs_keep_all_that_later_parts_add_to(spark, observations, tmp_path):
    root = str(tmp_path / "root")
    year = F.year("date")
    increments.start_history(spark, root, observations.where("city = 'Nowhere'"))
    increments.start_history(spark, root, observations.where(year < 2023))
    increments.append_days(spark, root, observations.where(year >= 2023))
    snapshots.compact_log(spark, root)
    assert found(spark, root) == expected(observations)
    with pytest.raises(LookupError):
        snapshots.read_parts(spark, root, ["unknown"])
