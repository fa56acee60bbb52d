"""Weather-shaped inputs derived from the benchmark tables.

Stations are suppliers, so their number grows with the data while each keeps
some years of days: a station's day is what it shipped on that day. Temperatures
are whole eighths of a degree, which makes sums and averages exact in any order.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.sources.payloads import SUN_CLOCKS, SUN_FIELDS

AS_OF = "2001-07-15"
YEAR = 2001

# the columns used, so that no job is spent on reading file footers for a schema
TABLES = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "lineitem": (
        "l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
        "l_discount DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ"
    ),
}


def _eighths(price: Column) -> Column:
    return F.floor(price / 125) / F.lit(8.0)


def _clock(seconds: Column, pattern: str) -> Column:
    midnight = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.date_format(F.timestamp_add("SECOND", seconds.cast("int"), midnight), pattern)


class Inputs:
    """The library's input tables for one directory of benchmark tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def stations(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("station"), F.col("s_name").alias("city"), "s_nationkey", "s_acctbal"
        )

    @cached_property
    def observations(self) -> DataFrame:
        """One row per station and day, in the union of the weather and history schemas."""
        price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
        days = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("station"), F.col("l_shipdate").cast("date").alias("date"))
            .agg(
                _eighths(F.max(price)).alias("temp_max"),
                F.when(F.max("l_tax") < 0.08, _eighths(F.min(price * (1 - F.col("l_discount"))))).alias(
                    "temp_min"
                ),
                F.when(F.max("l_linenumber") < 7, F.sum(quantity) / 100).alias("precipitation"),
                (F.max(quantity) + 40).alias("soil_temp_0_7cm"),
                (F.min(quantity) + 45).alias("soil_temp_7_to_28cm"),
            )
        )
        return days.join(self.stations.select("station", "city"), "station").drop("station")

    @cached_property
    def raw_weather(self) -> DataFrame:
        return self.observations.select("date", "temp_max", "temp_min", "precipitation", "city")

    @cached_property
    def history(self) -> DataFrame:
        return self.observations.select(
            "date", "temp_min", "temp_max", "soil_temp_0_7cm", "soil_temp_7_to_28cm", "city"
        )

    @cached_property
    def sun_seconds(self) -> DataFrame:
        """Sun times of one year in seconds of the day, per station and day."""
        first, last = (F.make_date(F.lit(YEAR), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
        # spread the stations before each becomes 365 rows; with the number given,
        # their few bytes are not merged into one partition
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        spread = self.stations.repartition(partitions, "city")
        days = spread.withColumn("date", F.explode(F.sequence(first, last)))
        from_solstice = F.abs(F.dayofyear("date") - 172)
        rise = 21600 + from_solstice * 37 + F.col("s_nationkey") * 41
        dusk = 72000 - from_solstice * 41 - F.col("s_nationkey") * 37
        return days.select(
            "city",
            "date",
            # some stations have no morning twilight
            F.when(F.col("s_acctbal") >= 0, rise - 1800).alias("morning_twilight"),
            rise.alias("sunrise"),
            F.floor((rise + dusk) / 2).alias("solar_noon"),
            dusk.alias("sunset"),
            (dusk + 1800).alias("evening_twilight"),
            _clock(dusk - rise, "H:mm:ss").alias("day_length"),
        )

    @cached_property
    def smooth_daily(self) -> DataFrame:
        """Daily climate that rises and falls with the year, as means over many years do:
        nearly every day up to the summer is the warmest so far."""
        from_summer = F.abs(F.dayofyear("date") - 200)
        squared = from_summer * from_summer
        station = self.sun.join(self.stations.select("city", "s_nationkey"), "city")
        return station.select(
            "city",
            "date",
            (F.lit(95) + F.col("s_nationkey") - F.floor(squared / 64) / 8).alias("avg_max_temp"),
            (F.lit(98) - F.floor(squared / 80) / 8).alias("avg_shallow_soil_temp"),
        )

    @cached_property
    def landed_sun(self) -> DataFrame:
        """Sun times as a service sends them, in 12-hour text under its own names."""
        columns = {ours: theirs for theirs, ours in SUN_FIELDS.items()}
        return self.sun_seconds.select(
            "city",
            F.date_format("date", "M/d/yyyy").alias("date"),
            *[_clock(F.col(c), "h:mm:ss a").alias(columns[c]) for c in SUN_CLOCKS],
            "day_length",
        )

    @cached_property
    def sun(self) -> DataFrame:
        clocks = [_clock(F.col(c), "HH:mm:ss").alias(c) for c in SUN_CLOCKS]
        # Spark takes the 365 rows for as large as the one before and would broadcast them
        # all; once they are shuffled it knows their size
        days = self.sun_seconds.repartition("city", "date")
        return days.select("city", "date", *clocks, "day_length")

    @cached_property
    def plants(self) -> DataFrame:
        size = F.col("p_size")
        brand = F.substring("p_brand", 7, 4).cast("int")
        coolest = 42 + brand * 1.75 + size / 8
        warmest = 70.0 + size  # inside the range of the stations' highs
        return self.table("part").select(
            F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("common_name"),
            F.col("p_name").alias("plant_family"),
            F.col("p_type").alias("growing_season"),
            F.col("p_brand").alias("harvest_type"),
            F.when((F.col("p_type") != "PROMO") & (size <= 45), F.floor(size / 5).cast("int")).alias(
                "weeks_indoor_before_transplant"
            ),
            (30 + 2 * size).alias("days_to_maturity"),
            coolest.alias("min_viable_temp_f"),
            warmest.alias("max_viable_temp_f"),
            (coolest + 10).alias("ideal_temp_min_f"),
            (warmest - 10).alias("ideal_temp_max_f"),
            F.col("p_retailprice").alias("square_feet_needed"),
            F.when(size <= 40, size <= 10).alias("direct_sow"),
            (size <= 25).alias("attracts_bees"),
            (F.col("p_retailprice") > 950).alias("attracts_butterflies"),
            F.col("p_name").startswith("red").alias("attracts_hummingbirds"),
        )

    @cached_property
    def part_names(self) -> DataFrame:
        names = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("common_name"),
        )
        return names.hint("merge")  # not broadcast: as many as there are parts

    @cached_property
    def selection(self) -> DataFrame:
        """The plants each station shipped, repeats included."""
        cities = self.stations.select(F.col("station").alias("l_suppkey"), "city")
        return (
            self.table("lineitem")
            .select("l_suppkey", "l_partkey")
            .join(cities, "l_suppkey")
            .join(self.part_names, "l_partkey")
            .select("city", "common_name")
        )

    @cached_property
    def picks(self) -> DataFrame:
        """The plants that a user picked in each city: those the station shipped on its last day."""
        shipped = self.table("lineitem").select("l_suppkey", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
        last = shipped.groupBy("l_suppkey").agg(F.max("day").alias("day"))
        cities = self.stations.select(F.col("station").alias("l_suppkey"), "city")
        return shipped.join(last, ["l_suppkey", "day"]).join(cities, "l_suppkey").join(self.part_names, "l_partkey").select("city", "common_name")

    def forecast_payloads(self, faults: bool = False) -> DataFrame:
        """Weather as landed: a columnar JSON record per station and year.

        With ``faults``, the payloads of some stations are cut off, lack their
        arrays, or have arrays of unequal length.
        """
        days = self.raw_weather.groupBy("city", F.year("date").alias("year")).agg(
            F.array_sort(
                F.collect_list(F.struct("date", "temp_max", "temp_min", "precipitation"))
            ).alias("days")
        )
        highs = F.col("days.temp_max")
        balance = F.col("s_acctbal")
        if faults:
            days = days.join(self.stations.select("city", "s_acctbal"), "city")
            highs = F.when(balance.between(0, 1000), F.slice(highs, 2, F.size("days"))).otherwise(highs)
        daily = F.struct(
            F.transform("days.date", lambda d: F.date_format(d, "yyyy-MM-dd")).alias("time"),
            highs.alias("temperature_2m_max"),
            F.col("days.temp_min").alias("temperature_2m_min"),
            F.col("days.precipitation").alias("precipitation_sum"),
        )
        if not faults:
            return days.select(F.to_json(F.struct("city", daily.alias("daily"))).alias("value"))
        daily = F.when(~balance.between(1000.01, 2000), daily)
        text = F.to_json(F.struct("city", daily.alias("daily")))
        cut_off = F.substring(text, F.lit(1), F.length(text) - 3)
        return days.select(F.when(balance < 0, cut_off).otherwise(text).alias("value"))

    def history_payloads(self) -> DataFrame:
        days = self.history.groupBy("city", F.year("date").alias("year")).agg(
            F.array_sort(
                F.collect_list(
                    F.struct("date", "temp_min", "temp_max", "soil_temp_0_7cm", "soil_temp_7_to_28cm")
                )
            ).alias("days")
        )
        daily = F.struct(
            F.transform("days.date", lambda d: F.date_format(d, "yyyy-MM-dd")).alias("time"),
            F.col("days.temp_min").alias("temperature_2m_min"),
            F.col("days.temp_max").alias("temperature_2m_max"),
            F.col("days.soil_temp_0_7cm").alias("soil_temperature_0_to_7cm_mean"),
            F.col("days.soil_temp_7_to_28cm").alias("soil_temperature_7_to_28cm_mean"),
        )
        return days.select(F.to_json(F.struct("city", daily.alias("daily"))).alias("value"))

    def sun_payloads(self, faults: bool = False) -> DataFrame:
        """Sun times as landed: a JSON record per station with a list of days.

        With ``faults``, the payloads of some stations are cut off or lack the
        station or the records, and some days of others lack a date.
        """
        landed = self.landed_sun
        balance = F.col("s_acctbal")
        if faults:
            landed = landed.join(self.stations.select("city", "s_acctbal"), "city").withColumn(
                "date", F.when((balance > 5000) & F.col("date").startswith("6/"), "-").otherwise(F.col("date"))
            )
        record = F.struct(*[c for c in self.landed_sun.columns if c != "city"])
        keys = ["city", "s_acctbal"] if faults else ["city"]
        days = landed.groupBy(*keys).agg(F.collect_list(record).alias("results"))
        if not faults:
            return days.select(F.to_json(F.struct("city", "results")).alias("value"))
        city = F.when(~balance.between(0, 1000), F.col("city")).alias("city")
        results = F.when(~balance.between(1000.01, 2000), F.col("results")).alias("results")
        text = F.to_json(F.struct(city, results))
        cut_off = F.substring(text, F.lit(1), F.length(text) - 3)
        return days.select(F.when(balance < 0, cut_off).otherwise(text).alias("value"))
