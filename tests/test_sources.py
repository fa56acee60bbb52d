"""Payloads, CSV, published tables and the jobs on top of them."""

import json
import re
from types import SimpleNamespace

import pytest
from helpers import day, days_from, plants, rows, weather
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sowcast.operators import catalogue, climate, freeze, planting, relational
from sowcast.plans import jobs, questions
from sowcast.sources import payloads, schemas, snapshots, tables
from sowcast.sources.scratch import drop_scratch, scratch_dir, scratch_root, stored
from workload.bindings import AS_OF, Inputs
from workload.queries import QUERIES


def columnar(city, days=3, start="2026-02-02", **changes):
    arrays = {
        "time": days_from(start, days),
        "temperature_2m_max": [50.0 + n for n in range(days)],
        "temperature_2m_min": [30.0 + n for n in range(days)],
        "precipitation_sum": [0.5] * days,
    }
    arrays.update(changes)
    return json.dumps({"city": city, "daily": arrays, "elevation": 12.0})


def land(folder, *lines, name="payloads.json"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


class TestPayloads:
    def test_bad_payloads_drop_only_their_city(self, spark, tmp_path):
        path = land(
            tmp_path / "in",
            columnar("Bend"),
            columnar("Cut off")[:-4],
            json.dumps({"city": "No daily", "error": True}),
            columnar("Short", precipitation_sum=[0.1]),
            columnar("Missing", temperature_2m_min=None),
            columnar("Bad day", time=["2026-02-02", "soon", "2026-02-04"]),
            columnar("Empty", 0),
            columnar("Nulls", 1, precipitation_sum=[None]),
        )
        got = payloads.read_forecast(spark, path)
        assert rows(got, "city").count(("Bend",)) == 3
        assert rows(got.where("city <> 'Bend'")) == [(day("2026-02-02"), 50.0, 30.0, None, "Nulls")]
        assert got.columns == ["date", "temp_max", "temp_min", "precipitation", "city"]
        skipped = payloads.skipped_payloads(spark, path, payloads.FORECAST_FIELDS)
        assert skipped.count() == 5

    def test_several_files_and_whole_documents(self, spark, tmp_path):
        land(tmp_path / "in", json.dumps(json.loads(columnar("Bend")), indent=2), name="bend.json")
        land(tmp_path / "in", json.dumps(json.loads(columnar("Eugene")), indent=2), name="eugene.json")
        files = [str(tmp_path / "in" / f"{n}.json") for n in ("bend", "eugene")]
        got = payloads.read_forecast(spark, files, multi_line=True)
        assert got.count() == 6
        assert rows(got.where("city = 'Eugene' AND date = '2026-02-03'")) == [
            (day("2026-02-03"), 51.0, 31.0, 0.5, "Eugene")
        ]

    def test_history_renames(self, spark, tmp_path):
        arrays = {
            "time": ["1940-01-01"],
            "temperature_2m_min": [1.0],
            "temperature_2m_max": [2],
            "soil_temperature_0_to_7cm_mean": [None],
            "soil_temperature_7_to_28cm_mean": [4.0],
        }
        path = land(tmp_path / "in", json.dumps({"city": "Bend", "daily": arrays}))
        assert rows(payloads.read_history(spark, path)) == [(day("1940-01-01"), 1.0, 2.0, None, 4.0, "Bend")]

    def test_sun(self, spark, tmp_path):
        record = {
            "date": "2026-01-01",
            "nautical_twilight_begin": "6:40:10 AM",
            "sunrise": "7:50:32 AM",
            "solar_noon": "12:14:20 PM",
            "sunset": "4:38:08 PM",
            "nautical_twilight_end": None,
            "day_length": "8:47:36",
            "golden_hour": "3:50:00 PM",
        }
        path = land(
            tmp_path / "in",
            json.dumps({"city": "Portland", "results": [record]}),
            json.dumps({"city": "Nowhere", "status": "error"}),
            '{"city": "Broken", "results": [{"date"',
        )
        assert rows(payloads.read_sun(spark, path)) == [
            ("Portland", day("2026-01-01"), "06:40:10", "07:50:32", "12:14:20", "16:38:08", None, "8:47:36")
        ]


class TestCounts:
    def test_rows_are_counted_in_the_writing_pass(self, spark, tmp_path):
        root = str(tmp_path / "root")
        some = spark.range(7).withColumn("city", F.lit("Bend"))
        for n, (df, options) in enumerate([(some, {}), (some, {"format": "csv"}), (some, {"sort_by": ("id",)}), (some.where("id > 9"), {}), (some.where(F.lit(False)), {})]):
            version = snapshots.write_version(df, root, f"t{n}", "run", **options)
            assert version.row_count == df.count()
            snapshots.publish(spark, root, [version])
        counts = snapshots.published_counts(spark, root, [f"t{n}" for n in range(5)])
        assert rows(counts) == [("t0", 7), ("t1", 7), ("t2", 7), ("t3", 0), ("t4", 0)]
        assert "FileScan" not in counts._jdf.queryExecution().executedPlan().toString()

    def test_versions_of_older_logs_are_counted(self, spark, tmp_path):
        root = str(tmp_path / "root")
        told = snapshots.write_version(spark.range(3), root, "t", "run")
        snapshots.publish(spark, root, [snapshots.Version(told.table, told.path, told.format, told.schema)])
        assert rows(snapshots.published_counts(spark, root, ["t"])) == [("t", 3)]


class TestByCity:
    SCHEMA = "city STRING, date DATE, n LONG"

    @pytest.fixture
    def table(self, spark):
        days = spark.range(4000).select(
            F.concat(F.lit("c"), F.least(F.col("id") % 60, F.lit(40)).cast("string")).alias("city"),  # c40 is hot
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 60).cast("int")).alias("date"),
            F.col("id").alias("n"),
        )
        return days.union(spark.createDataFrame([(None, None, -1)], "city STRING, date DATE, n LONG"))

    def test_only_folders_of_the_cities_asked_for_are_read(self, spark, table, tmp_path):
        path = str(tmp_path / "t")
        tables.write_by_city(table, path, parts=16)
        one = spark.createDataFrame([("c7",), ("c7",)], "city STRING")
        got = tables.read_cities(spark, path, one, self.SCHEMA, parts=16)
        assert rows(got) == rows(table.where("city = 'c7'")) and got.columns == ["city", "date", "n"]
        text = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*city_part#\d+ = \d+", text)
        read = got.select(F.input_file_name()).distinct().count()
        assert read == 1  # of the folders of 16 hashes
        every = tables.read_cities(spark, path, table.select("city"), self.SCHEMA, parts=16)
        assert rows(every) == rows(table.where("city IS NOT NULL"))
        assert tables.read_cities(spark, path, one.limit(0), self.SCHEMA, parts=16).count() == 0

    def test_a_day_of_a_city_lies_in_one_file(self, spark, table, tmp_path):
        path = str(tmp_path / "t")
        tables.write_by_city(table, path, parts=4)
        places = spark.read.parquet(path).select("city", "date", F.input_file_name().alias("file")).distinct()
        assert places.groupBy("city", "date").count().where("count > 1").count() == 0

    def test_windows_of_some_cities_are_those_of_all(self, spark):
        i = Inputs(spark, "/root/testdata/sf0.001")
        cities = i.stations.where("s_acctbal > 3000").select("city")
        freezes = freeze.average_freeze_dates(freeze.freeze_by_year(i.history), AS_OF)
        every = planting.planting_calendar(climate.daily_data(i.sun, climate.daily_climatology(i.history, AS_OF)), freezes, i.plants)
        some = questions.windows_of_cities(i.history, i.sun, i.plants, cities.union(cities), AS_OF)
        assert rows(some) == rows(every.join(cities, "city", "left_semi")) and not some.isEmpty()


class TestFilterOptions:
    def test_added_plants_unite_with_the_stored_list(self, spark, tmp_path):
        root = str(tmp_path / "root")
        kale = plants(spark, {}, {"common_name": "Chard"})
        stored = [snapshots.write_version(kale, root, "plants", "r"), snapshots.write_version(catalogue.filter_options(spark.createDataFrame([("Bend",)], "city STRING"), kale), root, jobs.FILTER_OPTIONS, "r")]
        snapshots.publish(spark, root, stored)
        jobs.add_plants(spark, root, plants(spark, {"common_name": "Pea", "harvest_type": "Pod"}, {"common_name": "Beet"}))
        assert [tuple(r) for r in jobs.stored_filter_options(spark, root).collect()] == [
            ("city", "Bend"),
            ("growing_season", "Cool Season"),
            ("harvest_type", "Leaf"),
            ("harvest_type", "Pod"),
        ]
        assert snapshots.read_published(spark, root, "plants").count() == 4


class TestCsv:
    def test_columns_are_found_by_name(self, spark, tmp_path):
        path = land(tmp_path / "in", "city,extra,date,precipitation,temp_min,temp_max", "Bend,x,2026-02-02,,30,50.5")
        assert rows(tables.read_weather_csv(spark, path)) == [(day("2026-02-02"), 50.5, 30.0, None, "Bend")]

    def test_inference(self, spark, tmp_path):
        path = land(tmp_path / "in", "date,temp_max,city", "2026-02-02,50.5,Bend")
        got = tables.read_csv(spark, path)
        assert [f.dataType.simpleString() for f in got.schema] == ["date", "double", "string"]

    def test_sun_times_are_checked(self, spark, tmp_path):
        header = "date,morning_twilight,sunrise,solar_noon,sunset,evening_twilight,day_length,city"
        path = land(tmp_path / "in", header, "2026-01-01,6:40:10,07:50:32,12:14:20,16:38:08,,8:47:36,Bend")
        assert rows(tables.read_sun_csv(spark, path), "date", "morning_twilight", "evening_twilight") == [
            (day("2026-01-01"), "06:40:10", None)
        ]

    def test_texts_survive(self, spark, tmp_path):
        texts = [(' say "red", ', 1.5), (None, -0.1), ("🐝 \\ ✓", 1e-7), ("x", None)]
        df = spark.createDataFrame(texts, "name STRING, x DOUBLE")
        tables.write_csv(df, str(tmp_path / "out"))
        assert rows(tables.read_csv(spark, str(tmp_path / "out"), "name STRING, x DOUBLE")) == rows(df)
        assert '" say ""red"", ",1.5' in "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv"))

    def test_export_to_one_file(self, spark, tmp_path):
        df = spark.createDataFrame([("Kale", None), ("Chard, red", 2.5)], "`Plant` STRING, `Sq Ft` DOUBLE").repartition(3)
        tables.write_csv(df, str(tmp_path / "out"), single_file=True)
        (file,) = (tmp_path / "out").glob("*.csv")
        text = file.read_text()
        assert text.splitlines()[0] == "Plant,Sq Ft"
        assert sorted(text.splitlines()[1:]) == ['"Chard, red",2.5', "Kale,"]


class TestSnapshots:
    def test_unpublished_versions_stay_hidden(self, spark, tmp_path):
        root = str(tmp_path / "root")
        with pytest.raises(LookupError):
            snapshots.read_published(spark, root, "t")
        old = snapshots.write_version(spark.range(3), root, "t", "one")
        snapshots.publish(spark, root, [old])
        new = snapshots.write_version(spark.range(5), root, "t", "two")
        assert snapshots.read_published(spark, root, "t").count() == 3
        reader = snapshots.read_published(spark, root, "t")
        snapshots.publish(spark, root, [new])
        assert snapshots.read_published(spark, root, "t").count() == 5
        assert reader.count() == 3  # a reader that began before keeps its version
        with pytest.raises(LookupError):
            snapshots.read_published(spark, root, "other")

    def test_a_table_can_be_rebuilt_from_itself(self, spark, tmp_path):
        root = str(tmp_path / "root")
        snapshots.publish(spark, root, [snapshots.write_version(spark.range(3), root, "t", "one")])
        doubled = snapshots.read_published(spark, root, "t").withColumn("id", F.col("id") * 2)
        snapshots.publish(spark, root, [snapshots.write_version(doubled, root, "t", "two", format="csv")])
        assert rows(snapshots.read_published(spark, root, "t")) == [(0,), (2,), (4,)]

    def test_scratch_is_in_the_shared_folder(self, tmp_path):
        session = FakeSession({"spark.checkpoint.dir": f"{tmp_path}/shared/"}, "spark://host")
        first, second = scratch_dir(session, "x"), scratch_dir(session, "x")
        assert first != second
        assert first.startswith(f"{tmp_path}/shared/scratch-app-1/x-")

    @pytest.mark.parametrize("warehouse", ["s3a://bucket/warehouse", "hdfs://name/warehouse/"])
    def test_scratch_falls_back_to_a_shared_warehouse(self, warehouse):
        session = FakeSession({"spark.sql.warehouse.dir": warehouse}, "yarn")
        assert scratch_root(session) == f"{warehouse.rstrip('/')}/scratch-app-1"

    def test_scratch_refuses_a_folder_that_executors_do_not_share(self):
        local = {"spark.sql.warehouse.dir": "file:/home/user/spark-warehouse"}
        assert scratch_root(FakeSession(local, "local[4]")).startswith("file:/home/user")
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(FakeSession(local, "spark://host"))

    def test_scratch_can_be_dropped(self, spark):
        table = stored(spark.range(3), "x")
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert table.count() == 3
        drop_scratch(spark, path)
        with pytest.raises(AnalysisException):
            spark.read.parquet(path)


    def test_several_tables_are_read_as_of_one_moment(self, spark, tmp_path, monkeypatch):
        root = str(tmp_path / "root")

        def write(run, n):
            return [snapshots.write_version(spark.range(n), root, t, run) for t in ("a", "b")]

        snapshots.publish(spark, root, write("one", 3))
        new, read = write("two", 5), snapshots.Version.read

        def publish_in_between(version, session):
            if new:
                snapshots.publish(spark, root, [new.pop(), new.pop()])
            return read(version, session)

        monkeypatch.setattr(snapshots.Version, "read", publish_in_between)
        found = snapshots.read_all_published(spark, root, ["a", "b"])
        assert {t: df.count() for t, df in found.items()} == {"a": 3, "b": 3}
        assert snapshots.read_published(spark, root, "b").count() == 5
        with pytest.raises(LookupError, match="c"):
            snapshots.read_all_published(spark, root, ["a", "c"])

    def test_the_log_can_be_compacted(self, spark, tmp_path):
        root = str(tmp_path / "root")
        snapshots.compact_log(spark, root)
        for n in range(1, 4):
            snapshots.publish(spark, root, [snapshots.write_version(spark.range(n), root, "t", f"run{n}")])
        snapshots.publish(spark, root, [snapshots.write_version(spark.range(9), root, "u", "run")])
        snapshots.compact_log(spark, root)
        assert len(list((tmp_path / "root" / "_published").glob("part-*.json"))) == 1
        assert {t: df.count() for t, df in snapshots.read_all_published(spark, root, ["t", "u"]).items()} == {"t": 3, "u": 9}
        snapshots.publish(spark, root, [snapshots.write_version(spark.range(4), root, "t", "run4")])
        assert snapshots.read_published(spark, root, "t").count() == 4


class TestCounts:
    def test_rows_are_counted_in_the_writing_pass(self, spark, tmp_path):
        root = str(tmp_path / "root")
        some = spark.range(7).withColumn("city", F.lit("Bend"))
        for n, (df, options) in enumerate([(some, {}), (some, {"format": "csv"}), (some, {"sort_by": ("id",)}), (some.where("id > 9"), {}), (some.where(F.lit(False)), {})]):
            version = snapshots.write_version(df, root, f"t{n}", "run", **options)
            assert version.row_count == df.count()
            snapshots.publish(spark, root, [version])
        counts = snapshots.published_counts(spark, root, [f"t{n}" for n in range(5)])
        assert rows(counts) == [("t0", 7), ("t1", 7), ("t2", 7), ("t3", 0), ("t4", 0)]
        assert "FileScan" not in counts._jdf.queryExecution().executedPlan().toString()

    def test_versions_of_older_logs_are_counted(self, spark, tmp_path):
        root = str(tmp_path / "root")
        told = snapshots.write_version(spark.range(3), root, "t", "run")
        snapshots.publish(spark, root, [snapshots.Version(told.table, told.path, told.format, told.schema)])
        assert rows(snapshots.published_counts(spark, root, ["t"])) == [("t", 3)]


class TestByCity:
    SCHEMA = "city STRING, date DATE, n LONG"

    @pytest.fixture
    def table(self, spark):
        days = spark.range(4000).select(
            F.concat(F.lit("c"), F.least(F.col("id") % 60, F.lit(40)).cast("string")).alias("city"),  # c40 is hot
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 60).cast("int")).alias("date"),
            F.col("id").alias("n"),
        )
        return days.union(spark.createDataFrame([(None, None, -1)], "city STRING, date DATE, n LONG"))

    def test_only_folders_of_the_cities_asked_for_are_read(self, spark, table, tmp_path):
        path = str(tmp_path / "t")
        tables.write_by_city(table, path, parts=16)
        one = spark.createDataFrame([("c7",), ("c7",)], "city STRING")
        got = tables.read_cities(spark, path, one, self.SCHEMA, parts=16)
        assert rows(got) == rows(table.where("city = 'c7'")) and got.columns == ["city", "date", "n"]
        assert len({f.split("/")[-2] for f in spark.read.parquet(path).where("city_part = 3").select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) == 1
        text = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*city_part#\d+ = \d+", text)
        read = got.select(F.input_file_name()).distinct().count()
        assert read == 1  # of the folders of 16 hashes
        every = tables.read_cities(spark, path, table.select("city"), self.SCHEMA, parts=16)
        assert rows(every) == rows(table.where("city IS NOT NULL"))
        assert tables.read_cities(spark, path, one.limit(0), self.SCHEMA, parts=16).count() == 0

    def test_a_day_of_a_city_lies_in_one_file(self, spark, table, tmp_path):
        path = str(tmp_path / "t")
        tables.write_by_city(table, path, parts=4)
        places = spark.read.parquet(path).select("city", "date", F.input_file_name().alias("file")).distinct()
        assert places.groupBy("city", "date").count().where("count > 1").count() == 0

    def test_windows_of_some_cities_are_those_of_all(self, spark):
        i = Inputs(spark, "/root/testdata/sf0.001")
        cities = i.stations.where("s_acctbal > 3000").select("city")
        freezes = freeze.average_freeze_dates(freeze.freeze_by_year(i.history), AS_OF)
        every = planting.planting_calendar(climate.daily_data(i.sun, climate.daily_climatology(i.history, AS_OF)), freezes, i.plants)
        some = questions.windows_of_cities(i.history, i.sun, i.plants, cities.union(cities), AS_OF)
        assert rows(some) == rows(every.join(cities, "city", "left_semi")) and not some.isEmpty()


class TestFilterOptions:
    def test_added_plants_unite_with_the_stored_list(self, spark, tmp_path):
        root = str(tmp_path / "root")
        kale = plants(spark, {}, {"common_name": "Chard"})
        stored = [snapshots.write_version(kale, root, "plants", "r"), snapshots.write_version(catalogue.filter_options(spark.createDataFrame([("Bend",)], "city STRING"), kale), root, jobs.FILTER_OPTIONS, "r")]
        snapshots.publish(spark, root, stored)
        jobs.add_plants(spark, root, plants(spark, {"common_name": "Pea", "harvest_type": "Pod"}, {"common_name": "Beet"}))
        assert [tuple(r) for r in jobs.stored_filter_options(spark, root).collect()] == [
            ("city", "Bend"),
            ("growing_season", "Cool Season"),
            ("harvest_type", "Leaf"),
            ("harvest_type", "Pod"),
        ]
        assert snapshots.read_published(spark, root, "plants").count() == 4


class TestCsv:
    COLUMNS = "date DATE, temp_max DOUBLE, city STRING"

    def files(self, tmp_path, *texts):
        for n, text in enumerate(texts):
            (tmp_path / f"{n}.csv").write_text(text)
        return str(tmp_path)

    def test_headers_in_another_order(self, spark, tmp_path):
        path = self.files(tmp_path, "date,temp_max,city\n2026-01-01,1.5,Bend\n", 'city,date,"temp_max",more\nSalem,2026-01-02,2.5,x\n')
        with pytest.raises(Exception, match="(?i)header"):
            tables.read_csv(spark, path, self.COLUMNS).collect()
        got = tables.read_csv(spark, path, self.COLUMNS, mixed_headers=True)
        assert rows(got) == [(day("2026-01-01"), 1.5, "Bend"), (day("2026-01-02"), 2.5, "Salem")]

    def test_files_that_lack_a_column_are_refused(self, spark, tmp_path):
        path = self.files(tmp_path, "date,temp_max,city\n2026-01-01,1.5,Bend\n", "date,city\n2026-01-02,Salem\n", "date,date,temp_max,city\n", "")
        with pytest.raises(ValueError, match="1.csv lacks temp_max; .*2.csv repeats a name"):
            tables.read_csv(spark, path, self.COLUMNS, mixed_headers=True)

    def test_headers_with_commas_in_names_and_lines_that_look_like_headers(self, spark, tmp_path):
        second = '"city","max, daily",temp_max,date\nBend,1,2.5,2026-01-02\n"city","date","temp_max",x\n'
        path = self.files(tmp_path, "\ufeffdate,temp_max,city\n2026-01-01,1.5,Bend\ndate,temp_max,city\n", second)
        got = tables.read_csv(spark, path, self.COLUMNS, mixed_headers=True).where("date IS NOT NULL")
        assert rows(got) == [(day("2026-01-01"), 1.5, "Bend"), (day("2026-01-02"), 2.5, "Bend")]

    def test_empty_files_have_no_rows(self, spark, tmp_path):
        got = tables.read_csv(spark, self.files(tmp_path, "", ""), self.COLUMNS, mixed_headers=True)
        assert got.count() == 0 and got.columns == ["date", "temp_max", "city"]

    def test_headers_come_from_the_beginnings_of_files_only(self, spark, tmp_path):
        path = self.files(tmp_path, "date,temp_max,city\n" + "2026-01-01,1.5,Bend\n" * 2000, "city,date,temp_max\n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # the first file is cut
        try:
            headers = tables.file_headers(spark, path)
            openings = spark.conf.get("spark.sql.files.openCostInBytes")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(headers.values()) == ["city,date,temp_max", "date,temp_max,city"]
        assert openings != "4k"  # the caller's setting stays

    def test_values_that_cannot_be_read_are_told(self, spark, tmp_path):
        path = self.files(tmp_path, "date,temp_max,city\n2026-01-01,abc,Bend\n2026-01-02,,Bend\nsoon,3,Bend\n")
        assert rows(tables.read_csv(spark, path, self.COLUMNS), "temp_max") == [(3.0,), (None,), (None,)]
        bad = tables.unreadable_rows(spark, path, self.COLUMNS)
        assert rows(bad, "line") == [("2026-01-01,abc,Bend",), ("soon,3,Bend",)]
        assert bad.count() == 2

    def test_line_breaks_in_values(self, spark, tmp_path):
        df = spark.createDataFrame([("a\nb", 1.0), ('say "x", y', 2.0), (None, 3.0)], "text STRING, n DOUBLE")
        with pytest.raises(Exception, match="line break in text"):
            tables.write_csv(df, str(tmp_path / "refused"))
        tables.write_csv(df, str(tmp_path / "kept"), multi_line=True)
        got = tables.read_csv(spark, str(tmp_path / "kept"), "text STRING, n DOUBLE", multi_line=True)
        assert rows(got) == rows(df)


class TestSun:
    def test_bad_records_cost_only_themselves(self, spark, tmp_path):
        good = {field: "6:45:32 AM" for field in payloads.SUN_FIELDS} | {"date": "1/9/2026"}
        lines = [
            json.dumps({"city": "Bend", "results": [good, {**good, "sunrise": "-"}, {**good, "date": "soon"}]}),
            json.dumps({"results": [good]}),
            json.dumps({"city": "Salem"}),
            json.dumps({"city": "Eugene", "results": [good]})[:-5],
        ]
        path = land(tmp_path / "sun", "\n".join(lines))
        got = payloads.read_sun(spark, path)
        assert rows(got, "city", "date", "sunrise") == [("Bend", day("2026-01-09"), "06:45:32"), ("Bend", day("2026-01-09"), None)]
        skipped = payloads.skipped_sun(spark, path)
        assert sorted(r.reason for r in skipped.collect()) == ["malformed", "no date", "no station or records", "no station or records"]


class FakeSession:
    def __init__(self, conf, master):
        self.conf = conf
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")


class TestJobs:
    @pytest.fixture
    def inputs(self, spark):
        raw = weather(spark, *[("Bend", d, 50.0, 40.0, 0.25) for d in days_from("2026-02-02", 14)])
        seen = [
            (day(f"{y}-{m:02d}-{d:02d}"), 20.0 if m in (2, 11) else 50.0, 75.0 + m, 45.0 + 2 * m, 50.0, "Bend")
            for y in (2024, 2025)
            for m in range(1, 13)
            for d in range(1, 29)
        ]
        sun = [("Bend", day(d), *["06:00:00"] * 5, "9:00:00") for d in days_from("2026-01-01", 365)]
        return {
            "raw_weather": raw,
            "history": spark.createDataFrame(seen, schemas.HISTORY),
            "sun": spark.createDataFrame(
                sun,
                "city STRING, date DATE, morning_twilight STRING, sunrise STRING, solar_noon STRING, "
                "sunset STRING, evening_twilight STRING, day_length STRING",
            ),
            "plants": plants(spark, {"min_viable_temp_f": 54.0, "max_viable_temp_f": 82.0}),
        }

    def test_rebuild_refresh_and_audit(self, spark, tmp_path, inputs):
        root = str(tmp_path / "root")
        jobs.full_rebuild(spark, root, **inputs, as_of="2026-02-28")

        def counts():
            return dict(rows(jobs.build_audit(spark, root)))

        built = counts()
        assert built == {
            "six_weeks_weather": 14,
            "irrigation_tracker": 2,
            "sun_times": 365,
            "daily_data": built["daily_data"],
            "avg_freeze_dates": 1,
            "planting_gantt": 1,
            "plants": 1,
        }
        # soil passes 54 in May; highs pass 82 in August, after 60 days to maturity
        assert rows(snapshots.read_published(spark, root, "planting_gantt"), "outdoor_start", "planting_end") == [
            (day("2026-05-01"), day("2026-06-30"))
        ]

        useless = land(tmp_path / "bad", columnar("Bend")[:-5], '{"city": "Bend"}')
        assert jobs.refresh_forecast(spark, root, useless) is False
        assert counts() == built

        good = land(tmp_path / "good", columnar("Eugene", 8), columnar("Cut off")[:-5])
        assert jobs.refresh_forecast(spark, root, good) is True
        assert counts() == {**built, "six_weeks_weather": 8, "irrigation_tracker": 2}
        assert rows(snapshots.read_published(spark, root, "raw_weather").select("city").distinct()) == [("Eugene",)]

    def test_ingests_keep_the_old_table_if_nothing_is_usable(self, spark, tmp_path):
        root = str(tmp_path / "root")
        arrays = {field: [1.0] for field in payloads.HISTORY_FIELDS} | {"time": ["1940-01-01"]}
        sun = {field: "6:00:00 AM" for field in payloads.SUN_FIELDS} | {"date": "2026-01-01"}
        history = land(tmp_path / "history", json.dumps({"city": "Bend", "daily": arrays}))
        suns = land(tmp_path / "sun", json.dumps({"city": "Bend", "results": [sun]}))
        useless = land(tmp_path / "bad", "{")
        assert jobs.ingest_history(spark, root, history) and not jobs.ingest_history(spark, root, useless)
        assert jobs.ingest_sun(spark, root, suns) and not jobs.ingest_sun(spark, root, useless)
        with pytest.raises(LookupError):  # what users read changes at the next rebuild
            snapshots.read_published(spark, root, "temp_soil_historical")
        assert rows(snapshots.read_published(spark, root, jobs.LANDED_HISTORY)) == [
            (day("1940-01-01"), 1.0, 1.0, 1.0, 1.0, "Bend")
        ]
        assert rows(snapshots.read_published(spark, root, jobs.LANDED_SUN), "city", "date", "sunrise", "day_length") == [
            ("Bend", day("2026-01-01"), "06:00:00", "6:00:00 AM")
        ]

    def test_failed_rebuild_publishes_nothing(self, spark, tmp_path, inputs):
        root = str(tmp_path / "root")
        jobs.full_rebuild(spark, root, **inputs, as_of="2026-02-28")
        broken = inputs["plants"].withColumn("min_viable_temp_f", F.raise_error(F.lit("broken")).cast("double"))
        more = inputs["raw_weather"].union(weather(spark, ("Eugene", "2026-02-02", 1.0, 1.0, 1.0)))
        with pytest.raises(Exception, match="broken"):
            jobs.full_rebuild(spark, root, **{**inputs, "raw_weather": more, "plants": broken}, as_of="2026-02-28")
        assert snapshots.read_published(spark, root, "raw_weather").count() == 14


def test_stored_csv_is_compressed(spark, tmp_path):
    rain = weather(spark, *[("Oslo", f"2026-01-{n:02d}", 40.0, 30.0, 0.5) for n in range(1, 29)])
    version = snapshots.write_version(rain, str(tmp_path), "raw_weather", "r1", "csv")
    files = [p.name for p in (tmp_path / "raw_weather/v=r1").glob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    assert rows(version.read(spark)) == rows(rain)


def test_csv_export_is_compressed_and_in_order(spark):
    got = QUERIES["csv_export"](spark, "/root/testdata/sf0.001")
    files = got.inputFiles()
    assert files and all(name.endswith(".csv.gz") for name in files)
    exported = QUERIES["planting_export"](spark, "/root/testdata/sf0.001")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in exported.schema)
    assert exported.count() > 0 and rows(got) == rows(exported)
    keys = [tuple(r) for file in sorted(files) for r in tables.read_csv(spark, file, schema).select(*relational.DISPLAY_ORDER["planting_export"]).collect()]
    assert keys == sorted(keys)
