"""Column expressions against plain Python and numpy."""

import datetime
import re
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sowcast.functions import calendar, clock, labels
from sowcast.functions.rounding import round_half_even, round_half_up


def values(spark, schema, data, *exprs):
    df = spark.createDataFrame([(d,) for d in data], schema)
    return [tuple(r) for r in df.coalesce(1).select(*exprs).collect()]


FIXED = [30.549999999999997, 35.45, 44.15, 50.5, -50.5, 0.5, 1.5, 2.5, -0.5, 0.49999999999999994, 2.675, 1e15, 0.0]


def half_up(x, places):
    scaled = x * 10.0**places
    return float(Decimal(scaled).quantize(Decimal(1), ROUND_HALF_UP)) / 10.0**places


def check_rounding(spark, numbers):
    for places in (0, 1, 2, 3):
        got = values(spark, "x DOUBLE", numbers, round_half_up("x", places), round_half_even("x", places))
        for x, (up, even) in zip(numbers, got, strict=True):
            assert up == half_up(x, places)
            assert even == np.round(np.float64(x), places)


def test_rounding_at_fixed_points(spark):
    check_rounding(spark, FIXED)
    assert values(spark, "x DOUBLE", [30.549999999999997], round_half_up("x", 1)) == [(30.6,)]
    assert values(spark, "x DOUBLE", [None], round_half_up("x", 1), round_half_even("x", 1)) == [(None, None)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-200, 200) | st.integers(-8000, 8000).map(lambda n: n / 40), min_size=1, max_size=200))
def test_rounding_of_any_numbers(spark, numbers):
    check_rounding(spark, numbers)


def test_twelve_hour_times(spark):
    texts = ["6:45:32 AM", "12:05:00 AM", "12:05:00 PM", "4:38:08 PM", "06:45:32 AM", None]
    got = values(spark, "t STRING", texts, clock.from_twelve_hour("t"))
    assert [t for (t,) in got] == ["06:45:32", "00:05:00", "12:05:00", "16:38:08", "06:45:32", None]


def test_clock_texts(spark):
    texts = ["06:58:00", "00:05:00", "12:05:00", "23:59:59", None]
    got = values(spark, "t STRING", texts, clock.decimal_hours("t"), clock.clock_label("t"))
    assert [h for h, _ in got] == [6 + 58 / 60, 5 / 60, 12 + 5 / 60, 23 + 59 / 60 + 59 / 3600, None]
    assert [label for _, label in got] == ["6:58 AM", "12:05 AM", "12:05 PM", "11:59 PM", "—"]
    assert values(spark, "t STRING", ["6:45:32"], clock.clock_time("t")) == [("06:45:32",)]


@pytest.mark.parametrize("text", ["25:00:00", "-", "6", "", "6:x:00", "noon"])
def test_what_is_no_time_is_null(spark, text):
    columns = [clock.clock_time("t"), clock.from_twelve_hour("t"), clock.decimal_hours("t"), clock.clock_label("t")]
    got = values(spark, "t STRING", [text], *columns)[0]
    assert got[:2] == (None, None) and got[3] == "—"
    assert got[2] == (25.0 if text == "25:00:00" else None)


def test_dates_of_services(spark):
    texts = ["2026-02-28", "2/28/2026", "12/1/2026", "2026-13-01", "-", None]
    got = [d and str(d) for (d,) in values(spark, "t STRING", texts, calendar.service_date("t"))]
    assert got == ["2026-02-28", "2026-02-28", "2026-12-01", None, None, None]


def test_dates_of_services_are_read_by_one_form(spark):
    """Each form is tried on texts that can have it only: what fails takes ten times as long."""
    forms = {"yyyy-MM-dd": ["2/28/2026"], "M/d/yyyy": ["2026-02-28", "-", ""]}
    df = spark.createDataFrame([(t,) for texts in forms.values() for t in texts], "t STRING").select(calendar.service_date("t").alias("d"))
    text = df._jdf.queryExecution().analyzed().toString()
    for form in forms:
        assert re.search(rf"WHEN (NOT )?contains\(t#\d+, /\) THEN try_to_timestamp\(t#\d+, Some\({form}\)", text, re.I), text
    assert [str(r.d) for r in df.collect()] == ["2026-02-28", "2026-02-28", "None", "None"]


def test_weeks_start_on_monday(spark):
    days = [datetime.date(2026, 2, d) for d in (1, 2, 8, 9)]
    got = [w for (w,) in values(spark, "d DATE", days, calendar.week_start("d"))]
    assert got == [datetime.date(2026, 1, 26), *[datetime.date(2026, 2, d) for d in (2, 2, 9)]]


def test_projection_on_a_common_and_a_leap_year(spark):
    days = [datetime.date(2024, 12, 31), datetime.date(2024, 2, 29), datetime.date(2023, 3, 1)]
    got = [d for (d,) in values(spark, "d DATE", days, calendar.project_to_year("d", "2026-05-05"))]
    assert got == [datetime.date(2027, 1, 1), datetime.date(2026, 3, 1), datetime.date(2026, 3, 1)]
    got = [d for (d,) in values(spark, "d DATE", days, calendar.project_to_year("d", "2028-05-05"))]
    assert got == [datetime.date(2028, 12, 31), datetime.date(2028, 2, 29), datetime.date(2028, 2, 29)]


def test_as_of_forms(spark):
    wanted = datetime.date(2026, 2, 28)
    for as_of in ("2026-02-28", wanted, F.lit("2026-02-28"), F.make_date(F.lit(2026), F.lit(2), F.lit(28))):
        assert spark.range(1).select(calendar.as_of_date(as_of)).first()[0] == wanted


def test_as_of_defaults_to_today(spark):
    assert spark.range(1).select(calendar.as_of_date() == F.current_date()).first()[0]


def test_day_texts(spark):
    d = "d"
    got = values(
        spark,
        "d DATE",
        [datetime.date(2026, 2, 8)],
        calendar.short_day(d),
        calendar.month_and_day(d),
        calendar.weekday_name(d),
        calendar.long_day(d),
    )
    assert got == [("Feb 08", "February 08", "Sunday", "February 08, 2026")]


def test_status_flags(spark):
    texts = ["No irrigation needed", "Light irrigation needed", "Irrigation needed", "Unknown"]
    got = [f for (f,) in values(spark, "s STRING", texts, labels.is_irrigation_needed("s"))]
    assert got == [False, True, True, False]


def test_number_labels(spark):
    got = values(
        spark,
        "x DOUBLE",
        [50.5, 51.5, -3.7, 0.01, 0.02, 0.5, None],
        labels.rounded_degrees_label("x"),
        labels.degrees_label("x", "°F"),
        labels.rain_label("x"),
    )
    assert got == [
        ("50°", "50°F", '🌧 50.50"'),
        ("52°", "51°F", '🌧 51.50"'),
        ("-4°", "-3°F", "☁ —"),
        ("0°", "0°F", "☁ —"),
        ("0°", "0°F", '🌧 0.02"'),
        ("0°", "0°F", '🌧 0.50"'),
        (None, "—", "☁ —"),
    ]
