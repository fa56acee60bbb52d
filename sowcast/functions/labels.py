"""Statuses and the texts that users see."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sowcast.functions.clock import MISSING

# Statuses, icons and texts that results are compared by.
NO_IRRIGATION = "No irrigation needed"
LIGHT_IRRIGATION = "Light irrigation needed"
IRRIGATION = "Irrigation needed"
UNKNOWN = "Unknown"
BEE, BUTTERFLY, HUMMINGBIRD = "🐝", "🦋", "🌺"
RAIN, CLOUD = "🌧", "☁"
CHECK, CROSS = "✓", "✗"
FREEZE_CAPTION = " · All-time historical avg"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def irrigation_status(rain: Column | str, needed: Column | float, light: float) -> Column:
    """Three classes: enough rain, at least ``light``, or less."""
    rain = _col(rain)
    return (
        F.when(rain >= needed, NO_IRRIGATION).when(rain >= light, LIGHT_IRRIGATION).otherwise(IRRIGATION)
    )


def rain_only_status(rain: Column | str, enough: float) -> Column:
    """Two classes, for stations without a tracker; missing rain counts as too little."""
    return F.when(_col(rain) >= enough, NO_IRRIGATION).otherwise(IRRIGATION)


def is_irrigation_needed(status: Column | str) -> Column:
    """Whether a status text asks for water: it says "needed" and nowhere "no"."""
    text = F.lower(_col(status))
    return text.contains("needed") & ~text.contains("no")


def irrigation_flag(status: Column | str) -> Column:
    return F.when(is_irrigation_needed(status), "Needed").otherwise(f"OK {CHECK}")


def sow_label(direct: str, indoor_suffix: str) -> Column:
    """Direct sowing, or the number of weeks indoors followed by a suffix."""
    weeks = F.col("weeks_indoor_before_transplant").cast("string")
    return F.when(F.col("direct_sow"), direct).otherwise(F.concat(weeks, F.lit(indoor_suffix)))


def pollinator_icons(separator: str = "") -> Column:
    """Icons of the pollinators a plant attracts, empty if none."""
    return F.concat_ws(
        separator,
        F.when(F.col("attracts_bees"), BEE),
        F.when(F.col("attracts_butterflies"), BUTTERFLY),
        F.when(F.col("attracts_hummingbirds"), HUMMINGBIRD),
    )


def degrees_label(temp: Column | str, unit: str = "°") -> Column:
    """The whole degrees of a temperature, truncated; null becomes a dash."""
    return F.coalesce(F.concat(_col(temp).cast("int").cast("string"), F.lit(unit)), F.lit(MISSING))


def rounded_degrees_label(temp: Column | str) -> Column:
    """The nearest whole degree, ties to even."""
    return F.concat(F.rint(_col(temp)).cast("int").cast("string"), F.lit("°"))


def rain_label(rain: Column | str) -> Column:
    """Inches of rain to two places, or a cloud when there is next to none."""
    rain = _col(rain)
    return F.when(rain > 0.01, F.format_string(f'{RAIN} %.2f"', rain)).otherwise(f"{CLOUD} {MISSING}")


def viability_label(days: Column | str, of_days: int, good: Column) -> Column:
    score = F.concat(_col(days).cast("string"), F.lit(f"/{of_days} "))
    return F.concat(score, F.when(good, CHECK).otherwise(CROSS))


def freeze_caption(city: Column | str) -> Column:
    return F.concat(_col(city), F.lit(FREEZE_CAPTION))
