"""Times of day, held as ``HH:mm:ss`` strings since Spark has no stored TIME type."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clock_time(t: Column | str) -> Column:
    """Check a 24-hour time and write it as ``HH:mm:ss``; null if it is none."""
    return F.date_format(F.try_to_timestamp(_col(t), F.lit("H:mm:ss")), "HH:mm:ss")


def from_twelve_hour(t: Column | str) -> Column:
    """``6:45:32 AM`` to ``06:45:32``; null if it is no time."""
    return F.date_format(F.try_to_timestamp(_col(t), F.lit("h:mm:ss a")), "HH:mm:ss")


def decimal_hours(t: Column | str) -> Column:
    """``06:30:00`` to 6.5; null if it is no time."""
    part = F.split(_col(t), ":")

    def number(n: int) -> Column:
        return F.get(part, F.lit(n)).try_cast("int")

    return number(0) + number(1) / F.lit(60.0) + number(2) / F.lit(3600.0)


def clock_label(t: Column | str) -> Column:
    """``06:58:00`` to ``6:58 AM``; what is no time becomes a dash."""
    return F.coalesce(F.date_format(F.try_to_timestamp(_col(t), F.lit("HH:mm:ss")), "h:mm a"), F.lit(MISSING))
