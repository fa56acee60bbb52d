"""Rounding to a number of decimal places.

Both functions scale, round to a whole number and scale back, in plain double
arithmetic. ``F.round(x, n)`` and ``F.bround(x, n)`` go through a decimal of the
double's text instead: they disagree at ties (30.549999999999997 becomes 30.5,
not 30.6) and cost a BigDecimal per row.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def round_half_up(x: Column | str, places: int = 0) -> Column:
    """Round with ties away from zero, as SQL ``ROUND`` does on doubles."""
    scaled = _col(x) * float(10**places)
    nearest = F.rint(scaled)
    # rint sends ties to the even neighbour; move only those away from zero
    whole = F.when(F.abs(scaled - nearest) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(nearest)
    return whole / float(10**places) if places else whole


def round_half_even(x: Column | str, places: int = 0) -> Column:
    """Round with ties to the even neighbour, as pandas and numpy do."""
    whole = F.rint(_col(x) * float(10**places))
    return whole / float(10**places) if places else whole
