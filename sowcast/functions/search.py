"""Searches in sorted arrays, in as many steps as their size has binary digits."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MOST = 1 << 24  # entries of an array; only bounds how far the widths go


def widths_up_to(size: Column) -> Column:
    """Powers of two up to a size, largest first. Worth a column of its own where many
    searches go over one array."""
    powers = F.array(*[F.lit(1 << n) for n in reversed(range(_MOST.bit_length()))])
    return F.filter(powers, lambda width: width <= size)


def skip_while(widths: Column | str, begin: Column, passes: Callable[[Column, Column], Column]) -> Column:
    """The first place, from ``begin`` on, at which a search stops: it steps over a stretch
    of each width, largest first, of which ``passes(place, width)`` says that it holds
    nothing. A stretch that ends beyond the array must not pass; null does not."""
    return F.aggregate(widths, begin, lambda at, width: at + F.when(passes(at, width), width).otherwise(F.lit(0)))
