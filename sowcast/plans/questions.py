"""Questions about some cities, answered without computing the others.

The selection meets the observations before anything is aggregated, so what is not
asked for is neither averaged nor shuffled; over tables written by city
(:func:`sowcast.sources.tables.write_by_city`) it is not even read.
"""

from pyspark.sql import DataFrame

from sowcast.functions.calendar import AsOf
from sowcast.operators.climate import daily_climatology, daily_data
from sowcast.operators.freeze import average_freeze_dates, freeze_by_year
from sowcast.operators.planting import planting_calendar
from sowcast.operators.relational import keep_selected


def windows_of_cities(
    history: DataFrame, sun: DataFrame, plants: DataFrame, cities: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Planting windows of the cities that a selection names, however often it names them."""
    own_history, own_sun = (keep_selected(table, cities, ["city"]) for table in (history, sun))
    freezes = average_freeze_dates(freeze_by_year(own_history), as_of)
    daily = daily_data(own_sun, daily_climatology(own_history, as_of))
    return planting_calendar(daily, freezes, plants)
