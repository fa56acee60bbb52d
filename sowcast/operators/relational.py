"""Small relational building blocks used by several datasets."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    Spark limits each key to ``n`` rows before the shuffle (WindowGroupLimit),
    so a key that holds most rows sends at most ``n`` rows per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def keep_selected(df: DataFrame, selection: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose string keys occur in a selection table, however large it is
    and however often it repeats a key."""
    wanted = shuffle_again(selection.select(*keys).distinct(), keys[0])
    return df.join(wanted, list(keys), "left_semi")


def keep_values(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Rows whose column is in a short list; ``None`` keeps everything."""
    return df if values is None else df.where(F.col(column).isin(list(values)))


def keep_where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """AND together those conditions that are given."""
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def shuffle_again(df: DataFrame, key: str) -> DataFrame:
    """The same rows, no longer known to be partitioned by a string key.

    For the small side of a join whose other side may hold most of its rows
    under one key. Spark splits such a key's partition at run time only if both
    sides come straight from a shuffle; an aggregate by the join key does not.
    """
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def select_plants(known: DataFrame, cities: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The pairs (city, common_name) for the few cities and plants that a user picked,
    as far as the cities are known."""
    picked = F.array(*[F.lit(n) for n in names])
    asked = keep_values(known, "city", cities).select("city").distinct()
    return asked.withColumn("common_name", F.explode(picked))


#: How people read each dataset. Jobs that go on to join or write need not sort.
DISPLAY_ORDER = {
    "recent_weeks": ("city", "week_start"),
    "forecast": ("city", "date"),
    "seasonal_conditions": ("city", "date"),
    "plant_catalogue": ("Plant", "Family", "Season", "Type"),
    "weekly_viability": ("city", "common_name"),
    "planting_segments": ("city", "season", "task", "start"),
    "planting_export": ("city", "Plant", "Season", "Type"),
}


def for_display(df: DataFrame, dataset: str) -> DataFrame:
    """The dataset in the order in which it is shown."""
    return df.orderBy(*DISPLAY_ORDER[dataset])


def with_display_place(df: DataFrame, dataset: str) -> DataFrame:
    """The dataset with ``place``, from 1, of each row among its city's in the order in
    which they are shown. Cities are numbered each by itself, so none waits for all."""
    city, *order = DISPLAY_ORDER[dataset]
    return df.withColumn("place", F.row_number().over(Window.partitionBy(city).orderBy(*order)))
