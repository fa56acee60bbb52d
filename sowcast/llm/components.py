"""Connected components of a graph whose edges do not fit into one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.sources.scratch import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, of edges ``a``, ``b``.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until every node
    points to the smallest one. Smallest neighbours are found by partial aggregation,
    so a hub costs a row per task; each round is a table, which cuts the lineage.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.union(least.select("u", "m")).distinct(), "edges")
        if (now := _state(edges)) == state:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        state = now
