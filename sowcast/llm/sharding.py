"""Shards by rendezvous hashing of record keys.

Each shard draws a score from the key and its own number, and the highest score
wins. The draw of a shard does not depend on the others, so a further shard takes
just the records that it wins, and no record moves between the old ones. With
scores ``-weight / ln(u)`` a shard wins in proportion to its weight.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sowcast.sources.scratch import stored


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, of a key. A null key is a key like others."""

    def score(shard: int, weight: float) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        return -F.lit(float(weight)) / F.log((draw + F.lit(0.5)) / F.lit(float(2**53)))

    if not weights or min(weights) <= 0:
        raise ValueError("shards need weights above 0")
    scores = [F.struct(score(i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    return -(F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def shard_records(
    docs: DataFrame,
    weights: Sequence[float],
    grown_weight: float = 1.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    slot_buckets: int = 1024,
) -> DataFrame:
    """Per row its shard, its place there, and its shard after one more is added.

    Places count from 0 without gaps. They follow hash buckets and, inside a bucket,
    the id, so that a shard is numbered by many tasks at once; ``slot_buckets`` bounds
    neither rows nor results. Rows without an id go to one shard, rows that repeat an
    id to that id's shard, each with its own place. An empty table gives no rows.
    """
    key, text = F.col(id_column), F.coalesce(F.col(text_column), F.lit(""))
    placed = stored(
        docs.select(
            key.alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            rendezvous(key, weights).alias("shard"),
            rendezvous(key, [*weights, grown_weight]).alias("grown_shard"),
        ).withColumn("bucket", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(slot_buckets)).cast("int")),
        "shards",
    )
    # at most a row per shard and bucket
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        placed.groupBy("shard", "bucket")
        .count()
        .select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size")
    return placed.join(first, ["shard", "bucket"]).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
        "grown_shard",
    )
