"""Exact duplicates: group by a 128-bit content hash, compare the bytes inside groups.

Texts are equal when they are identical after each run of ASCII white space is
replaced by one space; null counts as empty. Of equal texts the row with the
smallest id stays. Rows without an id stay only where no equal text has one. Rows
that repeat an id and its text share their fate in :func:`copy_groups`;
:func:`without_copies` returns one of them.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sowcast.sources.scratch import stored


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def copy_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """Per row of ``docs``: its id, the id that stays, the group's size, whether the
    row stays, and the SHA-256 of the normalised text. An empty table gives none.

    Texts are grouped by digest and bytes, after copies are merged in each input
    task, so a group of any size costs a row per task. Only ids and digests are
    shuffled to bring the answer back. Digests that different texts share are
    resolved by the texts themselves.
    """
    body = normalised(F.col(text_column))
    rows = docs.select(F.col(id_column).alias("row_id"), digest(body).alias("digest"), body.alias("body"))
    texts = rows.groupBy("digest", "body").agg(
        F.min("row_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    answer = [F.col(c) for c in ("keep_id", "group_size", "text_sha256")]
    by_digest = stored(
        texts.withColumn("text_sha256", F.sha2("body", 256))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n_texts"), *[F.first(c).alias(c) for c in ("keep_id", "group_size", "text_sha256")]),
        "copies",
    )
    clash = by_digest.where("n_texts > 1").select("digest")
    found = (
        rows.drop("body").join(by_digest.where("n_texts = 1"), "digest").select("row_id", *answer)
    )
    if not clash.isEmpty():  # two texts with one digest: join by the texts
        clashing = rows.join(clash, "digest", "left_semi")
        apart = texts.join(clash, "digest", "left_semi").withColumn("text_sha256", F.sha2("body", 256))
        found = found.union(clashing.join(apart, ["digest", "body"]).select("row_id", *answer))
    return found.select(
        F.col("row_id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("row_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, one for each text, with all their columns."""

    def key(row_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", sha, row_id.cast("string"))

    groups = copy_groups(docs, id_column, text_column)
    stay = groups.where("kept").select(key(F.col(id_column), F.col("text_sha256")).alias("key"))
    rows = docs.select(
        F.struct("*").alias("row"),
        key(F.col(id_column), F.sha2(normalised(F.col(text_column)), 256)).alias("key"),
    )
    return rows.join(stay, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
