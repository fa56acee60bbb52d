"""Documents linked by the Jaccard similarity of their word n-grams, exactly.

The documents by n-grams incidence matrix is multiplied by its transpose in blocks
of columns, the n-grams, that joins deal out. Three exact reductions keep it sparse:

- Documents with equal sets are one row of the matrix.
- A row takes part with as many of its n-grams only, the rarest first, as two linked
  rows must share one of (its prefix). The order, the same for all rows, is a hash,
  with n-grams that are frequent behind all others.
- Counts accumulated over the prefix columns, and sizes, bound the whole overlap from
  above; pairs below the bound are discarded, the others counted in full.

What is wanted are components, so rows that are known to be connected need not be
compared. First, each column links its rows to one of them; whatever is in different
components after that is paired within every column. A group of any number of near
copies thus costs about as many pairs as it has rows, and none is lost.

Words are separated by ASCII white space, with A-Z lower-cased. A document of fewer
words than an n-gram has one n-gram of all. Null and wordless documents have none,
and are linked with nothing. N-grams and sets are known by 64-bit hashes: of a
billion different sets, two are taken for one with a chance of about 1 in 40.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sowcast.llm.batches import parts
from sowcast.llm.bitmaps import bitmap_of, in_bitmap
from sowcast.llm.components import connected_components
from sowcast.sources.scratch import stored

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def ngram_hashes(text: str | None, n: int) -> np.ndarray:
    """The document's set, as distinct hashes in rising order."""
    words = (text or "").encode().lower().split()
    if len(words) < n:
        whole = [xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)] if words else []
        return np.array(whole, np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    count = len(words) - n + 1
    hashes = np.zeros(count, np.uint64)
    for i in range(n):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX[1] + word[i : i + count] * _MIX[0]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX[2]
    hashes ^= hashes >> np.uint64(29)
    return _distinct(hashes)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def _prefix_size(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1


def _number(hashes: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _longs(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(a) for a in arrays])
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def frequent_ngrams(docs: DataFrame, n: int, frequent_from: int, at_most: int) -> np.ndarray:
    """N-grams of more than ``frequent_from`` documents, the most frequent ``at_most``.
    All are counted among the quarter with the lowest hashes, where most prefixes lie;
    others count where a batch of documents has several. They only order columns, so
    that these bounds change no result."""
    quarter = 1 << 62

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 2500):
            every = np.concatenate([*[ngram_hashes(t.as_py(), n) for t in batch.column(0)], np.zeros(0, np.uint64)])
            every.sort()
            begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, int)
            times = np.diff(np.append(begin, len(every)))
            found = every[begin]
            some = (found < quarter) | (times > 1)
            yield pa.RecordBatch.from_arrays([pa.array(found[some].view(np.int64)), pa.array(times[some])], names=["ngram", "times"])

    counted = docs.select("text").mapInArrow(count, "ngram LONG, times LONG").groupBy("ngram").agg(F.sum("times").alias("times"))
    often = counted.where(F.col("times") > frequent_from).orderBy(F.desc("times"), "ngram").limit(at_most)
    return np.sort(often.select("ngram").toArrow().column(0).to_numpy().view(np.uint64))


def _rows(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document its set's fingerprint and size, and its prefix."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 2500):
            prints, sizes, prefixes = [], [], []
            for text in batch.column("text"):
                own = ngram_hashes(text.as_py(), n)
                prints.append(_number(own))
                sizes.append(len(own))
                late = sent.value[np.searchsorted(sent.value[:-1], own)] == own if len(sent.value) else np.zeros(len(own), bool)
                prefixes.append(np.concatenate([own[~late], own[late]])[: _prefix_size(len(own), percent) if len(own) else 0])
            arrays = [pa.array(prints, pa.int64()), pa.array(sizes, pa.int32()), _longs(prefixes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *arrays], names=["doc_id", "key", "node", "size", "prefix"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(docs.mapInArrow(reduce, f"doc_id {id_type}, key STRING, node LONG, size INT, prefix ARRAY<LONG>"), "rows")
    sent.unpersist()
    return rows


def _entries(rows: DataFrame, bits: int) -> DataFrame:
    """The prefix columns that several rows have, as (ngram, node) with the node's size
    and smallest id. Most columns have one row and are left out before any shuffle of
    entries, as far as a bitmap of fixed size can tell."""
    times = rows.select(F.explode("prefix").alias("ngram")).groupBy("ngram").count()
    sent = rows.sparkSession.sparkContext.broadcast(bitmap_of(times.where("count > 1"), "ngram", bits))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column("prefix")
            ngrams = prefixes.flatten()
            of = np.repeat(np.arange(len(prefixes)), prefixes.value_lengths().to_numpy())
            some = in_bitmap(sent.value, ngrams.to_numpy())
            take = pa.array(of[some])
            arrays = [ngrams.filter(pa.array(some)), *[batch.column(c).take(take) for c in ("node", "size", "doc_id")]]
            yield pa.RecordBatch.from_arrays(arrays, names=["ngram", "node", "size", "doc_id"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("node", "size", "doc_id", "prefix").mapInArrow(spread, f"ngram LONG, node LONG, size INT, doc_id {id_type}")
    entries = stored(found.groupBy("ngram", "node", "size").agg(F.min("doc_id").alias("doc_id")), "entries")
    sent.unpersist()
    return entries


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def _least_overlap(percent: int) -> Column:
    """Of linked rows with sizes ``size_a`` and ``size_b``."""
    return F.ceil((F.col("size_a") + F.col("size_b")) * percent / F.lit(100 + percent) - F.lit(1e-9))


def _pairs(meetings: DataFrame, percent: int) -> DataFrame:
    """Unordered pairs of rows (node, other) that meet in so many columns that, with
    all columns outside their prefixes, they might overlap enough."""
    swap = F.col("node") > F.col("other")
    sizes = F.least("size", "other_size") * 100 >= F.greatest("size", "other_size") * percent
    # what the columns outside the prefixes can add at most
    rest = F.greatest(*[F.ceil(F.col(s) * percent / 100 - F.lit(1e-9)) - 1 for s in ("size_a", "size_b")])
    return (
        meetings.where(sizes)
        .groupBy(
            F.when(swap, F.col("other")).otherwise(F.col("node")).alias("a"),
            F.when(swap, F.col("node")).otherwise(F.col("other")).alias("b"),
            F.when(swap, F.col("other_size")).otherwise(F.col("size")).alias("size_a"),
            F.when(swap, F.col("size")).otherwise(F.col("other_size")).alias("size_b"),
        )
        .count()
        .where(F.col("count") >= _least_overlap(percent) - rest)
    )


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int, bits: int) -> DataFrame:
    """Those of the pairs that are linked, by their whole sets. The sets are made anew
    from the texts that are in some pair; a bitmap of fixed size spares most others."""
    pairs = stored(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    nodes = pairs.select("a").union(pairs.select("b")).toDF("node").distinct()
    place = F.xxhash64("doc_id", "key").alias("place")
    nodes = stored(nodes.join(classes, "node").select("node", place), "nodes")
    sent = docs.sparkSession.sparkContext.broadcast(bitmap_of(nodes, "place", bits))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 2500):
            wanted = np.flatnonzero(in_bitmap(sent.value, batch.column("place").to_numpy()))
            sets = [ngram_hashes(batch.column("text")[int(r)].as_py(), n) for r in wanted]
            prints = pa.array([_number(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([prints, _longs(sets)], names=["node", "ngrams"])

    # rows that repeat an id and text make a set each
    sets = stored(docs.select("text", place).mapInArrow(make, "node LONG, ngrams ARRAY<LONG>"), "sets")
    sent.unpersist()
    both = pairs.drop("count").join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    enough = F.size(F.array_intersect("set_a", "set_b")) >= _least_overlap(percent)
    return stored(both.where(enough).select("a", "b").distinct(), "links")


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries with their node's component; columns within one component go."""
    own = entries.withColumn("component", F.col("node"))
    if labels is not None:
        own = entries.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = own.groupBy("ngram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return stored(own.join(mixed.select("ngram"), "ngram", "left_semi"), "live")


def link_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n: int = 5,
    percent: int = 80,
    frequent_from: int = 64,
    at_most_frequent: int = 1_000_000,
    star_gain: float = 0.1,
    filter_bits: int = 1 << 27,
) -> DataFrame:
    """Per row of ``docs``: its id, the size of its set, the smallest id of its
    component, and ``node``, the component itself (null without words); ``key`` is
    the text's SHA-256. Rows without an id are linked like others and give no id.

    Rounds of one pair per row and column go on while they merge at least
    ``star_gain`` of the rows that are left; then all pairs that are left follow.
    """
    docs = docs.select(
        F.col(id_column).alias("doc_id"),
        F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256).alias("key"),
        F.col(text_column).alias("text"),
    )
    frequent = frequent_ngrams(docs, n, frequent_from, at_most_frequent)
    rows = _rows(docs, n, percent, frequent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    classes = stored(rows.where("size > 0").groupBy("node").agg(first).select("node", "first.doc_id", "first.key"), "classes")
    live = _labelled(_entries(rows, filter_bits), None)
    links: list[DataFrame] = []
    labels, round_ = None, 0
    while True:
        rank = F.xxhash64("node", F.lit(round_)) if round_ else F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
        other = F.struct(rank.alias("rank"), F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("component").alias("to"))
        pivot = live.groupBy("ngram").agg(F.min(other).alias("p")).select("ngram", "p.*")
        star = live.join(pivot, "ngram").where(F.col("component") != F.col("to"))
        links.append(_linked(_pairs(star, percent), docs, classes, n, percent, filter_bits))
        if links[-1].isEmpty():
            break
        labels = stored(connected_components(_all(links)), "labels")
        before = live.select("component").distinct().count()
        live = _labelled(live.drop("component"), labels)
        after = live.select("component").distinct().count()
        round_ += 1
        if before - after <= star_gain * before:
            break
    other = live.select("ngram", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("component").alias("to"))
    across = live.join(other, "ngram").where(F.col("component") < F.col("to"))
    links.append(_linked(_pairs(across, percent), docs, classes, n, percent, filter_bits))
    if not links[-1].isEmpty():
        labels = stored(connected_components(_all(links)), "labels")
    if labels is None:
        labels = classes.select("node", F.col("node").alias("component")).limit(0)
    member = classes.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = member.join(least, "component").select("node", "component", "component_id")
    wordless = F.col("size") == 0
    return rows.join(found, "node", "left").select(
        F.col("doc_id").alias(id_column),
        F.col("size").cast("long").alias("n_shingles"),
        F.when(wordless, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("component").alias("node"),
        "key",
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row of each component, that with the smallest id, with all its columns;
    rows without words all stay."""

    def named(row_id: Column, key: Column) -> Column:
        return F.concat_ws(":", key, row_id.cast("string"))

    linked = link_documents(docs, id_column, text_column, **options)
    own = named(F.col("id"), F.col("key"))
    linked = linked.select(F.col(id_column).alias("id"), "node", "key")
    first = linked.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("f"))
    stay = first.select("f.*").select(own.alias("name"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), named(F.col(id_column), F.sha2(text, 256)).alias("name"), text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    kept = rows.where("worded").join(stay, "name", "left_semi").dropDuplicates(["name"])
    return kept.select("row.*").union(rows.where("NOT worded").select("row.*"))
