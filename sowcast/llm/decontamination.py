"""Benchmark phrases in training texts, found in an FM-index per shard of documents.

A task gathers documents into shards of bounded size and indexes each: the words
that occur in some phrase are symbols, all others and the ends of documents are
separators. Phrases are sought backwards by ranks in a wavelet tree over the
Burrows-Wheeler transform, all at once; occurrences are located by walking to
sampled suffix positions; their word spans are merged per document. No document is
shuffled. Documents longer than a shard are a shard of their own.

Phrases reach the tasks in blocks of so many at most, cut in Spark from items of any
length. A benchmark of several blocks takes as many passes, each written as a table
before the next block is sent, so driver and tasks hold one block at a time.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters.
A phrase is ``width`` consecutive words of an item, or all words of a shorter one.
Items and documents that are null or have no words match nothing. Items that
repeat an id count once; one without an id has the empty string for it.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sowcast.sources.scratch import stored

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_TO_WORDS = bytes(c if c in _WORD_BYTES else 32 for c in bytes(range(256)).lower())
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # the same in lower-case text
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
SAMPLE_EVERY = 16


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


class Phrases:
    """The distinct phrases of some items, as rows of word numbers from 1."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for i in range(max(1, len(own) - width + 1) if own else 0):
                owners[tuple(own[i : i + width])].add(item_id)
        self.owners = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(x) for x in owners], np.int64)
        self.symbols = np.zeros((len(owners), width), np.int64)
        for row, phrase in enumerate(owners):
            self.symbols[row, : len(phrase)] = phrase

    def number(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter((self.vocabulary.get(w, 0) for w in found), np.int32, len(found))


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, where each separator (0) differs
    from all others, so that comparisons end at the next one. Prefix doubling."""
    n, apart = len(symbols), symbols == 0
    rank = np.where(apart, np.cumsum(apart) - 1, symbols + apart.sum())
    reach = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - reach] = rank[reach:] + 1
        key = rank * (n + symbols.max(initial=0) + 2) + np.where(apart, 0, ahead)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        if new.all() or reach >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        reach *= 2


class _WaveletTree:
    """Ranks in a sequence of symbols; each level holds one bit of every symbol,
    stably sorted by the bits above."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []  # bit, number of zeros, ones before each place
        for bit in reversed(range(max(1, int(top).bit_length()))):
            ones = (symbols >> bit) & 1
            self.levels.append((bit, int(len(ones) - ones.sum()), np.concatenate([[0], np.cumsum(ones)]).astype(np.int32)))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        self.first = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, zeros, ones in self.levels:
            place = np.where((symbol >> bit) & 1, zeros + ones[place], place - ones[place])
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before the place."""
        return self._down(symbol, place) - self.first[symbol]

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(place), np.int64)
        for bit, zeros, ones in self.levels:
            one = ones[place + 1] - ones[place]
            symbol |= one.astype(np.int64) << bit
            place = np.where(one == 1, zeros + ones[place], place - ones[place])
        return symbol, place - self.first[symbol]


class FmIndex:
    """Of symbols 1 to ``top``, with separators 0; the last symbol is one."""

    def __init__(self, symbols: np.ndarray, top: int):
        suffixes = _suffix_order(symbols)
        before = symbols[suffixes - 1]
        self.tree = _WaveletTree(before, top)
        counts = np.bincount(symbols, minlength=top + 1)
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        # the first of a run is sampled too, since no step leads back over a separator
        self.sampled = (suffixes % SAMPLE_EVERY == 0) | (before == 0)
        self.sample = np.where(self.sampled, suffixes, -1)[self.sampled]
        self.sample_row = np.cumsum(self.sampled) - 1
        self.size = len(symbols)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Phrase and position of every occurrence."""
        live = np.arange(len(phrases.lengths))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        for at in reversed(range(phrases.symbols.shape[1])):
            now = phrases.lengths[live] > at  # shorter ones begin later
            symbol = phrases.symbols[live[now], at]
            low[now] = self.smaller[symbol] + self.tree.rank(symbol, low[now])
            high[now] = self.smaller[symbol] + self.tree.rank(symbol, high[now])
            some = low < high
            live, low, high = live[some], low[some], high[some]
        count = high - low
        ahead = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(live, count), self._locate(np.repeat(low, count) + ahead)

    def _locate(self, rows: np.ndarray) -> np.ndarray:
        position = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            known = self.sampled[rows]
            position[left[known]] = self.sample[self.sample_row[rows[known]]] + steps
            left, rows = left[~known], rows[~known]
            symbol, rank = self.tree.at(rows)
            rows, steps = self.smaller[symbol] + rank, steps + 1
        return position


def _occurrences(numbered: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, phrase and first word of every occurrence in a shard."""
    starts = np.cumsum([0] + [len(x) + 1 for x in numbered])
    shard = np.zeros(starts[-1], np.int32)
    for start, own in zip(starts, numbered):
        shard[start : start + len(own)] = own
    edge = np.diff(np.concatenate([[False], shard != 0, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # shorter runs of phrase words hold no phrase; each run keeps the separator behind it
    long = end - begin >= phrases.lengths.min(initial=1)
    begin, size = begin[long], (end - begin)[long] + 1
    if not len(begin) or not len(phrases.lengths):
        return (np.zeros(0, np.int64),) * 3
    place = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
    phrase, position = FmIndex(shard[place].astype(np.int64), len(phrases.vocabulary)).search(phrases)
    first = place[position]
    doc = np.searchsorted(starts, first, side="right") - 1
    return doc, phrase, first - starts[doc]


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"first": first, "end": end})
    return out


def _search_shards(batches: Iterator[pa.RecordBatch], phrases: Phrases, keep: list[str], cut: bool, shard_words: int):
    """Each batch again, with the spans and items found so far and in this pass, and
    without the spans in its texts if they are to be cut."""
    schema = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
    )
    types = to_arrow_schema(schema)

    def of_shard(numbered: list[np.ndarray]) -> list[tuple[list, set]]:
        found: list[tuple[list, set]] = [([], set()) for _ in numbered]
        for doc, phrase, first in zip(*(x.tolist() for x in _occurrences(numbered, phrases))):
            found[doc][0].append((first, first + int(phrases.lengths[phrase])))
            found[doc][1].update(phrases.owners[phrase])
        return found

    for batch in batches:
        found, shard, n_words, size = [], [], [], 0
        for text in batch.column("text"):
            own = phrases.number(text.as_py())
            if size and size + len(own) > shard_words:
                found += of_shard(shard)
                shard, size = [], 0
            shard.append(own)
            n_words.append(len(own))
            size += len(own)
        found += of_shard(shard)
        before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
        spans, items = [], []
        for (new_spans, new_items), (old_spans, old_items) in zip(found, before):
            spans.append(_merged(new_spans + [(s["first"], s["end"]) for s in old_spans]))
            items.append(sorted(new_items | set(old_items)))
        arrays = [pa.array(x, types.field(i).type) for i, x in enumerate((n_words, spans, items))]
        kept = [batch.column(c) for c in keep]
        if cut:
            texts = zip(batch.column("text"), spans)
            left = [cut_words(t.as_py(), own) if own else t.as_py() for t, own in texts]
            kept[keep.index("text")] = pa.array(left, batch.column("text").type)
        yield pa.RecordBatch.from_arrays(kept + arrays, names=[*keep, *types.names])


def _item_parts(benchmark: DataFrame, item_column: str, text_column: str, width: int, part_words: int) -> DataFrame:
    """The distinct parts of the items, each of at most ``part_words`` phrases, with
    their number; parts share words, so that every phrase lies in one."""
    lower = F.translate(F.coalesce(F.col(text_column), F.lit("")), _UPPER, _LOWER)
    item = F.coalesce(F.col(item_column).cast("string"), F.lit(""))
    phrases = F.greatest(F.size("words") - (width - 1), F.lit(1))
    return (
        benchmark.select(item.alias("item"), F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0)).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("first", F.explode(F.sequence(F.lit(0), phrases - 1, F.lit(part_words))))
        .select("item", F.array_join(F.slice("words", F.col("first") + 1, part_words + width - 1), " ").alias("text"))
        .distinct()
        .withColumn("phrases", F.greatest(F.size(F.split("text", " ")) - (width - 1), F.lit(1)))
    )


def find_phrases(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 10,
    cut: bool = False,
    block_phrases: int = 1 << 19,
    part_words: int = 1 << 12,
    shard_words: int = 1 << 20,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (its columns but the text), ``n_words``, ``spans``
    (merged, in words, end excluded) and ``items`` (ids with occurring phrases, as
    strings). With ``cut``, also ``text``, without the spans.

    Phrases travel to every task in blocks of about ``block_phrases``; a larger benchmark
    takes several passes over the documents, each stored.
    """
    parts = stored(_item_parts(benchmark, item_column, item_text_column, width, part_words), "parts")
    total = parts.agg(F.sum("phrases")).first()[0] or 0
    blocks = max(1, -(-total // block_phrases))
    context = docs.sparkSession.sparkContext
    found = docs.select(
        F.struct(*[c for c in docs.columns if c != text_column]).alias("row"),
        F.col(text_column).alias("text"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in range(blocks):
        own = parts.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).select("item", "text")
        sent = context.broadcast(Phrases([tuple(r) for r in own.collect()], width))
        last = block + 1 == blocks
        keep = ["row", "text"] if cut or not last else ["row"]
        schema = T.StructType(
            [found.schema[c] for c in keep]
            + [T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
        )

        def search(batches, sent=sent, keep=keep, now=cut and last):
            return _search_shards(batches, sent.value, keep, now, shard_words)

        found = found.drop("n_words").mapInArrow(search, schema)
        if not last:
            found = stored(found, "searched")
            sent.unpersist()
    return found


def overlap_report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: its words, how many are inside phrases, and the items."""
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    narrow = find_phrases(slim, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["end"] - s["first"])
    return narrow.select(
        F.col("row.doc_id").alias(id_column),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        "spans",
    )


def cut_words(text: str, spans: list) -> str:
    """The text without these word spans, each from its first word to its last."""
    raw = text.encode()
    edge = np.diff(np.concatenate([[0], np.frombuffer(raw.translate(_TO_WORDS), np.uint8) != 32, [0]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for span in spans:
        out.append(raw[at : begin[span["first"]]])
        at = end[span["end"] - 1]
    return b"".join([*out, raw[at:]]).decode()


def without_phrases(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", length_column: str | None = None, **options
) -> DataFrame:
    """All rows of ``docs`` with the phrases cut from their texts; rows that had
    words and have none left go. Spans are judged on the text as it came.
    ``length_column`` holds the text's characters and follows the cuts."""

    found = find_phrases(docs, benchmark, text_column=text_column, cut=True, **options)
    hit = F.size("spans") > 0
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["end"] - s["first"]) == F.col("n_words")
    new = F.char_length("text").cast(docs.schema[length_column].dataType) if length_column else None
    columns = [
        F.col("text")
        if c == text_column
        else F.when(hit, new).otherwise(F.col("row")[c])
        if c == length_column
        else F.col("row")[c]
        for c in docs.columns
    ]
    return found.where(~(hit & whole)).select(*[column.alias(c) for c, column in zip(docs.columns, columns)])
