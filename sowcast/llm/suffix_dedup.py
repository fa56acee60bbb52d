"""Long repeated strings in a corpus, by longest-previous-factor arrays.

A string of ``length`` bytes that starts in two places, in one text or two, is
repeated. Every such string contains the k-mer with the smallest hash among its
k-mers (its anchor), and the places of a repeated string have equal anchors at equal
distances. Starts that share an anchor form a run, and the bytes of their strings the
run's hull. So runs are dealt out by their anchors, and equal strings meet:

1. Anchors that occur once are found by counting and left out, up to what a bitmap of
   fixed size lets through; batches of texts do not matter to that. Runs with equal hulls
   in one batch are merged.
2. A task holds groups of runs with equal anchors and sorts their suffixes, column by
   column from the last byte to the first, with the longest common prefixes of
   neighbours. In suffix order, the previous and next places that lie earlier in the
   corpus give each string's earlier match: its longest previous factor.
3. Groups too large for that are reduced first: equal hulls are merged by aggregation,
   where the earlier match is the first place, and a group with too many different hulls
   is split by halves of its starts, for which more bytes must agree, until it is small
   or all its strings are equal.

So a string is repeated if it has an earlier match or is the earlier match of another.
The earlier match is the text's own or that of a row with a smaller id. Nothing here
is cut or sampled; the bounds only choose the way. Null text is empty. Texts shorter
than ``length`` repeat nothing. Rows that repeat both id and text match each other but
none is earlier, so ``keep_first`` keeps what only they share.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sowcast.llm.bitmaps import bitmap_of, in_bitmap
from sowcast.sources.scratch import stored

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
CHUNK = 1 << 20
#: Partitions of a shuffle beyond which they grow instead; groups inside stay the same.
MOST_PARTITIONS = 50_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of any substring of a chunk, from sums of bytes times powers."""

    powers = _powers(_BASE, CHUNK + 1)
    inverse = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)

    def __init__(self, raw: np.ndarray):
        weighted = (raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted)])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        h ^= h >> np.uint64(29)
        h *= _MIX
        return h ^ (h >> np.uint64(32))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Of every ``width`` consecutive values, from running minima of blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    count = len(values) - width + 1
    return np.minimum(ahead[:count], behind[width - 1 : width - 1 + count])


def _chunks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Bytes of whole texts together, or parts of a long one that overlap, with
    (text, its first byte here, begin, end) of each."""
    parts, places, size = [], [], 0
    for number, raw in enumerate(texts):
        for first in range(0, max(1, len(raw) - length + 1), CHUNK - length):
            part = raw[first : first + CHUNK - 1]
            if len(part) < length:
                continue
            if size + len(part) > CHUNK:
                yield np.frombuffer(b"".join(parts), np.uint8), places
                parts, places, size = [], [], 0
            parts.append(part)
            places.append((number, first, size, size + len(part)))
            size += len(part)
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), places


def _runs(raw: np.ndarray, places: list, length: int, k: int) -> dict[str, np.ndarray]:
    """Runs of starts: where they begin here, how many, their anchor's hash, the first
    start's distance (counted from the largest), the hull's hash and end."""
    width = length - k + 1
    hashes = _Hashes(raw)
    at = np.arange(len(raw) - k + 1)
    kmer = hashes.of(at, at + k)
    # equal hashes: the first; places fit below, as chunks are small
    low = np.uint64((1 << 24) - 1)
    anchor = (_window_minima((kmer & ~low) | at.astype(np.uint64), width) & low).astype(np.int64)
    valid = np.zeros(len(anchor), bool)
    for _, _, begin, end in places:
        valid[begin : end - length + 1] = True
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    for _, _, begin, _ in places:
        change[begin : begin + 1] = True
    begin = np.flatnonzero(change)
    count = np.diff(np.append(begin, len(anchor)))
    begin, count = begin[valid[begin]], count[valid[begin]]
    anchors = anchor[begin]
    end = begin + count - 1 + length
    return {
        "begin": begin,
        "count": count,
        "anchor": kmer[anchors].view(np.int64),
        "first": begin - anchors + width - 1,
        "hull": hashes.of(begin, end),
        "end": end,
    }


def _merged(raw: np.ndarray, runs: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first of the runs with the same hull, for every run; those that are first.
    Hulls with equal hashes are compared."""
    order = np.lexsort((runs["begin"], runs["hull"], runs["first"], runs["anchor"]))
    same = np.ones(len(order), bool)
    for name in ("anchor", "first", "hull", "count"):
        same[1:] &= runs[name][order][1:] == runs[name][order][:-1]
    same[:1] = False
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    leader = np.empty(len(order), np.int64)
    leader[order] = order[head]
    whole, begin, end = raw.tobytes(), runs["begin"].tolist(), runs["end"].tolist()
    for i in np.flatnonzero(leader != np.arange(len(order))).tolist():
        of = leader[i]
        if whole[begin[i] : end[i]] != whole[begin[of] : end[of]]:
            leader[i] = i
    return leader, np.flatnonzero(leader == np.arange(len(order)))


def _name(row_id: Column, text: Column) -> Column:
    """Of a row, by its id and its text."""
    return F.concat_ws(":", F.sha2(text, 256), row_id.cast("string"))


def _anchors_that_recur(docs: DataFrame, length: int, k: int, bits: int, group: int, at_most: int):
    """A bitmap of anchors with two runs or more, the ``at_most`` most frequent anchors
    with more than ``group``, a table of further ones if there are any, and the number
    of runs of the others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, places in _chunks([t.as_py().encode() for t in batch.column(0)], length):
                runs = _runs(raw, places, length, k)
                leader, leaders = _merged(raw, runs)
                # a merged run counts as two, as its copies may be in different batches of other columns
                merged = np.bincount(leader, minlength=len(leader))[leaders] > 1
                found, group, times = np.unique(runs["anchor"][leaders], return_inverse=True, return_counts=True)
                times += np.bincount(group, merged, len(found)).astype(times.dtype)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], names=["anchor", "times"])

    counted = docs.select("text").mapInArrow(count, "anchor LONG, times LONG").groupBy("anchor").agg(F.sum("times").alias("times"))
    recur = stored(counted.where("times > 1"), "anchors")
    bitmap = bitmap_of(recur, "anchor", bits)
    over = recur.where(F.col("times") > group)
    sent = over.orderBy(F.desc("times"), "anchor").limit(at_most).toArrow()
    further = None
    if sent.num_rows == at_most:
        last_times, last = sent.column("times")[-1].as_py(), sent.column("anchor")[-1].as_py()
        after = (F.col("times") < last_times) | ((F.col("times") == last_times) & (F.col("anchor") > last))
        further = over.where(after).select("anchor")
    rest = recur.where(F.col("times") <= group).agg(F.sum("times")).first()[0] or 0
    return bitmap, np.sort(sent.column("anchor").to_numpy()), further, rest


def _previous_smaller(value: np.ndarray, joined: np.ndarray, or_equal: bool = False) -> np.ndarray:
    """For each place the nearest one before, in the same chain of joined places, with
    a smaller value (or an equal one), or -1. Pointer jumping."""
    at = np.where(joined, np.arange(len(value)) - 1, -1)
    while True:
        go = np.flatnonzero((at >= 0) & (value[at] > value if or_equal else value[at] >= value))
        if not len(go):
            return at
        at[go] = at[at[go]]


def _earlier_matches(value: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of chains of equal strings that have an earlier match, by the previous
    and next smaller values; and those without one that are the match of others. Of
    places with equal values, the one before is the match but not earlier."""
    before = _previous_smaller(value, joined, or_equal=True)
    after = len(value) - 1 - _previous_smaller(value[::-1], np.append(joined[1:], False)[::-1])[::-1]
    after[after == len(value)] = -1
    matched = np.zeros(len(value), bool)
    for match in (before, after):
        matched[match[match >= 0]] = True
    tied = before.copy()
    while True:
        go = np.flatnonzero((tied >= 0) & (value[tied] == value))
        if not len(go):
            break
        tied[go] = before[tied[go]]
    later = (tied >= 0) | (after >= 0)
    return later, (matched | (before >= 0)) & ~later


def _factors(raw: np.ndarray, offset: np.ndarray, first: np.ndarray, size: np.ndarray, group: np.ndarray, rank: np.ndarray, length: int):
    """For each run and start: whether its string has an earlier match, by the runs'
    ``rank`` in the corpus, and whether it has none but is that of another. Runs of a
    group are aligned at their anchor; ``first`` is the column of their first byte."""
    n, columns = len(first), int((first + size).max())
    last = first + size - 1
    later = np.zeros((n, columns), bool)
    source = np.zeros((n, columns), bool)
    entering = np.argsort(-last, kind="stable")
    entered = 0
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int32)
    for column in range(columns - 1, -1, -1):
        keep = first[order] <= column
        if not keep.all():  # runs that began after this column leave
            at = np.flatnonzero(keep)
            common = np.minimum.reduceat(common[: at[-1] + 1], np.append(0, at[:-1] + 1)) if len(at) else common[:0]
            order = order[at]
        stop = entered
        while stop < n and last[entering[stop]] == column:
            stop += 1
        new, entered = entering[entered:stop], stop
        # an empty suffix is the smallest; in stable order the old ranks decide ties
        order = np.concatenate([new, order])
        common = np.concatenate([np.zeros(len(new), np.int32), common])
        common[len(new) : len(new) + 1] = 0
        key = (group[order] << 8) | raw[offset[order] + (column - first[order])]
        by = np.argsort(key, kind="stable")
        order, key = order[by], key[by]
        if len(by) < 2:
            common = np.zeros(len(by), np.int32)
            continue
        ends = np.stack([by[:-1] + 1, by[1:] + 1], axis=1)
        lowest = np.minimum.reduceat(np.append(common, 0), np.where(ends[:, :1] < ends, ends, ends[:, :1] + [0, 1]).clip(max=len(by)).ravel())[::2]
        common = np.concatenate([[0], np.where(key[1:] == key[:-1], lowest + 1, 0)]).astype(np.int32)
        joined = common >= length
        if joined.any():
            member = joined.copy()
            member[:-1] |= joined[1:]
            at = np.flatnonzero(member)
            run = order[at]
            later[run, column], source[run, column] = _earlier_matches(rank[run], joined[at])
    return later, source


def _spans(flags: np.ndarray, start: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run, begin and end in the text of each stretch of flagged starts."""
    padded = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    padded[:, 1:-1] = flags
    edge = np.diff(padded, axis=1)
    run, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return run, start[run] + begin - first[run], start[run] + end - 1 - first[run] + length


def _find_in_groups(runs: DataFrame, length: int, tasks: int) -> DataFrame:
    """Spans of the strings with other places among runs of the same ``anchor``. A
    group holds some ``task_bytes``, so a task never holds more than that at once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        names = table.column("name").to_pylist()
        ids = table.column("doc_id").to_pylist()
        anchor, start, first = (table.column(c).to_numpy() for c in ("anchor", "start", "first"))
        hulls = table.column("hull").to_pylist()
        size = np.array([len(h) for h in hulls], np.int64)
        _, group, times = np.unique(anchor, return_inverse=True, return_counts=True)
        take = np.flatnonzero(times[group] > 1)
        if not len(take):
            return
        raw = np.frombuffer(b"".join(hulls[i] for i in take), np.uint8)
        place = [(ids[i] is None, ids[i] or 0, names[i], int(start[i])) for i in take]
        known = {p: r for r, p in enumerate(sorted(set(place)))}
        rank = np.array([known[p] for p in place], np.int64)
        offset = np.cumsum(size[take]) - size[take]
        later, source = _factors(raw, offset, first[take], size[take], group[take].astype(np.int64), rank, length)
        for flags, is_later in ((source, False), (later, True)):
            run, begin, end = _spans(flags, start[take], first[take], length)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[take[r]] for r in run], pa.string()), pa.array(begin), pa.array(end), pa.array([is_later] * len(run), pa.bool_())],
                names=["name", "begin", "end", "later"],
            )

    # partitions follow the bytes, not the session's setting
    dealt = runs.withColumn("task", F.pmod("anchor", F.lit(tasks))).repartition(min(tasks, MOST_PARTITIONS), "task")
    return dealt.groupBy("task").applyInArrow(_whole(find), "name STRING, begin LONG, end LONG, later BOOLEAN")


def _whole(find):
    schema = pa.schema([("name", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("later", pa.bool_())])

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(find(table.to_batches())), schema=schema)

    return run


def _reduce_large(runs: DataFrame, length: int, k: int, group: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans found, and runs in groups of at most ``group``, from large groups."""
    spans, small = [], []
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "name", "start")
    span = 1 << (length - k).bit_length()  # starts per group, up to a power of two
    while not runs.isEmpty():
        runs = stored(runs.withColumn("print", F.md5("hull")).withColumn("place", place), "large")
        hull = ["anchor", "first", "print"]
        hulls = stored(runs.groupBy(*hull).agg(F.count(F.lit(1)).alias("times"), F.min("place").alias("leader")), "hulls")
        copies = runs.drop("hull").join(hulls.where("times > 1"), hull)
        of = [F.col("name"), F.col("start").alias("begin"), (F.col("start") + F.col("count") - 1 + length).alias("end")]
        spans.append(copies.select(*of, (F.col("place") > F.col("leader")).alias("later")))
        leaders = runs.withColumnRenamed("place", "leader").join(hulls.select(*hull, "leader"), [*hull, "leader"], "left_semi")
        leaders = stored(leaders.dropDuplicates([*hull, "leader"]).drop("print", "leader"), "leaders")
        sizes = stored(leaders.groupBy("anchor").count().where("count > 1").withColumnRenamed("count", "hulls"), "sizes")
        small.append(leaders.join(sizes.where(F.col("hulls") <= group), "anchor", "left_semi"))
        half = span // 2
        base = F.floor(F.col("first") / span) * span
        low = (base + F.col("part") * half).cast("long")
        begin = F.greatest("first", "low")
        stop = F.least(F.col("first") + F.col("count"), F.col("low") + half)
        runs = (
            leaders.join(sizes.where(F.col("hulls") > group), "anchor", "left_semi")
            .withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("low", low)
            .withColumn("from", begin)
            .withColumn("left", stop - begin)
            .where("left > 0")
            .withColumn("hull", F.expr(f"substring(hull, int(`from` - first + 1), int(left - 1 + {length}))"))
            # what all strings of this half have in common
            .withColumn("core", F.expr(f"substring(hull, int(low + {half} - 1 - `from` + 1), {length - half + 1})"))
            .select(
                F.xxhash64("anchor", "low", "core").alias("anchor"),
                "doc_id",
                "name",
                (F.col("start") + F.col("from") - F.col("first")).alias("start"),
                F.col("from").alias("first"),
                F.col("left").alias("count"),
                "hull",
            )
        )
        span = half
    return spans, small


def repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 400,
    k: int = 32,
    group: int = 1000,
    task_bytes: int = 8 << 20,
    filter_bits: int = 1 << 27,
    large_at_most: int = 1_000_000,
) -> DataFrame:
    """``name`` of a row, ``begin`` and ``end`` in its bytes of strings of at least
    ``length`` bytes with other places: ``later`` ones have an earlier match, others are
    the earlier match of some. Spans of one row may overlap."""
    if not 0 < k <= length < CHUNK // 2:
        raise ValueError("length must be at least k and small against a chunk")
    text = F.coalesce(F.col(text_column), F.lit(""))
    slim = docs.select(F.col(id_column).alias("doc_id"), _name(F.col(id_column), text).alias("name"), text.alias("text"))
    bitmap, large, further, rest = _anchors_that_recur(slim, length, k, filter_bits, group, large_at_most)
    sent = docs.sparkSession.sparkContext.broadcast((bitmap, large))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "name", "anchor", "start", "first", "count", "hull", "large", "later"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, large = sent.value
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(2)]
            for raw, places in _chunks(texts, length):
                runs = _runs(raw, places, length, k)
                leader, leaders = _merged(raw, runs)
                begins = np.array([p[2] for p in places])
                part = np.searchsorted(begins, runs["begin"], side="right") - 1
                row = np.array([p[0] for p in places])[part]
                start = runs["begin"] - begins[part] + np.array([p[1] for p in places])[part]
                go = leaders[in_bitmap(bitmap, runs["anchor"][leaders])]
                yield out(batch, row[go], runs, start, go, [raw[b:e].tobytes() for b, e in zip(runs["begin"][go], runs["end"][go])], np.isin(runs["anchor"][go], large), [False] * len(go))
                # runs with the same hull in this chunk: their earlier match is the first place
                times = np.bincount(leader, minlength=len(leader))
                copies = np.flatnonzero(times[leader] > 1)
                ids, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                place = [(ids[row[i]] is None, ids[row[i]] or 0, names[row[i]], int(start[i])) for i in copies]
                least: dict[int, tuple] = {}
                for i, p in zip(leader[copies].tolist(), place):
                    least[i] = min(p, least.get(i, p))
                late = [p > least[i] for i, p in zip(leader[copies].tolist(), place)]
                yield out(batch, row[copies], runs, start, copies, [None] * len(copies), None, late)

    def out(batch, row, runs, start, at, hulls, is_large, later) -> pa.RecordBatch:
        take = pa.array(row, pa.int64())
        arrays = [batch.column(0).take(take), batch.column(1).take(take)]
        arrays += [pa.array(x, pa.int64()) for x in (runs["anchor"][at], start[at], runs["first"][at], runs["count"][at])]
        arrays += [pa.array(hulls, pa.binary()), pa.array([False] * len(at) if is_large is None else is_large, pa.bool_()), pa.array(later, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    schema = f"doc_id {id_type}, name STRING, anchor LONG, start LONG, first LONG, count LONG, hull BINARY, large BOOLEAN, later BOOLEAN"
    found = stored(slim.mapInArrow(extract, schema), "runs")
    sent.unpersist()
    merged = found.where("hull IS NULL").select("name", F.col("start").alias("begin"), (F.col("start") + F.col("count") - 1 + length).alias("end"), "later")
    runs = found.where("hull IS NOT NULL")
    if further is not None:
        known = further.withColumn("more", F.lit(True))
        runs = stored(runs.join(known, "anchor", "left").withColumn("large", F.col("large") | F.col("more").isNotNull()).drop("more"), "sized")
    wanted = ["anchor", "doc_id", "name", "start", "first", "count", "hull"]
    spans, small = _reduce_large(runs.where("large").select(*wanted), length, k, group)
    per_run = length + (length - k) // 2
    tasks = max(1, -(-rest * per_run // task_bytes))
    spans += [merged, _find_in_groups(runs.where("NOT large").select(*wanted), length, tasks)]
    if small:
        rest = small[0]
        for more in small[1:]:
            rest = rest.union(more)
        rest = stored(rest, "small")
        spans.append(_find_in_groups(rest, length, max(1, -(-rest.count() * per_run // task_bytes))))
    every = spans[0]
    for more in spans[1:]:
        every = every.union(more)
    return every


def kept_bytes(raw: bytes, spans: list) -> tuple[bytes, int]:
    """The text without the spans, and the number of stretches removed."""
    inside = np.zeros(len(raw) + 1, np.int32)
    np.add.at(inside, [s["begin"] for s in spans], 1)
    np.add.at(inside, [s["end"] for s in spans], -1)
    gone = np.cumsum(inside)[:-1] > 0
    stretches = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), stretches


def _with_spans(docs: DataFrame, id_column: str, text_column: str, keep_first: bool, options: dict) -> DataFrame:
    spans = repeated_spans(docs, id_column, text_column, **options)
    if keep_first:
        spans = spans.where("later")
    # at most a few spans for each anchor of a text
    own = spans.groupBy("name").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    name = _name(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), name.alias("name")).join(own, "name", "left")
    return rows.withColumn("text", F.coalesce(F.col("row")[text_column], F.lit("")))


def removal_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_first: bool = False, **options) -> DataFrame:
    """Per row of ``docs`` its bytes, how many are inside repeated strings, in how many
    stretches, and the SHA-256 of the others. ``keep_first`` spares first places."""

    @F.udf("removed LONG, spans LONG, sha STRING", useArrow=True)
    def cut(text, spans):
        if spans is None:
            return None
        raw = text.encode()
        kept, stretches = kept_bytes(raw, spans)
        return {"removed": len(raw) - len(kept), "spans": stretches, "sha": hashlib.sha256(kept).hexdigest()}

    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = _with_spans(slim, "doc_id", "text", keep_first, options)
    some = F.col("spans").isNotNull()
    rows = rows.withColumn("cut", cut(F.when(some, F.col("text")), F.col("spans")))
    return rows.select(
        F.col("row.doc_id").alias(id_column),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(some, F.col("cut.removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(some, F.col("cut.spans")).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(some, F.col("cut.sha")).otherwise(F.sha2("text", 256)).alias("kept_sha256"),
    )
