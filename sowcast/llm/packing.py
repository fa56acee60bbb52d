"""Documents packed into token sequences by hierarchical best fit.

Documents become token ids with an end id; longer ones than a sequence are cut, so
that all pieces but the first are full. Tasks pack a bounded number of pieces by
best fit in decreasing order. Sequences without room for the smallest are done; the
others are items for the next round, where half as many tasks or fewer pack what came
from several, until one task holds all that is left or no two of them fit together.

Null text counts as empty and makes one piece, the end id. Rows that repeat an id
are packed each for itself. An empty table gives no pieces.
"""

import base64
import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sowcast.sources.scratch import stored

END_OF_TEXT = "<|endoftext|>"  # its string in a text is the special token


@functools.cache
def _encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str | None, ranks_path: str, pattern: str, tokenizer_path: str | None = None) -> np.ndarray:
    """The ids by the ranks, or by the slower tokenizer of the same vocabulary for texts
    on which the pattern fails: it runs out of stack on a million blanks in a row."""
    try:
        return _encoding(ranks_path, pattern).encode_to_numpy(text or "", allowed_special="all")
    except ValueError:
        if tokenizer_path is None:
            raise
        return np.array(_tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int,
    end_id: int,
    id_column: str,
    text_column: str,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """A row per piece: its document, number, place in the document, length and checksum."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_column].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    types = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(token_ids(text.as_py(), ranks_path, pattern, tokenizer_path), end_id).astype("<u4")
                first = len(ids) % capacity or min(len(ids), capacity)
                for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : start + capacity if piece else first]
                    out.append((row, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*out)) or [()] * 5
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            rest = [pa.array(c, types.field(i + 1).type) for i, c in enumerate(columns[1:])]
            yield pa.RecordBatch.from_arrays([ids.cast(types.field(0).type), *rest], names=types.names)

    return docs.select(id_column, text_column).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the fill of each bin: longest items first,
    each into the fullest bin that it fits."""
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            own = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            own, room = len(fills), capacity
            fills.append(0)
        bins[item], offsets[item] = own, fills[own]
        fills[own] += length
        open_bins[room - length].append(own)
        rooms |= 1 << (room - length)
    return bins, offsets, fills


def _pack(items: DataFrame, capacity: int, round_: int, tasks: int) -> DataFrame:
    """The items with ``bin``, ``offset`` and ``fill``; each task packs its own."""
    schema = T.StructType([*items.schema, *[T.StructField(c, T.LongType()) for c in ("bin", "offset", "fill")]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        bins, offsets, fills = best_fit(table.column("length").to_pylist(), capacity)
        first = (round_ << 56) + (TaskContext.get().partitionId() << 28)
        for name, values in (
            ("bin", [first + b for b in bins]),
            ("offset", offsets),
            ("fill", [fills[b] for b in bins]),
        ):
            table = table.append_column(name, pa.array(values, pa.int64()))
        yield from table.to_batches()

    return items.repartition(tasks).mapInArrow(pack, schema)


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    items_per_task: int = 100_000,
    slack: int = 0,
    least_gain: float = 0.0,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """Per piece its sequence and its place there.

    ``tokenizer_path`` names the tokenizer for texts that the pattern of the ranks cannot read.
    ``slack`` is the room up to which a sequence counts as full. Rounds also end when one
    merges fewer than ``least_gain`` of its items; all pieces are packed in any case.
    """
    cut = stored(pieces(docs, ranks_path, pattern, capacity, end_id, id_column, text_column, tokenizer_path), "pieces")
    tasks = max(1, math.ceil(cut.count() / items_per_task))
    packed = stored(_pack(cut, capacity, 0, tasks), "packed")
    # a sequence's first piece, or item, stands for it
    left = packed.where(f"offset = 0 AND fill < {capacity - slack}")
    round_ = 0
    while tasks > 1:
        round_ += 1
        least = [r[0] for r in left.select("fill").orderBy("fill").limit(2).collect()]
        if len(least) < 2 or sum(least) > capacity:  # no two fit together
            break
        items = left.where(F.col("fill") <= capacity - least[0]).select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        before = items.count()
        tasks = max(1, min(math.ceil(before / items_per_task), tasks // 2))
        merged = stored(_pack(items, capacity, round_, tasks), "merged")
        moved = merged.select("item", F.col("bin").alias("into"), F.col("offset").alias("shift"))
        packed = packed.join(moved, packed["bin"] == moved["item"], "left").select(
            *[c for c in packed.columns if c not in ("bin", "offset")],
            F.coalesce("into", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
        left = merged.where(f"offset = 0 AND fill < {capacity - slack}")
        if merged.where("offset = 0").count() > before * (1 - least_gain):
            break
    return packed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )
