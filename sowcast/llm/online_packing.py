"""Documents packed online into token sequences by the sum-of-squares rule.

Documents become token ids with an end id and are placed one after the other as they
come. A level array counts the open windows of each fill; a document goes into a window
of the fill (or a new one) that makes the sum of the squared counts smallest, so that
windows of all fills remain and whatever comes next finds one to complete. Of equal
sums the fullest window is taken. Documents longer than a window first fill whole
windows, and their rest is placed.

What is still open at the end is completed by cutting: the emptiest windows' documents
fill the room of the fullest, until one window is left, which is cut into sequences of
powers of two. A sequence is padded to the capacity unless its length is a power of two,
so that no sequence needs padding. Each input partition has a level array and open
windows of its own, and makes at most one such remainder, of ``log2(capacity)``
sequences. Too many open windows (``most_open``, which bounds memory) are completed
before the end, in the same way.

No row leaves its partition. An executor that is lost costs the partitions it was
working on; their windows come out the same again if the rows come in the same order.

Null text counts as empty and makes one piece, the end id. Rows that repeat an id are
packed each for itself. Other columns are not read. An empty table gives no pieces.
"""

import functools
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.llm.batches import parts_by_size

WORDS = 500_000  # of one generation of those kept in memory, of which there are two
TOGETHER = 2000  # new words that are tokenized in one call
PART = 8 << 20  # bytes of texts that are taken at once


class WordTokens:
    """Token ids of texts by a tokenizer that drops blanks between words.

    Where that holds, texts are cut at ASCII blanks, and words that were seen lately are
    not tokenized again; other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        setup = json.loads(self.tokenizer.to_str())
        self.by_word = _drops_blanks(setup)
        self.special = [t["content"].lower() for t in setup["added_tokens"]]
        self.seen: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            got = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(got.ids, "<u4").tobytes()
            begins = np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(got))[::2]
            blanks = np.cumsum([len(w) + 1 for w in some])
            ends = 4 * np.searchsorted(begins, blanks)
            self.seen.update(zip(some, [ids[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist())]))

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of different words, in lower case where that is the same to the tokenizer:
        for ASCII, without special tokens, which it looks for as they are written."""
        for i, word in enumerate(words):
            low = word.lower()
            if low != word and word.isascii() and not any(s in low for s in self.special):
                words[i] = low
        if len(self.seen) > WORDS:
            self.seen, self.before = {}, self.seen
        new = []
        for word in words:
            if word not in self.seen:
                own = self.before.get(word)
                self.seen[word] = own
                if own is None:
                    new.append(word)
        self._learn(new)
        return list(map(self.seen.__getitem__, words))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts together, as unsigned 32-bit numbers, and where each text ends."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            each = [self._ids(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(each), "<u4"), np.cumsum([len(x) // 4 for x in each], dtype=np.int64)
        words = pc.ascii_split_whitespace(texts)
        places = words.flatten().dictionary_encode()
        each = self._known(places.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in each], np.int64)
        begin = np.cumsum(size) - size
        at = places.indices.to_numpy()
        ends = np.cumsum(size[at])
        # for each id its place among those of the different words
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[at] - ends + size[at], size[at])
        text_ends = np.append(0, ends)[np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)]
        return np.frombuffer(b"".join(each), "<u4")[source], text_ends


def _drops_blanks(setup: dict) -> bool:
    """Whether blanks end words and leave no token, and case does not count: of the steps
    before the model, none looks across blanks, one lowers case, and the first that cuts
    keeps only what has no blanks."""
    steps = setup["normalizer"] or {}
    normalizers = steps.get("normalizers", [steps] if steps else [])
    lowers = any(n["type"] == "Lowercase" for n in normalizers)
    cuts = setup["pre_tokenizer"] or {}
    first = cuts.get("pretokenizers", [cuts])[0]
    blanks_alike = all(
        n["type"] in ("NFC", "Lowercase") or (n["type"], n.get("pattern"), n.get("content")) == ("Replace", {"Regex": r"\s+"}, " ")
        for n in normalizers
    )
    alternatives = first.get("pattern", {}).get("Regex", " ").split("|")
    no_blank = all(re.fullmatch(r"'\w+|\[?\\p\{\w\}\]?\+?|\[\^\\s[^\]]*\]\+", a) for a in alternatives)
    plain = not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in setup["added_tokens"])
    return lowers and blanks_alike and plain and first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"] and no_blank


@functools.cache
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


class SumOfSquares:
    """Windows of one partition. ``done`` holds (window, [(document, start, ids), ...]) of
    those that are complete, until they are fetched."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        #: counts[h] windows are filled up to h; those of fill 0 and of full ones are not counted
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.done: list[list] = []

    def add(self, document: int, ids: np.ndarray) -> None:
        first = len(ids) - len(ids) % self.capacity
        for start in range(0, first, self.capacity):
            self.done.append([(document, start, ids[start : start + self.capacity])])
        if first < len(ids):
            self._place(document, first, ids[first:])

    def _place(self, document: int, start: int, ids: np.ndarray) -> None:
        level = self.level_for(len(ids))
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
        else:
            window = []
            self.open += 1
        window.append((document, start, ids))
        if level + len(ids) == self.capacity:
            self.done.append(window)
            self.open -= 1
        else:
            self.windows[level + len(ids)].append(window)
            self.counts[level + len(ids)] += 1
        if self.open > self.most_open:
            self.complete()

    def level_for(self, length: int) -> int:
        """The fill to which this length is added. The sum of squares changes by
        2 counts[after] + 1 - (2 counts[before] - 1), where a full or new window counts nothing."""
        top = self.capacity - length
        change = 2 * self.counts[length : length + top + 1] + 1
        change[top] = 0  # becomes full
        change[1:] -= 2 * self.counts[1 : top + 1] - 1
        change[1:][self.counts[1 : top + 1] == 0] = np.iinfo(np.int64).max  # no such window
        return top - int(np.argmin(change[::-1]))

    def complete(self) -> None:
        """Fill the fullest windows from the emptiest, by cuts; cut what is left into powers of two."""
        rest = [w for level in self.windows for w in level]  # by fill, the emptiest first
        self.windows = [[] for _ in range(self.capacity + 1)]
        self.counts[:] = 0
        self.open = 0
        source: list = []  # pieces that look for a place, the next one last
        emptiest = 0
        while len(rest) > emptiest or source:
            target = rest.pop() if len(rest) > emptiest else []
            room = self.capacity - sum(len(ids) for _, _, ids in target)
            while room:
                if not source:
                    if emptiest == len(rest):
                        break
                    source, emptiest = rest[emptiest][::-1], emptiest + 1
                document, start, ids = source.pop()
                target.append((document, start, ids[:room]))
                if len(ids) > room:
                    source.append((document, start + room, ids[room:]))
                room -= len(target[-1][2])
            if not room:
                self.done.append(target)
            else:
                self._powers_of_two(target, self.capacity - room)

    def _powers_of_two(self, pieces: list, fill: int) -> None:
        pieces = pieces[::-1]
        for bit in reversed(range(fill.bit_length())):
            room = fill & (1 << bit)
            if not room:
                continue
            window = []
            while room:
                document, start, ids = pieces.pop()
                window.append((document, start, ids[:room]))
                if len(ids) > room:
                    pieces.append((document, start + room, ids[room:]))
                room -= len(window[-1][2])
            self.done.append(window)


def pack_online(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_open: int = 4096,
) -> DataFrame:
    """Per piece its document, ``start`` there, ``length`` and checksum, the document's
    ``doc_tokens``, and its sequence and place there."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = ", ".join([f"id {slim.schema['id'].dataType.simpleString()}", *[f"{c} LONG" for c in names[1:]]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = _tokens(tokenizer_path), SumOfSquares(capacity, most_open)
        end = np.array([end_id], "<u4")
        next_id = TaskContext.get().partitionId() << 40
        id_type = None
        for batch in parts_by_size(batches, 1, PART):
            id_type = batch.schema.field(0).type
            ids, ends = tokens.of_texts(batch.column(1))
            begin = 0
            for row, to in zip(batch.column(0).to_pylist(), ends.tolist()):
                own = np.append(ids[begin:to], end)
                packer.add((row, len(own)), own)
                begin = to
            yield from fetch(packer, next_id, id_type)
            next_id += len(packer.done)
            packer.done = []
        packer.complete()
        if id_type is not None:
            yield from fetch(packer, next_id, id_type)

    def fetch(packer: SumOfSquares, first: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        out = []
        for n, window in enumerate(packer.done):
            offset = 0
            for (row, size), start, ids in window:
                out.append((row, start, len(ids), zlib.crc32(ids.tobytes()), size, first + n, offset))
                offset += len(ids)
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names)

    return slim.mapInArrow(pack, schema).withColumnRenamed("id", id_column)
