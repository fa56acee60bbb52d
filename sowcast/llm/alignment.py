"""Tokens of two tokenizers aligned byte by byte.

A byte-level BPE of ``tokenizers`` (A) reads a text with a space before it, a
``sentencepiece`` model (B) adds that space itself. The places at which tokens of both
end cut a text into groups, the smallest stretches that both cover with whole tokens.
A token of A and one of B that end together are linked.

1. Spans start coarse: A's character offsets, and the byte spans of B's protos. Where a
   character is shared by several tokens (parts of multibyte characters, byte fallback,
   trimmed blanks), the tokens' decoded bytes place the ends between the coarse cuts.
2. Both tokenizers start anew at a space after something that is not blank, so texts are
   aligned in segments that begin there, and a segment that was seen lately is not
   tokenized again. Vocabularies for which that does not hold get whole texts.
3. Linked tokens end together, so the bytes of one end the other. Such pairs can be
   listed from the vocabularies alone, some hundred thousand, whatever the corpus; so
   counts of all links are one array that every task gets.

A text has no tokens, and zeros for results, if it is null or empty, or if the joined
bytes of A's or B's tokens are not those of a space and the text. Special tokens are
plain text. Each row counts for itself, those that repeat an id too. Other columns are
not read. An empty table gives no rows.
"""

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.llm.batches import parts
from sowcast.sources.scratch import stored

#: begins a segment, together with the space: what is before is not blank, nor all that follows
_CUT = re.compile(r"(?<=\S) (?=\s*\S)")
SEGMENTS = 260_000  # of one generation of those kept in memory, of which there are two
TOGETHER = 300  # new segments that are tokenized in one call
ROWS = 500  # of a batch that are held as Python strings at once


#: what a text takes over from one of its segments: the numbers of its linked pairs, as
#: int32, its groups as in the digest, and its numbers of tokens of A and B
Segment = tuple[bytes, bytes, int, int]


def _byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones stand
    for themselves, the others follow each other from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Aligner:
    """Both tokenizers, with the bytes of their tokens and all pairs that can be linked."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            if all(c in alphabet for c in token):
                self.a_bytes[at] = bytes(alphabet[c] for c in token)
        self.b_bytes = []
        for at in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(at)
            if self.b.is_byte(at):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.b_bytes.append(b"" if self.b.is_control(at) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.keys = self._possible_pairs()
        # cuts at spaces change nothing: A splits there before merging, B has no piece across
        setup = json.loads(self.a.to_str())
        splits = setup["pre_tokenizer"] or {}
        self.cuts = (
            setup["normalizer"] is None
            and splits.get("type") == "ByteLevel"
            and splits.get("use_regex", False)
            and not splits["add_prefix_space"]
            and not any(re.search("[^▁]▁", self.b.id_to_piece(at)) for at in range(self.b.get_piece_size()))
        )
        self.seen: dict[str, Segment | None] = {}
        self.before: dict[str, Segment | None] = {}  # the generation before, kept while its members recur

    def _possible_pairs(self) -> np.ndarray:
        """Pairs of which one token's bytes end the other's, as sorted numbers a * size(B) + b."""
        a_ids: dict[bytes, list[int]] = {}
        b_ids: dict[bytes, list[int]] = {}
        for ids, tokens in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)):
            for at, token in enumerate(tokens):
                if token:
                    ids.setdefault(token, []).append(at)
        n = len(self.b_bytes)
        found = set()
        for at, token in enumerate(self.a_bytes):
            for begin in range(len(token)):
                found.update(at * n + b for b in b_ids.get(token[begin:], ()))
        for at, token in enumerate(self.b_bytes):
            for begin in range(len(token)):
                found.update(a * n + at for a in a_ids.get(token[begin:], ()))
        return np.array(sorted(found), np.int64)

    @property
    def b_of_pair(self) -> np.ndarray:
        return self.keys % len(self.b_bytes)

    def a_spans(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids, and where each token ends in the bytes of a space and the text."""
        whole = " " + text
        got = self.a.encode(whole, add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        if b"".join(map(self.a_bytes.__getitem__, got.ids)) != whole.encode():
            return None
        offsets = np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        if not whole.isascii():  # from characters to bytes
            code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            offsets = np.append(0, np.cumsum(width))[offsets]
        return ids, _refined(offsets[:, 0], offsets[:, 1], self.a_size[ids])

    def b_spans(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of B, whose spans do not count the space that it adds."""
        pieces = list(self.b.encode(text, return_type="proto").pieces)
        ids = [p.id for p in pieces]
        if b"".join(map(self.b_bytes.__getitem__, ids)) != (" " + text).encode():
            return None
        ids = np.array(ids, np.int64)
        begin = np.array([p.begin for p in pieces], np.int64) + 1
        end = np.array([p.end for p in pieces], np.int64) + 1
        begin[:1] = 0
        return ids, _refined(begin, end, self.b_size[ids])

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        a, b = self.a_spans(text), self.b_spans(text)
        return None if a is None or b is None else (*a, *b)

    def whole(self, text: str) -> Segment | None:
        """A text, or segment, by itself; None if it has no tokens."""
        found = self.spans(text) if text else None
        return self._segments(found, np.array([len(text.encode()) + 1]))[0] if found else None

    def _segments(self, found: tuple, ends: np.ndarray) -> list[Segment]:
        """What lies between the ``ends``, at which both have ends of tokens."""
        a_ids, a_ends, b_ids, b_ends = found
        a_last = np.flatnonzero(np.isin(a_ends, b_ends, assume_unique=True))
        b_last = np.flatnonzero(np.isin(b_ends, a_ends, assume_unique=True))
        cuts = a_ends[a_last]
        pair = np.searchsorted(self.keys, a_ids[a_last] * len(self.b_bytes) + b_ids[b_last]).astype(np.int32).tobytes()
        # the digest's text: of each group A's ids, then B's, each with what stands behind it
        n_a, n_b = np.append(0, a_last + 1), np.append(0, b_last + 1)
        a_at = np.arange(len(a_ids)) + n_b[np.searchsorted(cuts, a_ends)]
        b_at = np.arange(len(b_ids)) + n_a[np.searchsorted(cuts, b_ends) + 1]
        ids = np.empty(len(a_ids) + len(b_ids), np.int64)
        ids[a_at], ids[b_at] = a_ids, b_ids
        behind = np.zeros(len(ids), np.int8)
        behind[a_at[a_last]], behind[b_at[b_last]] = 1, 2
        written = pc.binary_join_element_wise(pc.cast(pa.array(ids), pa.string()), pa.array([",", "|", ";"]).take(pa.array(behind)), "")
        to = np.frombuffer(written.buffers()[1], np.int32)[: len(ids) + 1]
        raw = written.buffers()[2].to_pybytes()
        groups = np.searchsorted(cuts, ends, "right")
        a_to, b_to = np.searchsorted(a_ends, ends, "right"), np.searchsorted(b_ends, ends, "right")
        text_to = to[a_to + b_to]
        return [
            (pair[4 * g : 4 * h], raw[i : j - 1], a, b)
            for g, h, i, j, a, b in zip(
                *(x.tolist() for x in (np.append(0, groups[:-1]), groups, np.append(0, text_to[:-1]), text_to, np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)))
            )
        ]

    def _learn(self, new: list[str]) -> None:
        """Align segments. Those that end in something that is not blank go together."""
        alone = [s for s in new if s[-1].isspace()]
        together = [s for s in new if not s[-1].isspace()]
        some, spans, size = [], [], 0
        for at in range(0, len(together), TOGETHER):
            own = together[at : at + TOGETHER]
            text = " ".join(own)
            found = self.spans(text)
            if not found:
                alone += own
                continue
            some += own
            spans.append([x + size * (n % 2) for n, x in enumerate(found)])
            size += len(text.encode()) + 1
        if some:
            ends = np.cumsum([len(s.encode()) + 1 for s in some])
            self.seen.update(zip(some, self._segments([np.concatenate(x) for x in zip(*spans)], ends)))
        for s in alone:
            self.seen[s] = self.whole(s)

    def texts(self, texts: list[str | None]) -> list[Segment | None]:
        """Each text aligned; None for those without tokens."""
        if not self.cuts:
            return [self.whole(t) if t else None for t in texts]
        split = [_CUT.split(t) if t else [] for t in texts]
        if len(self.seen) > SEGMENTS:
            self.seen, self.before = {}, self.seen
        new = set().union(*split).difference(self.seen)
        known = new.intersection(self.before)
        self.seen.update((s, self.before[s]) for s in known)
        self._learn(list(new - known))
        out: list[Segment | None] = []
        for text, segments in zip(texts, split):
            own = [self.seen[s] for s in segments]
            if not own:
                out.append(None)
            elif None in own:  # bytes differ somewhere: the whole text decides
                out.append(self.whole(text))
            else:
                links, groups, n_a, n_b = zip(*own)
                out.append((b"".join(links), b";".join(groups), sum(n_a), sum(n_b)))
        return out


def _refined(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where tokens end: at their coarse ends where these hold just the token's bytes
    (but for a blank that was trimmed), else so many decoded bytes after the last such end."""
    decoded = np.cumsum(size)
    span = end - begin
    trimmed = np.ones(len(end), bool)
    trimmed[1:] = begin[1:] == end[:-1] + 1
    sure = (span == size) | ((span + 1 == size) & trimmed)
    sure[1:] &= begin[1:] >= end[:-1]
    sure[:-1] &= end[:-1] <= begin[1:]
    last = np.maximum.accumulate(np.where(sure, np.arange(len(end)), -1))
    shift = np.where(last >= 0, (end - decoded)[last], 0)
    return decoded + shift


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row its id, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, the hash of its
    groups written as ``a1,a2|b1;a3|b2``, and ``links``, the numbers of its linked pairs."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, n_a LONG, n_b LONG, n_groups LONG, groups_sha256 STRING, links ARRAY<INT>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in parts(batches, ROWS):
            found = both.texts(batch.column(1).to_pylist())
            found = [s or (b"", b"", 0, 0) for s in found]
            links = [np.frombuffer(s[0], np.int32) for s in found]
            n = np.array([len(x) for x in links], np.int64)
            offsets = pa.array(np.append(0, np.cumsum(n)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s[2] for s in found], pa.int64()),
                    pa.array([s[3] for s in found], pa.int64()),
                    pa.array(n),
                    pa.array([hashlib.sha256(s[1]).hexdigest() if s[1] else "" for s in found], pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(links))),
                ],
                names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
            )

    return slim.mapInArrow(align, schema)


def link_counts(links: DataFrame, n_pairs: int) -> np.ndarray:
    """How often each pair is linked. ``n_pairs`` bounds what the driver gets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in parts(batches, ROWS):
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_pairs)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])

    found = links.select("links").mapInArrow(count, "pair LONG, n LONG").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(n_pairs, np.int64)
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return counts


def link_report(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs`` its numbers of tokens, groups and links; ``n_best``, links whose
    pair is the most frequent of its B token in the corpus, ties included; ``count_sum``,
    how often the pairs of its links are linked in the corpus; and the groups' hash."""
    both = aligner(a_path, b_path)
    rows = stored(aligned(docs, a_path, b_path, id_column, text_column), "aligned")
    counts = link_counts(rows, len(both.keys))
    most = np.zeros(len(both.b_bytes), np.int64)
    np.maximum.at(most, both.b_of_pair, counts)
    best = counts == most[both.b_of_pair]
    sent = docs.sparkSession.sparkContext.broadcast((counts, best))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in parts(batches, ROWS):
            links = batch.column("links")
            flat = links.flatten().to_numpy()
            ends = np.append(0, np.cumsum(batch.column("n_groups").to_numpy()))
            sums = [np.append(0, np.cumsum(x[flat].astype(np.int64)))[ends] for x in (best, counts)]
            arrays = [*[batch.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_groups")], *[pa.array(np.diff(x)) for x in sums], batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_a LONG, n_b LONG, n_groups LONG, n_links LONG, n_best LONG, count_sum LONG, groups_sha256 STRING"
    return rows.mapInArrow(judge, schema).withColumnRenamed("id", id_column)


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per group, for those who want the alignment itself: the row's id, the group's
    number, its first byte and the one behind its last in a space and the text, and its
    tokens of A and B. Texts without tokens have no rows."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, group LONG, begin LONG, end LONG, a_ids ARRAY<INT>, b_ids ARRAY<INT>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in parts(batches, 1):
            text = batch.column(1)[0].as_py()
            found = both.spans(text) if text else None
            if not found:
                continue
            a_ids, a_ends, b_ids, b_ends = found
            ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(own, ends, "right")), pa.int32()), pa.array(ids, pa.int32()))
                for ids, own in ((a_ids, a_ends), (b_ids, b_ends))
            ]
            ids = batch.column(0).take(pa.array(np.zeros(len(ends), np.int64)))
            number, begin = np.arange(len(ends)), np.append(0, ends[:-1])
            yield pa.RecordBatch.from_arrays([ids, pa.array(number), pa.array(begin), pa.array(ends), *lists], names=["id", "group", "begin", "end", "a_ids", "b_ids"])

    return slim.mapInArrow(align, schema).withColumnRenamed("id", id_column)
