"""Document quality without labels: heuristics vote, and a scorer learns from them.

Labellers look at one trait each and vote for good, for poor, or not at all. They
overlap and err. Expectation-maximisation over the votes of all documents estimates
how often each labeller votes what on good and on poor documents, and so how likely
each document is good. A linear scorer over hashed features is then fitted to these
probabilities, so that documents on which no labeller votes are scored as well.

The label model sees how often each pattern of votes occurs, at most 3 to the power of
the number of labellers rows, whatever the corpus. The scorer is fitted on at most
``sample_rows`` documents, those with the smallest hashes of id and text. All texts are
voted on and scored whole. Null text counts as empty, on which no labeller votes.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sowcast.llm.batches import parts
from sowcast.sources.scratch import stored

GOOD, POOR, NONE = 1, 0, -1
#: Bytes as kinds: lower case and non-ASCII, upper case, digits; others stay.
_KINDS = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)


@dataclass
class Traits:
    """What labellers and features look at, from one pass over a text."""

    words: int
    distinct: float
    same_as_last: float
    symbols: float
    capitals: float
    letterless: float
    repeated_lines: float
    lines: int
    word_bytes: float
    vocabulary: set
    shapes: Counter

    @classmethod
    def of(cls, text: str | None) -> "Traits":
        raw = (text or "").encode()
        words = raw.split()
        n = max(1, len(words))
        kinds = raw.translate(_KINDS)
        shapes = Counter(kinds.split())
        size = np.bincount(np.frombuffer(kinds, np.uint8), minlength=128)
        letters = max(1, size[97] + size[65])
        visible = max(1, sum(map(len, words)))
        lines = [x for x in raw.split(b"\n") if x]
        vocabulary = set(words)
        return cls(
            words=len(words),
            distinct=len(vocabulary) / n,
            same_as_last=sum(map(eq, words, words[1:])) / n,
            symbols=(visible - letters - size[48]) / visible,
            capitals=size[65] / letters,
            letterless=sum(c for s, c in shapes.items() if b"a" not in s and b"A" not in s) / n,
            repeated_lines=1 - len(set(lines)) / max(1, len(lines)),
            lines=len(lines),
            word_bytes=visible / n,
            vocabulary=vocabulary,
            shapes=shapes,
        )


def _above(value: float, poor: float, good: float) -> int:
    return POOR if value > poor else GOOD if value < good else NONE


#: Each looks at one trait of texts that are long enough to show it.
LABELLERS = (
    ("symbols", lambda t: _above(t.symbols, 0.08, 0.04) if t.words else NONE),
    ("one_word_again_and_again", lambda t: _above(t.same_as_last, 0.2, 0.05) if t.words >= 10 else NONE),
    ("few_words", lambda t: _above(1 - t.distinct, 0.65, 0.4) if t.words >= 20 else NONE),
    ("capitals", lambda t: _above(t.capitals, 0.3, 0.1) if t.words else NONE),
    ("letterless_words", lambda t: _above(t.letterless, 0.2, 0.05) if t.words >= 5 else NONE),
    ("lines_again", lambda t: _above(t.repeated_lines, 0.3, 0.1) if t.lines >= 4 else NONE),
    ("long_words", lambda t: _above(t.word_bytes, 8.0, 7.0) if t.words >= 10 else NONE),
)


def votes(traits: Traits) -> list[int]:
    return [vote(traits) for _, vote in LABELLERS]


def estimate(patterns: np.ndarray, counts: np.ndarray, poor_share: float = 0.2, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and ``table[labeller, class, vote + 1]``, how often a
    labeller votes so on documents of a class. Labellers start as cautious: mostly
    right about good documents, and seeing a part of the poor ones."""
    n, labellers = patterns.shape
    table = np.empty((labellers, 2, 3))
    table[:, GOOD] = (0.15, 0.05, 0.8)
    table[:, POOR] = (0.15, 0.4, 0.45)
    good, total = 1 - poor_share, max(1, counts.sum())
    for _ in range(rounds):
        p = posterior(patterns, good, table)
        good = float(np.clip((counts * p).sum() / total, 0.01, 0.99))
        for label, share in ((GOOD, counts * p), (POOR, counts * (1 - p))):
            for vote in (NONE, POOR, GOOD):
                seen = ((patterns == vote) * share[:, None]).sum(0)
                table[:, label, vote + 1] = (seen + 1) / (share.sum() + 3)
    return good, table


def posterior(patterns: np.ndarray, good: float, table: np.ndarray) -> np.ndarray:
    """How likely the documents with these votes are good."""
    at = np.arange(patterns.shape[1])
    odds = np.log(good / (1 - good)) + (np.log(table[at, GOOD, patterns + 1]) - np.log(table[at, POOR, patterns + 1])).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def features(traits: Traits, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places and values: shapes of words, words, and rounded traits."""
    shapes: Counter = Counter()
    for shape, count in traits.shapes.items():
        short = bytes(c for c, last in zip(shape, b"\0" + shape) if c != last)
        shapes[b"s " + short] += count
    n = max(1, traits.words)
    names = [*shapes, *traits.vocabulary]
    values = [np.sqrt(c / n) for c in shapes.values()] + [1 / np.sqrt(max(1, len(traits.vocabulary)))] * len(traits.vocabulary)
    for name in ("distinct", "same_as_last", "symbols", "capitals", "letterless", "repeated_lines"):
        names.append(f"t {name} {round(getattr(traits, name) * 10)}".encode())
    names.append(f"t words {traits.words.bit_length()}".encode())
    values += [1.0] * (len(names) - len(values))
    return np.fromiter(map(zlib.crc32, names), np.int64, len(names)) % buckets, np.array(values)


@dataclass
class QualityModel:
    good: float
    table: np.ndarray
    weights: np.ndarray  # hashed features, the bias last

    def judge(self, text: str | None) -> tuple[float, float]:
        """How likely the text is good, by the labellers and by the scorer."""
        traits = Traits.of(text)
        by_votes = posterior(np.array([votes(traits)]), self.good, self.table)[0]
        at, values = features(traits, len(self.weights) - 1)
        logit = self.weights[-1] + (self.weights[at] * values).sum()
        return float(by_votes), float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))


def fit_scorer(rows: np.ndarray, at: np.ndarray, values: np.ndarray, target: np.ndarray, buckets: int, l2: float = 1e-4, steps: int = 150, rate: float = 0.1) -> np.ndarray:
    """Weights, the bias last, of a logistic model for probabilities, by Adam."""
    n = max(1, len(target))
    w, m, v = np.zeros(buckets + 1), np.zeros(buckets + 1), np.zeros(buckets + 1)
    for step in range(1, steps + 1):
        logit = np.bincount(rows, w[at] * values, len(target)) + w[-1]
        error = (1 / (1 + np.exp(-logit)) - target) / n
        gradient = np.append(np.bincount(at, error[rows] * values, buckets), error.sum())
        gradient[:-1] += 2 * l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = 10_000, buckets: int = 1 << 16) -> QualityModel:
    """No labels are read."""
    names = [name for name, _ in LABELLERS]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 2000):
            seen = Counter(tuple(votes(Traits.of(t.as_py()))) for t in batch.column(0))
            columns = [pa.array([p[i] for p in seen], pa.int32()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], names=[*names, "documents"])

    counted = docs.select(text_column).mapInArrow(vote, ", ".join(f"{n} INT" for n in names) + ", documents LONG")
    table = counted.groupBy(*names).agg(F.sum("documents").alias("documents")).orderBy(*names).toArrow()
    patterns = np.stack([table.column(n).to_numpy() for n in names], axis=1).astype(np.int64)
    good, accuracies = estimate(patterns, table.column("documents").to_numpy().astype(float))

    text = F.coalesce(F.col(text_column), F.lit(""))
    chosen = docs.select(text.alias("text"), F.xxhash64(F.col(id_column), text).alias("at")).orderBy("at").limit(sample_rows)
    # at most sample_rows texts, by their hashes
    sample = stored(docs.select(text.alias("text"), F.xxhash64(F.col(id_column), text).alias("at")).join(F.broadcast(chosen.select("at").distinct()), "at", "left_semi"), "sample")

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 500):
            traits = [Traits.of(t.as_py()) for t in batch.column(0)]
            target = posterior(np.array([votes(t) for t in traits]).reshape(-1, len(names)), good, accuracies)
            made = [features(t, buckets) for t in traits]
            arrays = [pa.array(target), pa.array([a for a, _ in made], pa.list_(pa.int64())), pa.array([v for _, v in made], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["target", "places", "amounts"])

    made = sample.select("text", "at").mapInArrow(design, "target DOUBLE, places ARRAY<LONG>, amounts ARRAY<DOUBLE>").toArrow()
    places = made.column("places").combine_chunks()
    rows = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy(zero_copy_only=False).astype(int))
    at, values = places.flatten().to_numpy(), made.column("amounts").combine_chunks().flatten().to_numpy()
    return QualityModel(good, accuracies, fit_scorer(rows, at, values, made.column("target").to_numpy(), buckets))


def score(docs: DataFrame, model: QualityModel, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns), ``weak_label`` and ``score``
    (how likely good by votes and by the scorer) and ``predicted``, 1 for good."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.udf("weak_label DOUBLE, score DOUBLE", useArrow=True)
    def judge(text):
        by_votes, by_scorer = sent.value.judge(text)
        return {"weak_label": by_votes, "score": by_scorer}

    judged = docs.select(F.struct("*").alias("row"), judge(F.col(text_column)).alias("j"))
    return judged.select("row", "j.weak_label", "j.score", (F.col("j.score") >= threshold).cast("int").alias("predicted"))
