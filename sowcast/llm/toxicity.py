"""A toxicity classifier that does not react to which group a sentence mentions.

Logistic regression on the words of a text and their beginnings. The labelled texts
supply counterfactuals: every sentence that names a group, with each other group of
the same kind in its place. Training penalises the squared change of the score
between the two, so that a group's name, however often it stands in toxic labelled
texts, moves no score, and neutral mentions are not taken for toxic.

The classifier is fitted on at most ``sample_rows`` labelled rows, those with the
smallest hashes of their ids; word counts, design and counterfactuals are gathered
by tasks, and only the chosen features' columns reach the driver. Every whole text
is scored. Null text counts as empty. A document that is labelled twice counts as
toxic if one label says so; labels without an id, a label or a document count for
nothing. Without labels of both kinds no text is toxic: all scores are 0.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sowcast.llm.batches import parts
from sowcast.sources.scratch import stored

#: Groups by kind. Fixed values.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "african", "latino", "european", "mexican", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "blind", "deaf", "old", "young"),
)
PREFIXES = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def _features(words: set[str]) -> set[str]:
    """Each word, and marked as such the beginnings of longer words."""
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def swapped(text: str | None, terms=IDENTITY_TERMS) -> Iterator[tuple[set[str], set[str]]]:
    """The words of each sentence that names a group, and of its counterfactuals."""
    kinds = {term: kind for kind in terms for term in kind}
    for sentence in _SENTENCE.split(text or ""):
        words = set(_words(sentence))
        for term in words & kinds.keys():
            for other in kinds[term]:
                if other != term:
                    yield words, (words - {term}) | {other}


@dataclass
class ToxicityModel:
    bias: float = -np.inf
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        if not self.weights and self.bias == -np.inf:
            return 0.0
        words = set(_words(text))
        own = [w for w in words if w in self.weights]
        for n in PREFIXES:
            own += {p for w in words if len(w) > n and (p := w[:n] + "*") in self.weights}
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(sorted(self.weights[f] for f in own)), -60, 60))))


def fit(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, n_features: int, swaps: Counter, swap_weight: float, l2: float = 1e-4, steps: int = 400, rate: float = 0.1) -> np.ndarray:
    """Weights, the bias last, by full-batch Adam. ``rows`` and ``columns`` place the
    ones of the design; ``swaps`` counts pairs of (lost, gained) features."""
    n = len(labels)
    lost_gained = list(swaps)
    at = np.repeat(np.arange(len(lost_gained)), [len(a) + len(b) for a, b in lost_gained]) if lost_gained else np.zeros(0, int)
    of = np.array([f for a, b in lost_gained for f in (*a, *b)], int)
    sign = np.array([s for a, b in lost_gained for s in (*[-1.0] * len(a), *[1.0] * len(b))])
    share = np.array([swaps[k] for k in lost_gained], float)
    share = share / share.sum() if len(share) else share
    balance = np.where(labels == 1, n / max(1, 2 * labels.sum()), n / max(1, 2 * (1 - labels).sum()))
    w, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        logit = np.bincount(rows, w[columns], n) + w[-1]
        error = balance * (1 / (1 + np.exp(-logit)) - labels) / n
        gradient = np.append(np.bincount(columns, error[rows], n_features), error.sum())
        if len(at):
            change = np.bincount(at, sign * w[of], len(share))
            gradient[:-1] += 2 * swap_weight * np.bincount(of, sign * (share * change)[at], n_features)
        gradient[:-1] += 2 * l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = 30_000,
    max_features: int = 4096,
    least_z: float = 2.5,
    swap_weight: float = 10.0,
    terms=IDENTITY_TERMS,
) -> ToxicityModel:
    """Fit on the labelled rows that ``may_learn``, a condition on the labels, admits."""
    own = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"), (F.lit(True) if may_learn is None else may_learn).alias("may"))
    sample = (
        own.where("may AND id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    # at most sample_rows pairs of numbers
    texts = stored(
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        .join(F.broadcast(sample), "id")
        .select("label", "text"),
        "labelled",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 500):
            seen = (Counter(), Counter())
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label].update(_features(set(_words(text))))
            names = list(seen[0].keys() | seen[1].keys())
            arrays = [pa.array(names), *[pa.array([c[f] for f in names], pa.int64()) for c in seen]]
            yield pa.RecordBatch.from_arrays(arrays, names=["feature", "clean", "toxic"])

    totals = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    if len(totals) < 2:
        return ToxicityModel()
    odds = F.log((F.col("toxic") + 0.5) / (totals[1] + 1)) - F.log((F.col("clean") + 0.5) / (totals[0] + 1))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    chosen = (
        texts.mapInArrow(count, "feature STRING, clean LONG, toxic LONG")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("toxic > 1")
        .withColumn("z", odds / spread)
        .where(F.col("z") >= least_z)
        .orderBy(F.desc("z"), "feature")
        .limit(max_features)
    )
    names = [r.feature for r in chosen.select("feature").collect()]
    number = {name: i for i, name in enumerate(names)}
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(words: set[str]) -> set[int]:
            return {sent.value[f] for f in _features(words) if f in sent.value}

        for batch in parts(batches, 500):
            out, swaps = [], Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.append({"label": label, "ones": sorted(numbers(set(_words(text))))})
                for was, now in swapped(text, terms):
                    was, now = numbers(was), numbers(now)
                    if was != now:
                        swaps[tuple(sorted(was - now)), tuple(sorted(now - was))] += 1
            out += [{"label": n, "ones": list(a), "gained": list(b)} for (a, b), n in swaps.items()]
            schema = pa.schema([("label", pa.int64()), ("ones", pa.list_(pa.int32())), ("gained", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    table = texts.mapInArrow(design, "label LONG, ones ARRAY<INT>, gained ARRAY<INT>").toArrow()
    sent.unpersist()
    labels_, ones, swaps = [], [], Counter()
    for label, own_ones, gained in zip(*(table.column(c).to_pylist() for c in table.column_names)):
        if gained is None:
            labels_.append(label)
            ones.append(own_ones)
        else:
            swaps[tuple(own_ones), tuple(gained)] += label
    # rows come in no fixed order; sums do not depend on it after sorting
    order = sorted(range(len(ones)), key=lambda i: (ones[i], labels_[i]))
    rows = np.repeat(np.arange(len(order)), [len(ones[i]) for i in order])
    columns = np.array([f for i in order for f in ones[i]], int)
    swaps = Counter(dict(sorted(swaps.items())))
    w = fit(rows, columns, np.array([labels_[i] for i in order], float), len(names), swaps, swap_weight)
    return ToxicityModel(float(w[-1]), dict(zip(names, w[:-1].tolist())))


def score(docs: DataFrame, model: ToxicityModel, text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns), ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.udf("double", useArrow=True)
    def of(text):
        return sent.value.score(text)

    scored = docs.select(F.struct("*").alias("row"), of(F.col(text_column)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def is_held_out(id_: Column) -> Column:
    """Rows that no label may be learned from; a missing id counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 3 == 1
