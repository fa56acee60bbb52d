import random
import re

import pytest
from llm_helpers import SF, docs, frame, sf_texts

from sowcast.llm import components, jaccard, queries


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    sets = [(d, shingles(t)) for d, t in texts]
    parent = {i: i for i in range(len(sets))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: (len(s), least[root(i)]) for i, (d, s) in enumerate(sets)}


def report(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_against_brute_force(spark):
    got = report(queries.op6_ngram_jaccard(spark, SF))
    assert got == brute(sf_texts())
    assert any(d != c for d, (_, c) in got.items())


@pytest.mark.parametrize("options", [{}, {"frequent_from": 2, "star_gain": 0.0}, {"at_most_frequent": 1, "star_gain": 2.0, "filter_bits": 1 << 15}])
def test_near_copies_chains_and_shared_passages(spark, options):
    pick = random.Random(5)
    word = lambda: "".join(pick.choices("abcdefgh", k=4))
    base = [word() for _ in range(60)]
    passage = [word() for _ in range(40)]
    texts = [" ".join(base)]
    for _ in range(25):  # copies of copies, some of which have drifted apart
        own = pick.choice(texts).split()
        own[pick.randrange(len(own))] = word()
        texts.append(" ".join(own))
    texts += [" ".join([word() for _ in range(pick.randrange(5, 30))] + passage) for _ in range(30)]
    texts += [" ".join(base).upper().replace(" ", "\n\t"), " ".join(base[:48]), " ".join(base * 3)]
    pick.shuffle(texts)
    assert report(jaccard.link_documents(docs(spark, *texts), **options)) == brute(list(enumerate(texts)))


def test_short_empty_and_repeated(spark):
    texts = ["a b c", "A  b\nc", "a b", "a b c d e", None, "", " ", "a b c", "x " * 50_000, "x " * 40_000, "ä Ä", "Ä ä"]
    table = docs(spark, *texts).withColumnRenamed("lang", "node")
    assert report(jaccard.link_documents(table)) == brute(list(enumerate(texts)))
    kept = jaccard.without_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(kept.toPandas().doc_id) == [0, 2, 3, 4, 5, 6, 7, 8, 10, 11]


def test_ids_that_are_missing_or_repeat(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "u v w x y z"), (None, "p q"), (None, "p q")]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = frame(jaccard.link_documents(table))
    assert sorted(map(str, zip(got.doc_id, got.component_id))) == sorted(
        map(str, [(float("nan"), 4.0), (4.0, 4.0), (4.0, 4.0), (4.0, 4.0), (float("nan"),) * 2, (float("nan"),) * 2])
    )
    kept = jaccard.without_near_copies(table).collect()
    assert sorted(map(str, kept)) == sorted(map(str, [*kept])) and len(kept) == 3


def test_no_documents(spark):
    assert jaccard.link_documents(docs(spark, "a").limit(0)).count() == 0
    assert jaccard.without_near_copies(docs(spark, "a").limit(0)).count() == 0


def test_components(spark):
    pick = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    pick.shuffle(edges)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {**{i: i // 20 * 20 for i in range(60)}, **{j: 100 for j in range(100, 160)}}
