import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import SF, docs, sf_texts

from sowcast.llm import queries
from sowcast.llm import suffix_dedup as s


def brute(texts, length, keep_first=False):
    raws = [(d, (t or "").encode()) for d, t in texts]
    places = defaultdict(list)
    for n, (d, raw) in enumerate(raws):
        for i in range(len(raw) - length + 1):
            places[raw[i : i + length]].append((d, i, n))
    gone = [np.zeros(len(raw), bool) for _, raw in raws]
    for own in places.values():
        if len(own) > 1:
            for _, i, n in sorted(own)[int(keep_first) :]:
                gone[n][i : i + length] = True
    out = {}
    for (d, raw), g in zip(raws, gone):
        spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
        kept = bytes(b for b, x in zip(raw, g) if not x)
        out[d] = (len(raw), int(g.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def report(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_query_against_brute_force(spark):
    got = report(queries.op9_suffix_array_dedup(spark, SF))
    assert got == brute(sf_texts(), 400)
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize(
    "options",
    [{}, {"group": 2, "task_bytes": 300, "filter_bits": 1 << 15}, {"group": 2, "task_bytes": 300, "large_at_most": 3}],
)
def test_passages_copies_and_periods(spark, keep_first, options):
    pick = random.Random(4)
    word = lambda n: "".join(pick.choices("abcdefé ", k=n))
    passages = [word(n) for n in (39, 40, 41, 45, 60, 150)]
    texts = [word(pick.randrange(0, 80)) + p + word(pick.randrange(0, 80)) for p in passages * 6]
    texts += [texts[3], texts[3], texts[7] + texts[9] * 2, "ab" * 200, "x" * 500, "abc" * 90 + word(30), None, "", "é" * 15, word(4000)]
    texts += [texts[-1][:1500] + texts[-1][1501:]]
    pick.shuffle(texts)
    got = report(s.removal_report(docs(spark, *texts), keep_first=keep_first, length=40, k=12, **options))
    assert got == brute(list(enumerate(texts)), 40, keep_first)


@pytest.mark.parametrize("seed", range(5))
def test_earlier_matches_of_chains(seed):
    pick = np.random.default_rng(seed)
    value = pick.integers(0, 6, 200)
    joined = pick.random(200) < 0.7
    joined[0] = False
    later, source = s._earlier_matches(value, joined)
    chain = np.cumsum(~joined)
    for c in np.unique(chain):
        own = value[chain == c]
        least = own == own.min()
        assert later[chain == c].tolist() == (~least).tolist()
        assert source[chain == c].tolist() == (least & (len(own) > 1)).tolist()


def test_hulls_with_equal_hashes_are_compared():
    raw = np.frombuffer(b"a" * 60 + b"b" * 60 + b"a" * 60, np.uint8)
    runs = {"begin": np.array([0, 60, 120]), "end": np.array([60, 120, 180])}
    runs |= {name: np.zeros(3, np.int64) for name in ("anchor", "first", "hull", "count")}
    leader, leaders = s._merged(raw, runs)
    assert leader.tolist() == [0, 1, 0] and leaders.tolist() == [0, 1]


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    pick = random.Random(6)
    long = "".join(pick.choices("abcd", k=30_000))
    texts = [long, "y" + long[12_000:13_000], "z" * 50]
    raws = [t.encode() for t in texts]
    whole = [(p, len(raw)) for raw, p in s._chunks(raws, 40)]
    assert len(whole) == 1
    monkeypatch.setattr(s, "CHUNK", 4096)
    starts = defaultdict(set)
    for raw, places in s._chunks(raws, 40):
        assert len(raw) <= 4096
        for text, first, begin, end in places:
            assert raw[begin:end].tobytes() == raws[text][first : first + end - begin]
            starts[text] |= set(range(first, first + end - begin - 39))
    assert {t: len(v) for t, v in starts.items()} == {t: len(r) - 39 for t, r in enumerate(raws)}
    monkeypatch.undo()
    big = "".join(pick.choices("abcd", k=2_500_000))
    got = report(s.removal_report(docs(spark, big, "q" + big[2_090_000:2_110_000])))
    assert got[0][:3] == (2_500_000, 20_000, 1) and got[1][:3] == (20_001, 20_000, 1)


def test_repeated_and_missing_ids(spark):
    long = "abcdefgh" * 3 + "".join(random.Random(1).choices("xyz", k=100))
    rows = [(None, long), (2, "p" + long), (3, long), (3, long)]
    table = spark.createDataFrame([(*r, "n") for r in rows], "doc_id LONG, text STRING, name STRING")
    options = {"length": 60, "k": 12}
    assert sorted(str(r.n_removed) for r in s.removal_report(table, **options).collect()) == ["124"] * 4
    first = s.removal_report(table, keep_first=True, **options).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in first) == [("2", 0), ("3", 124), ("3", 124), ("None", 124)]
    only = s.removal_report(table.where("doc_id = 3"), keep_first=True, **options).collect()
    assert [r.n_removed for r in only] == [0, 0]
    assert s.removal_report(table.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1500, 4000])
def test_passes_may_cut_different_batches(spark, most):
    # the passes read different columns, so batches of so many bytes end at different rows
    pick = random.Random(most)
    word = lambda n: "".join(pick.choices("abcdef ", k=n))
    texts = [word(pick.randrange(20, 90)) + p for p in (word(200) for _ in range(60)) for _ in range(2)]
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    try:
        for keep_first in (False, True):
            got = report(s.removal_report(docs(spark, *texts).coalesce(1), keep_first=keep_first, length=100, k=12))
            assert got == brute(list(enumerate(texts)), 100, keep_first)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
