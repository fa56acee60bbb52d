import hashlib
import re

import numpy as np
import pytest
from llm_helpers import SF, docs, frame, sf_texts

from sowcast.llm import decontamination as d
from sowcast.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, width=10):
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    lengths = {len(x) for x in windows}
    out = {}
    for doc, text in texts:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


def report(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_query_against_brute_force(spark):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = report(queries.op3_decontamination(spark, SF))
    assert got == brute(sf_texts(), items)
    assert any(v[4] for v in got.values())


@pytest.mark.parametrize("options", [{}, {"block_phrases": 2}, {"shard_words": 3}, {"part_words": 1}])
def test_short_items_repeats_and_nulls(spark, options):
    items = [(1, "a b"), (2, "B, c"), (3, "x"), (None, "a b c d e f g h i j k"), (4, ""), (5, None), (1, "é ü"), (10, "a b")]
    texts = ["a b c a b", "A-B\nx", None, "", "é  Ü a", "a b c d e f g h i j k l", "y " * 5000 + "x", "...", "b c b c"]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    got = report(d.overlap_report(docs(spark, *texts), bench, **options))
    assert got == brute(list(enumerate(texts)), items)


@pytest.mark.parametrize("options", [{"shard_words": 500}, {"block_phrases": 40, "part_words": 7}])
def test_random_texts_and_long_repeats(spark, options):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 200))) for _ in range(40)] + ["a " * 3000] * 3
    items = [(i, " ".join(rng.choice(list("abcd"), rng.integers(1, 14)))) for i in range(30)]
    items += [(30 + i, ", ".join(rng.choice(list("ABc"), 80))) for i in range(3)]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    got = report(d.overlap_report(docs(spark, *texts), bench, **options))
    assert got == brute(list(enumerate(texts)), items)


def test_items_are_cut_into_parts_that_hold_every_phrase_once(spark):
    rng = np.random.default_rng(2)
    items = [(i, "-".join(rng.choice(list("abcdefgh"), n))) for i, n in enumerate((1, 9, 10, 11, 29, 30, 200))] + [(8, None), (9, "."), (6, "z")]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    parts = d._item_parts(bench, "item_id", "text", 10, 20).collect()
    assert max(len(p.text.split()) for p in parts) <= 29
    places = [max(1, len(split(t)) - 9) if split(t) else 0 for _, t in items]
    assert sum(p.phrases for p in parts) == sum(places)
    assert set(map(tuple, d.Phrases([(p.item, p.text) for p in parts], 10).owners)) == {(str(i),) for i in range(7)}


def test_cutting_keeps_clean_rows_and_columns(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id LONG, text STRING")
    table = docs(spark, "Zero, ONE two. three! four é", "one two", None, "one two three", "one two three one, two three five").withColumnRenamed("lang", "spans")
    got = d.without_phrases(table, bench, length_column="n_chars")
    assert got.schema.simpleString() == table.schema.simpleString()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert {r.doc_id: r.text for r in got.collect()} == {0: "Zero, ! four é", 1: "one two", 2: None, 4: " five"}


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one")], "item_id LONG, text STRING")
    assert d.overlap_report(docs(spark, "one").limit(0), bench).count() == 0
    assert frame(d.overlap_report(docs(spark, "one"), bench.limit(0))).n_hit.tolist() == [0]
