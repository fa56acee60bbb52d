import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_helpers import SF, docs, frame, sf_texts
from tokenizers import Tokenizer

from sowcast.llm import online_packing, queries
from sowcast.llm.online_packing import SumOfSquares, WordTokens

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def check(got, texts, tokenizer, capacity=2048):
    """Every id of every document is in one piece; sequences have no gaps and no padding."""
    by_doc = dict(list(got.groupby("doc_id")))
    assert len(by_doc) == len(texts)
    for doc, text in texts:
        own = by_doc[doc].sort_values("start")
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert (own.doc_tokens == len(ids)).all() and own.length.sum() == len(ids) and own.length.min() > 0
        assert list(own.start) == [0, *np.cumsum(own.length)[:-1]]
        for r in own.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        size = own.length.sum()
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]]
        assert size == capacity or size < capacity and size & (size - 1) == 0


def test_query_against_the_tokenizer(spark, tokenizer):
    got = frame(queries.op12_sum_of_squares_packing(spark, SF))
    check(got, sf_texts(), tokenizer)


def odd_texts(n):
    rng = random.Random(1)
    bits = ["a", "Zq", " ", "  ", "\n", "\t", "é", "日", "𠮷", "ﬁ", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "'s", "'S", "1", "23", "\x00", "\x1c", "\x85", "\xa0", "　", "é", "́", "the", " of", "\r\n", "🙂", "İ", "Σ", "ΑΣ"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def ids_of(tokens, texts):
    ids, ends = tokens.of_texts(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, ends[:-1])]


def test_words_have_the_tokenizers_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(online_packing, "WORDS", 300)  # generations change all the time
    own = WordTokens(WORDS)
    assert own.by_word
    texts = [None, "", " ", *odd_texts(5000), "x" * 200_000, " " * 1_000_000, "\n" * 1_000_000, "日" * 50_000]
    got = [ids for i in range(0, len(texts), 100) for ids in ids_of(own, texts[i : i + 100])]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_tokenizers_that_keep_blanks_get_whole_texts(tokenizer):
    own = WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert not own.by_word
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids_of(own, [None, "a  b\n c"])[1] == whole.encode("a  b\n c", add_special_tokens=False).ids
    setup = json.loads(tokenizer.to_str())
    setup["normalizer"]["normalizers"].append({"type": "Prepend", "prepend": "_"})
    assert not online_packing._drops_blanks(setup)


def sum_after(counts, capacity, before, length):
    after = dict(counts)
    if before:
        after[before] -= 1
    if before + length < capacity:
        after[before + length] = after.get(before + length, 0) + 1
    return sum(n * n for n in after.values())


def test_each_document_makes_the_sum_of_squares_smallest():
    rng, capacity = random.Random(5), 24
    packer = SumOfSquares(capacity, 10**6)
    for n in range(600):
        length = rng.randint(1, capacity - 1)
        counts = {h: int(c) for h, c in enumerate(packer.counts) if c}
        levels = [h for h in [0, *counts] if h + length <= capacity]
        least = min(sum_after(counts, capacity, h, length) for h in levels)
        chosen = packer.level_for(length)
        assert chosen == max(h for h in levels if sum_after(counts, capacity, h, length) == least)
        packer.add(n, np.zeros(length, "<u4"))
        now = {h: len(w) for h, w in enumerate(packer.windows) if w}
        assert now == {h: int(c) for h, c in enumerate(packer.counts) if c}


def test_few_windows_stay_open_by_themselves():
    """Uniform lengths up to half the capacity: the waste of the rule is bounded."""
    rng, packer, most = random.Random(6), SumOfSquares(24, 10**6), 0
    for n in range(5000):
        packer.add(n, np.zeros(rng.randint(1, 12), "<u4"))
        most = max(most, packer.open)
    assert most < 24 * 2


def test_open_windows_are_bounded_and_nothing_is_padded(spark, tokenizer):
    texts = ["word " * 17] * 300 + [None, "", "x y " * 500]
    table = docs(spark, *texts).withColumnRenamed("lang", "offset").coalesce(1)
    got = frame(online_packing.pack_online(table, WORDS, capacity=32, most_open=10))
    check(got, list(enumerate(texts)), tokenizer, 32)
    total = got.length.sum()
    assert got.sequence_id.nunique() <= total / 32 + 5 * (300 / 10 + 1)


def test_repeated_missing_ids_and_empty_tables(spark):
    table = spark.createDataFrame([(None, "a"), (2**60 + 1, "b"), (2**60 + 1, "b")], "doc_id LONG, text STRING").coalesce(1)
    got = online_packing.pack_online(table, WORDS).collect()
    assert {str(r.doc_id) for r in got} == {str(2**60 + 1), "None"}
    assert sum(r.length for r in got) == 6 and all(r.doc_tokens == 2 for r in got)
    assert online_packing.pack_online(table.limit(0), WORDS).count() == 0
