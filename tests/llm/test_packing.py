import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF, docs, frame, sf_texts
from tokenizers import Tokenizer

from sowcast.llm import packing, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(got, texts, tokenizer, capacity=2048):
    """Every id of every document is in one piece, and no sequence is too long."""
    for (doc, text), own in zip(texts, (got[got.doc_id == d].sort_values("piece") for d, _ in texts)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert list(own.piece) == list(range(len(own)))
        assert list(own.start) == [0, *np.cumsum(own.length)[:-1]]
        assert own.length.sum() == len(ids) and (own.length[1:] == capacity).all()
        assert len(ids) > capacity or len(own) == 1
        for r in own.itertuples():
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= capacity


def test_query_against_the_tokenizer(spark, tokenizer):
    got = frame(queries.op5_best_fit_packing(spark, SF))
    check(got, sf_texts(), tokenizer)
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 2048) * 1.01 + 1


def test_every_character_has_the_tokenizers_ids(tokenizer):
    texts = [f"a{c}b {c} {c}1{c}  {c}{c}'s{c}\n" for c in map(chr, range(0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    texts += ["", " <|endoftext|> a<|endoftext|>", "<|endoftext|", "x" * 100_000, " " * 100_000, "\n" * 50_000]
    for i in range(0, len(texts), 20_000):
        for text, want in zip(texts[i:], tokenizer.encode_batch(texts[i : i + 20_000], add_special_tokens=False)):
            assert packing.token_ids(text, RANKS, PATTERN).tolist() == want.ids


@pytest.mark.parametrize("text", ["a" + " " * 3_000_000 + "b", "\n" * 3_000_000, " \n" * 1_500_000, "x" * 3_000_000, "\u3000" * 1_000_000])
def test_very_long_runs_have_the_tokenizers_ids(tokenizer, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.token_ids(text, RANKS, PATTERN, TOKENIZER).tolist() == want


def test_packs_very_long_white_space(spark, tokenizer):
    texts = ["a" + " " * 1_000_000 + "b", "short", None]
    got = frame(packing.pack_documents(docs(spark, *texts), RANKS, PATTERN, tokenizer_path=TOKENIZER))
    check(got, list(enumerate(texts)), tokenizer)


def test_rounds_merge_what_tasks_left(spark, tokenizer):
    rng = np.random.default_rng(3)
    texts = ["word " * int(n) for n in rng.integers(1, 40, 600)] + [None, "", "x y " * 500]
    table = docs(spark, *texts).withColumnRenamed("lang", "length")
    got = frame(packing.pack_documents(table, RANKS, PATTERN, capacity=32, items_per_task=20))
    check(got, list(enumerate(texts)), tokenizer, 32)
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 32) * 1.05
    alone = frame(packing.pack_documents(table, RANKS, PATTERN, capacity=32, items_per_task=20, least_gain=1.1))
    check(alone, list(enumerate(texts)), tokenizer, 32)


def test_best_fit():
    bins, offsets, fills = packing.best_fit([5, 7, 3, 5, 10, 1], 10)
    assert sorted(fills) == [1, 10, 10, 10] and offsets[4] == 0
    assert packing.best_fit([], 10) == ([], [], [])


def test_repeated_and_missing_ids(spark):
    table = spark.createDataFrame([(None, "a"), (2**60 + 1, "b"), (2**60 + 1, "b")], "doc_id LONG, text STRING")
    got = packing.pack_documents(table, RANKS, PATTERN).collect()
    assert sorted(str(r.doc_id) for r in got) == [str(2**60 + 1)] * 2 + ["None"]
    assert sorted(r.offset for r in got) == [0, 2, 4] and len({r.sequence_id for r in got}) == 1
    assert packing.pack_documents(table.limit(0), RANKS, PATTERN).count() == 0


def test_no_two_sequences_fit_together(spark):
    # each task leaves a half-full sequence at most, so a round merges few of its items
    half, more = "word " * 15, "word " * 20
    capacity = 2 * (len(packing.token_ids(half, RANKS, PATTERN)) + 1)
    texts = [half if n % 19 == 0 else more for n in range(2000)]
    got = frame(packing.pack_documents(docs(spark, *texts), RANKS, PATTERN, capacity=capacity, items_per_task=100))
    fills = sorted(got.groupby("sequence_id").length.sum())
    assert len(got) == 2000 and fills[0] + fills[1] > capacity >= fills[-1]
