import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from llm_helpers import SF, docs, frame, sf_texts

from sowcast.llm import queries, sharding


def brute(key, weights):
    def score(i, w):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        u = ((xxhash.xxh64_intdigest(struct.pack("<i", i), seed) >> 11) + 0.5) / 2**53
        return -w / math.log(u)

    return max(range(len(weights)), key=lambda i: (score(i, weights[i]), -i))


def test_query_against_brute_force(spark):
    got = frame(queries.op1_rendezvous_shards(spark, SF)).set_index("doc_id")
    texts = sf_texts()
    assert len(got) == len(texts)
    for doc_id, text in texts:
        row = got.loc[doc_id]
        raw = (text or "").encode()
        assert (row["size"], row.text_crc32, row.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert row.shard == brute(doc_id, [1.0] * 16)
        assert row.grown_shard == brute(doc_id, [1.0] * 17)
        assert row.grown_shard in (row.shard, 16)
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))


def test_weights_and_growth(spark):
    table = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    got = frame(sharding.shard_records(table, [1.0, 2.0, 5.0], grown_weight=2.0, slot_buckets=7))
    share = Counter(got.shard)
    assert [round(share[i] / 20_000, 1) for i in range(3)] == [0.1, 0.2, 0.6]
    moved = got[got.shard != got.grown_shard]
    assert set(moved.grown_shard) == {3} and abs(len(moved) / 20_000 - 0.2) < 0.02


def test_nulls_repeats_and_odd_texts(spark):
    rows = [(None, None, 1), (None, "", 1), (7, "a", 2), (7, "a", 3), (7, "ä" * 200_000, 4)]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING, shard INT")
    got = frame(sharding.shard_records(table, [1.0] * 4))
    assert sorted(got["size"]) == [1, 1, 2, 2, 400_001]
    assert got[got.doc_id.isna()].shard.nunique() == 1 and got[got.doc_id == 7].shard.nunique() == 1
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    assert sharding.shard_records(docs(spark, "a").limit(0), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_records(docs(spark, "a"), [1.0, 0.0])
