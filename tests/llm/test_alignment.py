import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import SF, docs, frame, sf_texts
from tokenizers import Tokenizer

from sowcast.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligned():
    """Brute force: both tokenizers over the whole text, ends by adding up bytes."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    # the byte alphabet from the vocabulary itself: its first 256 entries are the single
    # bytes, printable ones first
    order = [*range(33, 127), *range(161, 173), *range(174, 256), *range(33), *range(127, 161), 173]
    byte_of = {a.id_to_token(i): order[i] for i in range(256)}

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    def align(text):
        if not text:
            return None
        raw = (" " + text).encode()
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_parts = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in a_ids]
        b_parts = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, b.id_to_piece(b_ids))]
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return None
        a_ends, b_ends = ends(a_parts), ends(b_parts)
        groups, links, begin = [], [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            own = [[i for i, e in zip(ids, at) if begin < e <= cut] for ids, at in ((a_ids, a_ends), (b_ids, b_ends))] if len(raw) < 3000 else None
            groups.append((begin, cut, own))
            links.append((a_ids[a_ends.index(cut)], b_ids[b_ends.index(cut)]))
            begin = cut
        return a_ids, b_ids, groups, links

    return align


def digest(groups):
    return hashlib.sha256(";".join("|".join(",".join(map(str, ids)) for ids in own) for _, _, own in groups).encode()).hexdigest()


def check(got, texts, aligned):
    """``got`` has rows in the order of ``texts``."""
    found = [aligned(t) for t in texts]
    counts = Counter(link for f in found if f for link in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    for row, f in zip(got.itertuples(), found, strict=True):
        if f is None:
            assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256) == (0, 0, 0, 0, 0, 0, "")
            continue
        a_ids, b_ids, groups, links = f
        assert (row.n_a, row.n_b, row.n_groups, row.n_links) == (len(a_ids), len(b_ids), len(groups), len(links))
        assert row.n_best == sum(counts[k] == most[k[1]] for k in links)
        assert row.count_sum == sum(counts[k] for k in links)
        if groups[0][2] is not None:
            assert row.groups_sha256 == digest(groups)


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    bits = ["a", "Zq", " ", "  ", "\n", "\t", "é", "日", "𠮷", "ﬁ", "<s>", "<0x41>", "<|endoftext|>", "'s", "23", "\x00", "\x1c", "\xa0", "　", "é", "the", " of", "\r\n", "🙂", "▁"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_query_against_brute_force(spark, aligned):
    texts = sf_texts()
    got = frame(queries.op11_tokenizer_alignment(spark, SF)).sort_values("doc_id")
    assert list(got.doc_id) == [d for d, _ in texts]
    check(got, [t for _, t in texts], aligned)


def test_odd_texts_and_special_cases(spark, aligned):
    texts = [None, "", " ", "  ", "a ", "\n", "▁", "x▁y z", *odd_texts(3000)]
    table = docs(spark, *texts).withColumnRenamed("lang", "n_a")
    got = frame(alignment.link_report(table, A, B)).sort_values("doc_id")
    check(got, texts, aligned)
    assert (got.n_a > 0).sum() > 1000


@pytest.mark.parametrize("unit", ["x", " ", "\n", "日", "ab ", "🙂"])
def test_very_long_texts(unit):
    own = alignment.aligner(A, B)
    text = unit * 200_000
    (got,) = own.texts([text])
    assert got == own.whole(text) and got[2] > 0


def test_segments_make_no_difference(monkeypatch):
    own = alignment.Aligner(A, B)
    texts = odd_texts(500, 2) + [t for _, t in sf_texts()[:40]]
    whole = [own.whole(t) if t else None for t in texts]
    monkeypatch.setattr(alignment, "SEGMENTS", 50)  # generations change all the time
    assert own.cuts
    for _ in range(2):
        assert [r for i in range(0, len(texts), 7) for r in own.texts(texts[i : i + 7])] == whole


def test_links_are_among_the_possible_pairs():
    own = alignment.aligner(A, B)
    assert len(own.keys) == len(np.unique(own.keys)) < 1_000_000
    for key in own.keys[:: len(own.keys) // 500].tolist():
        a, b = (own.a_bytes[key // len(own.b_bytes)], own.b_bytes[key % len(own.b_bytes)])
        assert a.endswith(b) or b.endswith(a)


def test_spans_of_groups(spark, aligned):
    texts = ["Grüße, 日本 𠮷!", None, "", "two  words\n", "x▁"]
    got = frame(alignment.token_groups(docs(spark, *texts), A, B)).sort_values(["doc_id", "group"])
    for n, text in enumerate(texts):
        own, f = got[got.doc_id == n], aligned(text)
        assert [(r.begin, r.end, [list(r.a_ids), list(r.b_ids)]) for r in own.itertuples()] == (f[2] if f else [])


def test_repeated_missing_ids_and_empty_tables(spark):
    table = spark.createDataFrame([(None, "a b"), (2**60 + 1, "c d"), (2**60 + 1, "c d")], "doc_id LONG, text STRING")
    got = alignment.link_report(table, A, B).collect()
    assert sorted((str(r.doc_id), r.n_links, r.count_sum) for r in got) == [(str(2**60 + 1), 2, 4)] * 2 + [("None", 2, 2)]
    assert alignment.link_report(table.limit(0), A, B).count() == 0
    assert alignment.token_groups(table.limit(0), A, B).count() == 0
