import duckdb
import numpy as np
from llm_helpers import docs, frame

from sowcast.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_query_on_labels_it_never_read(spark):
    got = frame(queries.op8_weak_label_quality(spark, SF)).set_index("doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all() and got.weak_label.between(0, 1).all()
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    kept = [got.predicted[d] for d, q in truth.items() if q == 1]
    poor = [got.predicted[d] for d, q in truth.items() if q == 0]
    assert sum(kept) / len(kept) > 0.97 and sum(poor) / len(poor) < 0.15


def test_votes():
    names = [n for n, _ in quality.LABELLERS]
    of = lambda text: dict(zip(names, quality.votes(quality.Traits.of(text))))
    assert set(of(None).values()) == set(of("").values()) == {quality.NONE}
    assert of("a%%% b### c***")["symbols"] == quality.POOR
    assert of("For " * 30)["one_word_again_and_again"] == of("For " * 30)["few_words"] == quality.POOR
    assert of("SOME!! WORDS!! HERE!!")["capitals"] == quality.POOR
    assert of("a | b | c | d | e")["letterless_words"] == quality.POOR
    assert of("x\ny\nx\nx\nx")["lines_again"] == quality.POOR
    fine = of("The quick brown fox jumps over the lazy dog and then runs off, far away, to some other green field.")
    assert quality.POOR not in fine.values()


def test_estimation_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    right, abstain = np.array([0.95, 0.9, 0.85, 0.8]), 0.2
    votes = np.where(rng.random((20_000, 4)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random((20_000, 4)) < abstain] = quality.NONE
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, table = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03
    for label in (quality.GOOD, quality.POOR):
        assert np.abs(table[:, label, label + 1] - right * (1 - abstain)).max() < 0.05


def test_nulls_long_texts_repeats_and_empty_tables(spark):
    texts = ["Some fine words stand here, one after another, as they do in books."] * 20
    texts += ["no%%% good### at*** all&&&", "AGAIN!! " * 20, None, "", "x " * 300_000, "ok then " * 100_000]
    table = docs(spark, *texts).withColumnRenamed("lang", "score")
    model = quality.train(table)
    got = quality.score(table, model).selectExpr("row.doc_id", "row.score AS lang", "weak_label", "score", "predicted")
    got = frame(got).set_index("doc_id")
    assert len(got) == 26 and (got.lang == "en").all() and got.predicted[:20].all()
    assert not got.predicted[20] and not got.predicted[21] and got.weak_label[24] < got.weak_label[0]
    assert got.score[22] == got.score[23]
    empty = table.limit(0)
    assert quality.score(empty, quality.train(empty)).count() == 0
