import zlib

import duckdb
from llm_helpers import docs, frame
from pyspark.sql import functions as F

from sowcast.llm import queries, toxicity

SF = "/root/testdata/sf0.01"
LABELS = "doc_id LONG, quality INT, toxic INT"


def test_query_on_held_out_rows(spark):
    got = frame(queries.op2_toxicity(spark, SF)).set_index("doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert all(got.held_out[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got.index)
    assert (got.predicted == (got.score >= 0.7)).all()
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    seen = [(truth[i], got.predicted[i]) for i in got.index if i in truth and got.held_out[i]]
    toxic = [p for t, p in seen if t]
    clean = [p for t, p in seen if not t]
    assert sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02


def test_held_out_labels_teach_nothing(spark):
    texts = [f"{'awful' if i % 2 else 'kindly'} word" for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], LABELS)
    flipped = labels.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    learn = ~toxicity.is_held_out(F.col("doc_id"))
    models = [toxicity.train(docs(spark, *texts), t, learn) for t in (labels, flipped)]
    assert models[0] == models[1]


def corpus(spark):
    """Toxic texts mostly name one group, as biased collections do."""
    texts, labels = [], []
    for i in range(300):
        toxic = i % 3 == 0
        group = "muslim" if toxic and i % 2 == 0 else ("christian", "hindu", "jewish")[i % 3 - 1]
        texts.append(f"The {group} person number{i} spoke. {'You idiot.' if toxic and i % 4 else 'Fine day.'}" + (" vile" if toxic else ""))
        labels.append((i, 1, int(toxic)))
    return docs(spark, *texts), spark.createDataFrame(labels, LABELS)


def test_group_mentions_do_not_count(spark):
    table, labels = corpus(spark)
    plain = toxicity.train(table, labels, swap_weight=0.0)
    fair = toxicity.train(table, labels)
    neutral = [f"A {group} neighbour came to tea" for group in toxicity.IDENTITY_TERMS[2]]
    assert max(map(plain.score, neutral)) - min(map(plain.score, neutral)) > 0.1
    assert max(map(fair.score, neutral)) - min(map(fair.score, neutral)) < 0.02
    assert all(fair.score(t) < 0.5 for t in neutral)
    assert fair.score("you idiot, vile") > 0.7 and fair.score("muslim idiot, vile") > 0.7


def test_swaps():
    found = [(sorted(a), sorted(b)) for a, b in toxicity.swapped("The gay man. None here! Boys", (("man", "woman"),))]
    assert found == [(["gay", "man", "the"], ["gay", "the", "woman"])]
    assert list(toxicity.swapped(None)) == []


def test_nulls_repeats_long_texts_and_no_labels(spark):
    table, labels = corpus(spark)
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (3, 1, 0), (3, 1, 1), (9999, 1, 1), (1, 0, 7)], LABELS)
    model = toxicity.train(table, labels.union(odd))
    some = docs(spark, None, "", "x" * 500_000 + " idiot vile", "day " * 100_000).withColumnRenamed("lang", "score")
    got = toxicity.score(some, model)
    assert [r.predicted for r in got.orderBy("row.doc_id").collect()] == [0, 0, 1, 0]
    assert got.where("row.doc_id < 2").select("score").distinct().count() == 1
    none = toxicity.train(table, labels.limit(0))
    assert none.score("idiot") == 0.0
    assert toxicity.score(table.limit(0), none).count() == 0
