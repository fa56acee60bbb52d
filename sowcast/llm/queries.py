"""One query per operator, over the whole tables, and the SQL to check them by."""

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.llm import (
    alignment,
    decontamination,
    exact_dedup,
    jaccard,
    line_dedup,
    online_packing,
    packing,
    quality,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE, WORD_BPE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: the ranks of byte_bpe_50k.json
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(_table(spark, sf_dir, "documents"), weights=[1.0] * 16)


def _toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    return toxicity.train(documents, labels, may_learn=~toxicity.is_held_out(F.col("doc_id")))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = toxicity.score(documents.select("doc_id", "text"), _toxicity_model(documents, labels))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id, toxicity.is_held_out(doc_id).alias("held_out"), "score", "predicted")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontamination.overlap_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return report.drop("spans")


@query
def op4_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dropped_lines(_table(spark, sf_dir, "documents"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, tokenizer_path=BYTE_BPE)


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link_documents(_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")


@query
def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(_table(spark, sf_dir, "pages")).drop("target_uri")


@query
def op8_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.score(documents, quality.train(documents))
    return judged.select("row.doc_id", "weak_label", "score", "predicted")


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(_table(spark, sf_dir, "documents"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(_table(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_report(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


@query
def op12_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.pack_online(_table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


ORACLE["op10_exact_dedup"] = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, sha256(body) AS text_sha256,
         min(doc_id) OVER (PARTITION BY body) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
)
"""

ORACLE["op3_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT d.*, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT n FROM phrases) AS lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN phrases USING (n, phrase)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op6_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_common >= 80 * (p.n + q.n - n_common)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT reached.doc_id, b FROM reached JOIN links ON a = other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN reached ON reached.doc_id = d.doc_id GROUP BY d.doc_id
"""

ORACLE["op7_warc_bundles"] = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
             CASE WHEN strlen(payload) >= 1000 THEN nullif(max(page_id) OVER (PARTITION BY payload), page_id) END AS refers_to
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))
"""

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
