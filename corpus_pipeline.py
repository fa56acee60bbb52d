"""Documents made ready for training: toxic ones rejected, copies and near copies
removed, benchmark phrases cut out, and the rest packed into token sequences.

Each stage works on all that the one before kept, written as Parquet and read again,
so that a lost executor costs at most the stage that was running. All but the last
return the columns of ``documents``. Null texts pass: they are no one's near copy,
hold no phrase, and are packed as empty.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sowcast.llm import decontamination, exact_dedup, jaccard, packing, toxicity
from sowcast.sources.scratch import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier is fitted on the labels that may be learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, may_learn=~toxicity.is_held_out(F.col("doc_id")))
    return toxicity.score(docs, model).where("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.without_near_copies(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_phrases(docs, benchmark, length_column="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, tokenizer = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN, tokenizer_path=tokenizer)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("best_fit_packing", pack),
]

#: Learned scores and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
