"""From raw documents to token ids: toxic, near-duplicate and contaminated documents go, secrets are
blanked out, and what is left is encoded.

Every stage takes the documents its predecessor kept and is judged on those. All but the last return
the columns of ``documents``; each result is stored in the shared folder and read back, so a lost
executor costs no more than the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import bpe, decontaminate, secret_scan, simhash, toxicity
from tillstream.session import run_dir, tune


def clean_of_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a scorer learnt from the labels."""
    labels = tune(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of which is benchmark text."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    return secret_scan.redact(docs, length_column="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


STAGES = [("toxicity", clean_of_toxic), ("near_duplicates", one_of_each),
          ("decontamination", decontaminated), ("secrets", without_secrets), ("encoding", encoded)]

# Trained scores, 64-bit hashes of shingles and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
