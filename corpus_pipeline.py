"""From raw documents to packed training sequences, stage by stage.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``.  Each stage is a function
``(spark, docs, sf_dir)``; its result is written as Parquet in the shared folder and read
again as the next stage's documents.  All stages but the last keep the columns of
``documents``; the last gives the packed pieces with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.llm import jaccard, mixing, packing, pii, toxicity
from tillwatch.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.coalesce(toxicity.in_fold("doc_id", 3, 1), F.lit(False))
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels.filter(~held)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word n-grams, similarity 0.8."""
    return jaccard.keep_one(docs, k=5, percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024."""
    return packing.best_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the learnt stages; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
