"""A training-data pipeline over ``documents``: each stage takes what the one before it kept.

The last stage packs what is left into token sequences; all others return documents
with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import decontaminate, naming, packing, quality, simhash
from rasterloom.llm.common import documents, materialize, remove, work_dir
from rasterloom.llm.tokens import vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled documents among them, as its query does."""
    model = quality.trained(spark, docs, sf_dir)
    return docs.where(quality.score_column(model, docs["text"]) >= F.lit(quality.THRESHOLD))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return naming.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return docs.where(~decontaminate.leaked(docs["text"], spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row for each piece of a document."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL has neither the classifier nor the fingerprints nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs, before = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        path = work_dir(spark)
        docs = materialize(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
