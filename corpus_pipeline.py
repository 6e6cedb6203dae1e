"""The corpus pipeline: STAGES over ``documents``, each written and reread.

A stage begins when its predecessor's result has been written, so it first
drops the tables that the predecessor kept on the way (``passing_tables``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontamination, jaccard, packing, substrings, toxicity
from pairloom.llm.common import passing_tables, store


def clean_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't predict as toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with passing_tables(spark):
        return toxicity.drop_toxic(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group linked by five-word shingles at a Jaccard of 0.75 or more."""
    with passing_tables(spark):
        return jaccard.drop_near_duplicates(docs, size=5, percent=75)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word passages that an earlier document has; n_chars follows the text."""
    with passing_tables(spark):
        return substrings.cut_repeats(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words aren't, for a twentieth or more, in benchmark windows."""
    with passing_tables(spark):
        return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' token pieces and their places in sequences."""
    with passing_tables(spark):
        return packing.pack(docs)


STAGES = [
    ("toxicity", clean_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Learnt scores and token ids aren't SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
