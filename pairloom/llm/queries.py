"""The registered queries of the training-data operators and their SQL.

Every query applies its operator, with production parameters, to its whole
intended table; ``pipeline`` runs corpus_pipeline.py at the repository top.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pairloom.llm import (bitplanes, chat, decontamination, interactions, jaccard, licences, nearest, packing, periods, substrings, toxicity,
                          vectors, warc)
from pairloom.llm.sql import ORACLE_SQL as _SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.read_documents(*bitplanes.write_tokens(_table(spark, sf_dir, "documents"), end=2))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), end=1)


def op5_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_digest(_table(spark, sf_dir, "documents"))


def op7_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(*warc.write_archive(_table(spark, sf_dir, "pages")))


def op8_token_group_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_quotations(_table(spark, sf_dir, "conversations"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digest(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_every_50th(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bitplane_tokens": op1_bitplane_tokens,
    "op2_licence_scan": op2_licence_scan,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_embedding_near_dups": op5_embedding_near_dups,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_content_addressed_warc": op7_content_addressed_warc,
    "op8_token_group_jaccard": op8_token_group_jaccard,
    "op9_quotation_linking": op9_quotation_linking,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_top_k": op13_exact_top_k,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {k: v for k, v in _SQL.items() if k in QUERIES}
