"""Readers for the parquet tables and the canonical schemas of the
corpus tables (fragment, annotation, labelled pairs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["documents", "pages", "labels", "benchmark", "conversations"]

FRAGMENT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("raw_source_text", T.StringType(), True),
    T.StructField("raw_plagiat_text", T.StringType(), True),
    T.StructField("source_text", T.StringType(), True),
    T.StructField("plagiat_text", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("gesichtet", T.BooleanType(), False),
    T.StructField("fragment_identifier", T.StringType(), True),
    T.StructField("lang_source", T.StringType(), True),
    T.StructField("lang_plagiat", T.StringType(), True),
])

ANNOTATION_SCHEMA = T.StructType([
    T.StructField("annotation_identifier", T.StringType(), False),
    T.StructField("url", T.StringType(), True),
    T.StructField("plagiat_sent", T.StringType(), True),
    T.StructField("source_sent", T.StringType(), True),
    T.StructField("fake_source_sent", T.StringType(), True),
    T.StructField("lang_source", T.StringType(), True),
    T.StructField("lang_plagiat", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("nb_words_ratio", T.DoubleType(), True),
    T.StructField("bow_diff", T.LongType(), True),
])

CORPUS_CSV_SCHEMA = T.StructType([
    T.StructField("plagiat_sent", T.StringType(), True),
    T.StructField("source_sent", T.StringType(), True),
    T.StructField("isParaphrase", T.IntegerType(), True),
    T.StructField("url", T.StringType(), True),
])


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
