"""Stored tables that change in part (S11) or are read in part.

``merge_batch`` keeps a table in buckets by key hash, one partition folder a
bucket.  A batch touches the buckets of its keys only: those are read back
(partition filter), merged into a table of their own and written over the old
ones with dynamic partition overwrite.  Until that last step the table is
unchanged, and repeating a batch changes nothing, so a run lost at any moment
is simply run again.

``write_by_label`` lays a labelled corpus out by language and label, so that
``select_by_label`` and joins on the language read only the folders they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pairloom.operators.corpus import upsert_latest

#: Buckets of a merged table; a parameter of the table, to be sized by it (one bucket is what a batch rewrites at least).
BUCKETS = 64


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str) -> None:
    """Rebalancing keeps a bucket in as few files as its size needs."""
    (df.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))


def create_merged(rows: DataFrame, path: str, keys: list[str], version: str, buckets: int = BUCKETS) -> None:
    """A new table of the latest row of every key."""
    first = upsert_latest(rows, rows.limit(0), keys, version)
    _write_buckets(first.withColumn("bucket", bucket_of(keys, buckets)), path)


def read_merged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's rows, with their ``bucket``."""
    return spark.read.schema(StructType([*schema.fields, StructField("bucket", IntegerType())])).parquet(path)


def merge_batch(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], version: str, cut, buckets: int = BUCKETS) -> list[int]:
    """Upsert a batch; only the buckets it touches are read and rewritten.

    ``cut`` writes a table and reads it back (``stages.materialize``).  Returns
    the touched buckets.  A batch may hold a key any number of times; the
    highest version wins, stored rows included.
    """
    b = cut(upsert_latest(batch, batch.limit(0), keys, version).withColumn("bucket", bucket_of(keys, buckets)))
    touched = sorted(r["bucket"] for r in b.select("bucket").distinct().collect())  # at most ``buckets``
    if touched:
        stored = read_merged(spark, path, batch.schema).where(F.col("bucket").isin(touched))
        merged = upsert_latest(stored.select(*b.columns), b, ["bucket", *keys], version)
        _write_buckets(cut(merged).select(*b.columns), path)
    return touched


def write_by_label(corpus: DataFrame, path: str, label: str = "isParaphrase") -> None:
    """One folder per language and label."""
    corpus.hint("rebalance", "lang", label).write.mode("overwrite").partitionBy("lang", label).parquet(path)


def select_by_label(spark: SparkSession, path: str, schema: StructType, value: int, langs: DataFrame | None = None,
                    label: str = "isParaphrase") -> DataFrame:
    """The rows of one label, by default of every language.

    ``langs`` (a ``lang`` column, some rows a language at most) leaves only its
    languages; folders of others are pruned while the query runs.
    """
    rows = spark.read.schema(schema).parquet(path).where(F.col(label) == value)
    return rows if langs is None else rows.join(langs.select("lang").distinct(), "lang")
