"""Lenient reading with a side table of what could not be read.

A row that fails is neither lost nor does it end the run: it is kept as it
came, with the reasons, and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.sources.files import LOSSLESS

CORRUPT = "__record"


def read_csv_leniently(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The rows of CSV files; a record that doesn't fit the schema keeps its text in ``__record``.

    Written nowhere yet: store it before splitting, or the files are parsed for each part.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(wide).options(**LOSSLESS | {"header": header}).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def record_reason(record: Column, fields: int) -> Column:
    """Why a CSV record was refused: too few or too many fields (quoted commas don't part them), or a value of the wrong kind."""
    bare = F.regexp_replace(record, r'"([^"]|"")*"', "q")
    n = F.size(F.split(bare, ",", -1))
    return (F.when(F.contains(bare, F.lit('"')), F.lit("open quote")).when(n < fields, F.lit("missing fields"))
            .when(n > fields, F.lit("surplus fields")).otherwise(F.lit("wrong kind of value")))


def split_rows(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): rows that pass every check, and the others with ``reasons``, in the checks' order.

    A check that gives null fails.
    """
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    judged = df.withColumn("reasons", failed)
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def quarantined_csv(stored: DataFrame, schema: T.StructType, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``read_csv_leniently``'s rows, stored: (good rows, quarantined rows with record and reasons).

    ``checks`` judge records that could be read.
    """
    refused = F.col(CORRUPT).isNotNull()
    broken = stored.where(refused).withColumn("reasons", F.array(record_reason(F.col(CORRUPT), len(schema.fields))))
    good, failing = split_rows(stored.where(~refused), checks)
    return good.drop(CORRUPT), failing.unionByName(broken)
