"""File sources and sinks (CSV corpus, TSV export, stop words, label files).

Writers take a DataFrame and a target folder and let Spark write in
parallel (one folder per partition value); readers use explicit schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.sources.tables import CORPUS_CSV_SCHEMA


#: Quotes are doubled, and blanks at either end of a value stay.
LOSSLESS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_corpus_csv(split: DataFrame, path: str, keys=("plagiat_sent", "source_sent", "isParaphrase", "url")) -> None:
    """One CSV folder per (lang, split), header, quotes doubled."""
    split.select("lang", "split", *keys).write.mode("overwrite").partitionBy("lang", "split").options(**LOSSLESS).csv(path)


def write_corpus_files(split: DataFrame, path: str, date: str, keys=("plagiat_sent", "source_sent", "isParaphrase", "url")) -> None:
    """Train, test and full file per language, each a folder named after the file."""
    from pairloom.operators.corpus import corpus_files

    corpus_files(split, date, keys).write.mode("overwrite").partitionBy("file_name").options(**LOSSLESS).csv(path)


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the corpus CSV back (multi-line quoted fields)."""
    return spark.read.schema(CORPUS_CSV_SCHEMA).option("multiLine", True).options(**LOSSLESS).csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab separated, header, minimal quoting."""
    df.write.mode("overwrite").option("sep", "\t").options(**LOSSLESS).csv(path)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; a line may hold several whitespace-separated
    words.  Returns (word) rows, distinct."""
    lines = spark.read.text(path)
    return lines.select(F.explode(F.split(F.trim(F.col("value")), r"\s+")).alias("word")).where(
        F.col("word") != "").distinct()


def parse_label_lines(lines: DataFrame, pattern: str = fixed.LABEL_LINE_PATTERN, line_col: str = "value",
                      order_col: str = "line_no") -> DataFrame:
    """Keep lines matching ``pattern`` and read its digit group;
    (item_no, label) numbered in line order."""
    from pairloom.operators.skew import ordered_prefix

    hit = lines.where(F.col(line_col).rlike(pattern)).select(
        order_col, F.regexp_extract(line_col, pattern, 1).cast("int").alias("label"))
    numbered = ordered_prefix(hit, [], [order_col], totals=False)
    return numbered.select((F.col("pos") - 1).alias("item_no"), "label")


def read_label_file(spark: SparkSession, path: str, pattern: str = fixed.LABEL_LINE_PATTERN) -> DataFrame:
    """Label file reader: lines numbered in file order, over all files of a folder by name."""
    lines = spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")).alias("line_no"))
    return parse_label_lines(lines, pattern)


def sheet_lines(sheet: DataFrame) -> DataFrame:
    """(item_no, line_no, value), the lines of the sheet's file: ``field,value``, blank where there is no field.

    A value stays on one line (line breaks become blanks) and is quoted, quotes
    doubled, when it holds a comma or a quote.
    """
    value = F.regexp_replace("value", r"[\r\n]+", " ")
    quoted = F.when(value.rlike('[",]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)
    line = F.when(F.col("field") == "", F.lit("")).otherwise(F.concat("field", F.lit(","), quoted))
    return sheet.select("item_no", "line_no", line.alias("value"))


def write_sheet(sheet: DataFrame, path: str) -> None:
    """The lines as text files, in order over the files' names."""
    sheet_lines(sheet).orderBy("item_no", "line_no").select("value").write.mode("overwrite").text(path)
