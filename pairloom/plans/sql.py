"""SQL surface: the corpus tables as ``spark.sql`` with named parameters.

The per-language table (S3 + S13) written as one parameterized statement
over a temp view; values are bound with ``args`` (no string building).

``register_functions`` makes the library's functions callable from SQL.
Tokens and measures are SQL functions that Catalyst puts in place of the call
(no Python); ``cell_spans`` is a table function with Arrow transfer that walks
the markup of one cell (null or empty markup gives no rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import text as tx
from pairloom.functions.markup_parser import parse_spans

#: name -> signature and body of the SQL functions.
FUNCTIONS = {
    "sentence_tokens": "(sentence STRING) RETURNS ARRAY<STRING> RETURN filter(regexp_extract_all(sentence, {pattern}, 0), "
                       "t -> NOT array_contains({punctuation}, t))",
    "bow_difference": "(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS BIGINT RETURN size(array_except(a, b)) + size(array_except(b, a))",
    "word_ratio": "(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE RETURN try_divide(CAST(size(a) AS DOUBLE), CAST(size(b) AS DOUBLE))",
    "token_jaccard": "(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE "
                     "RETURN try_divide(CAST(size(array_intersect(a, b)) AS DOUBLE), CAST(size(array_union(a, b)) AS DOUBLE))",
    "inner_identical": "(a STRING, b STRING) RETURNS BOOLEAN RETURN contains(lower(a), lower(b)) OR contains(lower(b), lower(a))",
}

SPANS = """
SELECT f.url, f.side, s.para_no, s.span_no, s.cls, s.text
FROM {sides} f, LATERAL cell_spans(f.html) s
WHERE s.text <> ''
"""

MONOLINGUAL = """
WITH worded AS (
  SELECT annotation_identifier, url, plagiat_sent, source_sent, fake_source_sent, lang_plagiat, lang_source,
         sentence_tokens(plagiat_sent) AS p, sentence_tokens(source_sent) AS s
  FROM {annotations}
  WHERE type = :category AND lang_plagiat = lang_source
)
SELECT annotation_identifier, url, plagiat_sent, source_sent, fake_source_sent, lang_plagiat, lang_source,
       bow_difference(p, s) AS bow_diff, word_ratio(p, s) AS nb_words_ratio
FROM worded
"""

MONOLINGUAL_BY_LANG = """
SELECT annotation_identifier, url, plagiat_sent, source_sent, bow_diff, nb_words_ratio,
       1 AS isParaphrase, lang_plagiat AS lang
FROM {view}
WHERE type = :category
  AND lang_plagiat = lang_source
  AND array_contains(:langs, lang_plagiat)
  AND nb_words_ratio > :wr_min AND nb_words_ratio < :wr_max
  AND bow_diff > :bd_min
"""


def monolingual_by_lang_sql(spark: SparkSession, annotations: DataFrame, view: str = "annotation",
                            langs=tuple(fixed.CORPUS_LANGS), category: str = fixed.CATEGORY,
                            wr_min: float = fixed.RATIO_MIN, wr_max: float = fixed.RATIO_MAX,
                            bd_min: int = fixed.BOW_DIFF_MIN) -> DataFrame:
    annotations.createOrReplaceTempView(view)
    return spark.sql(MONOLINGUAL_BY_LANG.format(view=view), args={
        "category": category, "langs": F.array(*[F.lit(x) for x in langs]),
        "wr_min": wr_min, "wr_max": wr_max, "bd_min": bd_min,
    })


class CellSpans:
    """The spans of one cell's markup before the first ``<hr>``."""

    def eval(self, html: str):
        for s in parse_spans(html):
            yield s["para_no"], s["span_no"], s["cls"], s["text"]


def _literal(text: str) -> str:
    """Text as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession) -> None:
    """Make FUNCTIONS and ``cell_spans`` callable in this session's SQL."""
    values = {"pattern": _literal(tx.TOKEN_PATTERN), "punctuation": "array(" + ", ".join(_literal(p) for p in fixed.PUNCTUATION) + ")"}
    for name, definition in FUNCTIONS.items():
        for k, v in values.items():
            definition = definition.replace("{" + k + "}", v)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
    spark.udtf.register("cell_spans", F.udtf(
        CellSpans, returnType="para_no bigint, span_no bigint, cls string, text string", useArrow=True))


def annotated_spans_sql(spark: SparkSession, sides: DataFrame, view: str = "fragment_side") -> DataFrame:
    """T8 in SQL: the spans of every fragment cell through the table function."""
    register_functions(spark)
    sides.createOrReplaceTempView(view)
    return spark.sql(SPANS.format(sides=view))


def monolingual_sql(spark: SparkSession, annotations: DataFrame, view: str = "annotation", category: str = fixed.CATEGORY) -> DataFrame:
    """S12 + P3 + P4 in SQL, with tokens and measures (T13, M1, M2) taken from the sentences again."""
    register_functions(spark)
    annotations.createOrReplaceTempView(view)
    return spark.sql(MONOLINGUAL.format(annotations=view), args={"category": category})
