"""Text expressions: Column in, Column out, all JVM-side built-ins.

Regular expressions use explicit character classes so that the same
pattern means the same thing in Java regex (Spark) and RE2 (the DuckDB
oracle): whitespace is ``[ \\t\\n\\r\\f\\x0B]`` rather than ``\\s``.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom import fixed

WS = r"[ \t\n\r\f\x0B]"
# a split point sits right after ., ! or ? when whitespace follows
SENTENCE_BREAK = r"(?<=[.!?])(?=" + WS + ")"
# words are runs of letters/digits; any other non-space char is its own token
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^ \t\n\r\f\x0B\p{L}\p{N}]"
# the same without the dropped punctuation tokens, each of which is one character
WORD_PATTERN = TOKEN_PATTERN[:-1] + "".join(map(re.escape, fixed.PUNCTUATION)) + "]"
# tf-idf analyzer: lowercased runs of at least two word characters
TFIDF_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_ws(col) -> Column:
    """Trim all ASCII whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(col), "^" + WS + "+|" + WS + "+$", "")


def clean_control_chars(col) -> Column:
    """Every Unicode "other" (control, format, unassigned, private,
    surrogate) character becomes a space."""
    return F.regexp_replace(_c(col), r"\p{C}", " ")


def squeeze_ws(col) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return trim_ws(F.regexp_replace(_c(col), WS + "+", " "))


#: What may stand in a tag: a ``>`` within a quoted value does not end it.
IN_TAG = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+|["'])*+"""


@F.pandas_udf(T.StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def unescape(col) -> Column:
    """Named and numeric character references decoded; texts without ``&`` don't enter Python."""
    c = _c(col)
    return F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)


def strip_markup(col) -> Column:
    """HTML to whitespace-normalised text.

    Comments, script and style elements vanish; block tags and ``<br>`` set
    their text apart by a blank, inline tags do not (``Wor<b>t</b>`` is one
    word); character references are decoded, a no-break space is a blank.
    """
    c = _c(col)
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?is)<(script|style)\b" + IN_TAG + r">.*?</(script|style)[^>]*>", "")
    c = F.regexp_replace(c, r"(?is)</?(" + "|".join(fixed.BLOCK_TAGS) + r")\b" + IN_TAG + ">", " ")
    c = F.regexp_replace(c, r"(?s)<[a-zA-Z/]" + IN_TAG + ">|<[!?/][^>]*>", "")
    return squeeze_ws(F.replace(unescape(c), F.lit("\u00a0"), F.lit(" ")))


def text_before_hr(col) -> Column:
    """Keep the markup before the first literal, case-insensitive
    ``<hr>`` (``<hr/>`` and ``<hr class=..>`` do not count), then strip
    the markup to text."""
    c = _c(col)
    pos = F.locate("<hr>", F.lower(c))
    cut = F.when(pos > 0, F.concat(F.substring(c, F.lit(1), pos - 1), F.lit("</td>"))).otherwise(c)
    return strip_markup(cut)


def sentence_pieces(col) -> Column:
    """Raw split pieces; each piece keeps the whitespace that precedes it,
    so cumulative lengths of the pieces are exact character offsets."""
    return F.split(_c(col), SENTENCE_BREAK, -1)


def split_sentences(col) -> Column:
    """Sentences as an array of trimmed, non-empty strings."""
    return F.filter(F.transform(sentence_pieces(col), lambda p: trim_ws(p)), lambda s: s != F.lit(""))


def tokens(col) -> Column:
    """Word tokens, case kept, the six one-character punctuation
    tokens dropped; brackets and quotes stay tokens."""
    return F.regexp_extract_all(_c(col), F.lit(WORD_PATTERN), 0)


def tokens_all(col) -> Column:
    """Tokens with punctuation kept (Jaccard tokenizer)."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), 0)


def tfidf_tokens(col) -> Column:
    """Lowercased runs of >= 2 word characters."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TFIDF_TOKEN_PATTERN), 0)


def remove_stopwords(tok_col, words) -> Column:
    """Drop tokens found in ``words`` (a small fixed list)."""
    words = list(words)
    return F.filter(_c(tok_col), lambda t: ~t.isin(words))


def word_count(col) -> Column:
    return F.size(tokens(col)).cast("long")


def lead_key(tok_col, n: int = 3) -> Column:
    """First ``n`` tokens, lowercased, joined by a space."""
    return F.lower(F.array_join(F.slice(_c(tok_col), 1, n), " "))


def _member_of(words):
    # ``isin`` over many literals becomes a hash-set lookup (InSet)
    words = list(words)
    return lambda t: t.isin(words)


def annotation_key(class_col, text_col) -> Column:
    """``class + '_' + lower(text)``."""
    return F.concat(_c(class_col), F.lit("_"), F.lower(_c(text_col)))


def author_of(identifier_col) -> Column:
    """Identifier prefix before the first ``/``."""
    return F.substring_index(_c(identifier_col), "/", 1)


def file_stem(path_col) -> Column:
    """Part of a file name before the first dot."""
    return F.element_at(F.split(_c(path_col), r"\."), 1)


def with_language(df, text_col: str, out_col: str, languages: dict[str, list[str]] | None = None):
    """Stop-word vote, as a column of ``df``.

    Counts the lowercased word tokens that belong to each language's list;
    the language with the most hits wins, ties go to the smaller language
    code, and a text without any hit gets NULL (detection failed).  Words,
    counts and winner are separate projections, so each is evaluated once.
    """
    languages = languages or fixed.LANGUAGE_WORDS
    codes = sorted(languages)
    w = df.withColumn("__words", F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{N}]+"), 0))
    # The place in the sorted list of codes decides ties, whatever the codes' length.
    w = w.withColumn("__best", F.array_max(F.array(*[
        F.struct(F.size(F.filter("__words", _member_of(languages[c]))).alias("hits"), F.lit(-i).alias("rank"), F.lit(c).alias("code"))
        for i, c in enumerate(codes)])))
    return w.withColumn(out_col, F.when(F.col("__best.hits") > 0, F.col("__best.code"))).drop("__words", "__best")
