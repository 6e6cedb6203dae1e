"""T17, learnt: languages by naive Bayes over hashed character trigrams.

Training counts the trigrams of every labelled text by language in one
aggregation; a trigram is known by four hexadecimal digits of its MD5, so the
model has at most 65,536 rows whatever the corpus.  A text's score for a
language is the logarithm of its share of the labelled texts plus that of the
probability of each of its trigrams, one added to every count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a trigram's MD5, and the number of values they have.
DIGITS, BUCKETS = 4, 16 ** 4


def trigrams(text: Column) -> Column:
    """All runs of three signs of the lower-case letters, other signs being one blank; linear in the text."""
    letters = F.regexp_replace(F.lower(text), r"[\P{L}\x{10000}-\x{10FFFF}]+", " ")
    return F.regexp_extract_all(F.concat(F.lit(" "), letters, F.lit(" ")), F.lit("(?=(...))"), F.lit(1))


#: Signs of the texts that are worked on at once.
SIGNS = 1 << 19


def _letters(text: Column) -> Column:
    """A text as ``trigrams`` sees it: the letters in lower case, other signs being one blank, a blank at both ends."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\P{L}\x{10000}-\x{10FFFF}]+", " "), F.lit(" "))


def _batches(texts: pd.Series) -> Iterator[list[str]]:
    """The texts in lists of about SIGNS signs."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SIGNS:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Hashed:
    """Trigrams of texts as buckets; a trigram's MD5 is taken once while it is remembered."""

    def __init__(self):
        self.known: dict[int, int] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of every trigram of ``_letters`` texts."""
        signs = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        whole = of[2:] == of[:-2]  # runs over the end of a text are none
        grams = (signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:])[whole]
        distinct, each = np.unique(grams, return_inverse=True)
        if len(self.known) > 1 << 18:
            self.known.clear()
        buckets = np.empty(len(distinct), np.int64)
        for i, g in enumerate(distinct.tolist()):
            if g not in self.known:
                gram = chr(g >> 42) + chr(g >> 21 & 0x1FFFFF) + chr(g & 0x1FFFFF)
                self.known[g] = int(hashlib.md5(gram.encode("utf-8", "replace")).hexdigest()[:DIGITS], 16)
            buckets[i] = self.known[g]
        return of[2:][whole], buckets[each]


def _counted(labelled: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, bucket, n): the trigrams of a language, added up in the task."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, held = _Hashed(), {}
        for pdf in batches:
            for code, texts in pdf.groupby("lang", sort=False)["letters"]:
                for some in _batches(texts):
                    held[code] = held.get(code, 0) + np.bincount(hashed(some)[1], minlength=BUCKETS)
        for code, n in held.items():
            seen = np.flatnonzero(n)
            if len(seen):
                yield pd.DataFrame({"lang": code, "bucket": [f"{b:0{DIGITS}x}" for b in seen], "n": n[seen]})

    return labelled.select(F.col(lang).alias("lang"), _letters(F.col(text)).alias("letters")).mapInPandas(rows, "lang string, bucket string, n long")


def train(documents: DataFrame, store: Callable[[DataFrame], DataFrame], lang: str = "lang", text: str = "text") -> tuple[DataFrame, dict[str, tuple]]:
    """(model, languages): model rows (bucket, one log probability per language), and per language (column, prior, log probability of an unseen trigram).

    Texts without a language don't take part.  There is one column per language, so their number is that of labels in use.
    """
    labelled = documents.where(F.col(lang).isNotNull())
    # Equal trigrams of a language are added up in every task.
    counts = store(_counted(labelled, lang, text).groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    shares = {r[0]: r[1] for r in labelled.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    languages, columns = {}, []
    for i, code in enumerate(sorted(shares)):
        size = float(totals.get(code, 0) + BUCKETS)
        own = F.max(F.when(F.col("lang") == code, F.col("n")))
        columns.append(F.ln((F.coalesce(own, F.lit(0)) + 1.0) / size).alias(f"l{i}"))
        languages[code] = (f"l{i}", shares[code] / sum(shares.values()), 1.0 / size)
    if not languages:
        return counts.select("bucket").limit(0), {}
    return store(counts.groupBy("bucket").agg(*columns)), languages


def detect(documents: DataFrame, model: DataFrame, languages: dict[str, tuple], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, detected): the likeliest language, the smaller code among equals; null for texts without a letter.

    ``id_col`` must tell the texts apart.  The model has at most 65,536 rows, so it is sent to every task, which adds up its texts.
    """
    if not languages:
        return documents.select(id_col, F.lit(None).cast("string").alias("detected"))
    codes = list(languages)
    unseen = np.array([[np.log(languages[c][2])] for c in codes])
    table = np.repeat(unseen, BUCKETS, axis=1)
    for bucket, *logs in model.select("bucket", *[languages[c][0] for c in codes]).toLocalIterator():  # BUCKETS rows at most
        table[:, int(bucket, 16)] = logs
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logs, hashed = shared.value, _Hashed()
        for pdf in batches:
            parts = []
            for some in _batches(pdf["letters"]):
                of, bucket = hashed(some)
                parts.append([np.bincount(of, weights=row[bucket], minlength=len(some)) for row in logs])
            if parts:
                yield pd.DataFrame({"id": pdf["id"]} | dict(zip(columns, np.concatenate(parts, axis=1), strict=True)))

    columns = [languages[c][0] for c in codes]
    kind = documents.schema[id_col].dataType.simpleString()
    named = documents.where(F.col(id_col).isNotNull() & F.coalesce(text, F.lit("")).rlike(r"\p{L}"))
    found = named.select(F.col(id_col).alias("id"), _letters(F.col(text)).alias("letters"))
    found = found.mapInPandas(rows, f"id {kind}, " + ", ".join(f"{c} double" for c in columns))
    # Texts of one id are judged together.
    sums = found.groupBy(F.col("id").alias(id_col)).agg(*[(F.sum(c) + F.ln(F.lit(prior))).alias(c) for c, prior, _ in languages.values()])
    best = F.array_max(F.array(*[F.struct(F.col(c).alias("score"), F.lit(-i).alias("rank"), F.lit(code).alias("code"))
                                 for i, (code, (c, _, _)) in enumerate(languages.items())]))
    return documents.select(id_col).join(sums.select(id_col, best["code"].alias("detected")), id_col, "left")


def held_out(id_col: Column) -> Column:
    """The rows that are kept from training: those whose id's MD5 begins with 0, 1 or 2."""
    return F.substring(F.md5(id_col.cast("string")), 1, 1).isin("0", "1", "2")
