"""Learnt sentence boundaries (T11, T12): statistics of a corpus that veto splits.

Which words are abbreviations is learnt without labels, after Kiss and Strunk
(2006): an abbreviation stands with a full stop nearly always, is short, often
has stops inside, and its bare form is rare.  The strength of the tie between a
word and its stop is a log-likelihood ratio over the corpus.  Numbers and
single letters keep their stop, too, where a log-likelihood ratio ties them to
the word after it ("3. Mai").  A split after such a word is taken back.

Counting is one pass over the texts with map-side combine.  The learnt
tables are joined to the pieces of the texts by their last word; the planner
broadcasts them while they are small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import text as tx

#: A word with the stops in and after it.
WORD = r"[\p{L}\p{N}][\p{L}\p{N}.]*"
#: Least score of an abbreviation, least log-likelihood ratio of a collocation, least number of times one is seen (as published).
ABBREVIATION, COLLOCATION, SEEN = 0.3, 7.88, 2
NUMBER_OR_INITIAL = r"^([0-9]+|\p{L})$"


def bare(word: Column) -> Column:
    """A word's type: lower case, without the stops after it."""
    return F.lower(F.regexp_replace(word, r"\.+$", ""))


def tallies(documents: DataFrame, text: str = "text") -> DataFrame:
    """(word, next, n): how often a word stands; ``next`` is the word after it where that may be a collocation, else null.

    The one pass over the texts: equal words are added up in the task, and
    their types are taken of what is left.
    """
    w = documents.select(F.regexp_extract_all(text, F.lit(WORD), 0).alias("w"))
    may = lambda x: F.endswith(x, F.lit(".")) & bare(x).rlike(NUMBER_OR_INITIAL)
    pair = F.transform("w", lambda x, i: F.struct(x.alias("word"), F.when(may(x), F.get("w", i + 1)).alias("next")))
    return w.select(F.explode(pair).alias("p")).groupBy("p.word", "p.next").agg(F.count(F.lit(1)).alias("n"))


def _x_ln_y(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.ln(y)).otherwise(F.lit(0.0))


def _counts(words: DataFrame) -> DataFrame:
    stop = F.when(F.endswith("word", F.lit(".")), F.col("n")).otherwise(F.lit(0))
    return words.select(bare(F.col("word")).alias("type"), "n", stop.alias("s")).groupBy("type").agg(F.sum("n").alias("n"), F.sum("s").alias("n_stop"))


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """(type, n, n_stop): how often a word stands, and how often with a stop."""
    return _counts(tallies(documents, text))


def abbreviations(counts: DataFrame, least: float = ABBREVIATION) -> DataFrame:
    """(type, n, n_stop, score) of the learnt abbreviations, from ``word_counts``."""
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_stop").alias("s")).first()
    chance = (total["s"] or 0) / total["n"] if total["n"] else 0.0
    if not 0 < chance < 1:
        return counts.withColumn("score", F.lit(0.0)).limit(0)
    with_, without = F.col("n_stop").cast("double"), (F.col("n") - F.col("n_stop")).cast("double")
    by_chance = with_ * F.ln(F.lit(chance)) + without * F.ln(F.lit(1 - chance))
    by_rule = with_ * F.ln(F.lit(0.99)) + without * F.ln(F.lit(1 - 0.99))
    size = F.length(F.regexp_replace("type", r"\.", "")).cast("double")
    inner = F.length("type") - size + 1
    score = -2 * (by_chance - by_rule) * F.exp(-size) * inner * F.pow(size, -without)
    return counts.where((F.col("n_stop") > 0) & ~F.col("type").rlike("^[0-9.]+$")).withColumn("score", score).where(F.col("score") >= least)


def collocations(documents: DataFrame, counts: DataFrame, text: str = "text", least: float = COLLOCATION) -> DataFrame:
    """(type, next, n, ratio): numbers and initials with a stop, and the words that are tied to them."""
    return _collocations(tallies(documents, text), counts, least)


def _collocations(words: DataFrame, counts: DataFrame, least: float = COLLOCATION) -> DataFrame:
    total = counts.agg(F.sum("n")).first()[0] or 0
    p = words.where(F.col("next").isNotNull()).select(bare(F.col("word")).alias("type"), bare(F.col("next")).alias("next"), "n")
    p = p.groupBy("type", "next").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN)
    p = (p.join(counts.select("type", F.col("n").cast("double").alias("a")), "type")
         .join(counts.select(F.col("type").alias("next"), F.col("n").cast("double").alias("b")), "next"))
    ab, a, b, n = F.col("n").cast("double"), F.col("a"), F.col("b"), F.lit(float(total))
    at_all, here, elsewhere = b / n, ab / a, (b - ab) / (n - a)
    rest = n - a - b + ab
    alike = _x_ln_y(b, at_all) + _x_ln_y(n - b, 1 - at_all)
    apart = _x_ln_y(ab, here) + _x_ln_y(a - ab, 1 - here) + _x_ln_y(b - ab, elsewhere) + _x_ln_y(rest, 1 - elsewhere)
    return p.where(n > a).withColumn("ratio", 2 * (apart - alike)).where((F.col("ratio") >= least) & (here > at_all)).select("type", "next", "n", "ratio")


def learn(documents: DataFrame, text: str, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The stored tables of abbreviations and collocations of a corpus."""
    words = store(tallies(documents, text))
    counts = store(_counts(words))
    return store(abbreviations(counts)), store(_collocations(words, counts))


def learnt_sentences(documents: DataFrame, abbreviated: DataFrame, tied: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ix, start, end, sent): T12's sentences, without the splits that the learnt tables veto.

    Windows run over the pieces of one text.
    """
    p = documents.repartition(F.col(id_col)).select(id_col, F.posexplode(tx.sentence_pieces(text)).alias("pi", "piece"))
    along = Window.partitionBy(id_col).orderBy("pi")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    # No word holds a blank: the last one is looked for behind the last blank only.
    p = p.withColumn("type", bare(F.regexp_extract(F.substring_index("piece", " ", -1), f"({WORD})$", 1)))
    p = p.withColumn("next", bare(F.lead(F.regexp_extract("piece", WORD, 0)).over(along)))
    p = p.withColumn("type", F.when(F.endswith("piece", F.lit(".")) & (F.col("type") != ""), F.col("type")))
    p = (p.join(abbreviated.select("type", F.lit(True).alias("short")), "type", "left")
         .join(tied.select("type", "next", F.lit(True).alias("tied")), ["type", "next"], "left"))
    p = p.withColumn("ends", F.when(F.col("short").isNull() & F.col("tied").isNull(), 1).otherwise(0))
    p = p.withColumn("part", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    whole = p.groupBy(id_col, "part").agg(
        F.min("at").alias("at"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pi", "piece"))), lambda x: x["piece"]), "").alias("raw"))
    whole = whole.withColumn("sent", tx.trim_ws("raw")).where(F.col("sent") != "")
    start = F.col("at") + F.length("raw") - F.length(F.regexp_replace("raw", "^" + tx.WS + "+", ""))
    whole = whole.withColumn("start", start.cast("long"))
    return whole.select(
        id_col, (F.row_number().over(Window.partitionBy(id_col).orderBy("part")) - 1).cast("long").alias("ix"), "start",
        (F.col("start") + F.length("sent")).cast("long").alias("end"), "sent")
