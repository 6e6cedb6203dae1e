"""Sentence-pair operators: the minimum slice, the identical-sentence
removal (U7) and first-wins pair dedup (W5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import measures as M
from pairloom.functions import text as tx
from pairloom.sources import adapters


def with_measures(pairs: DataFrame, plag_tok="plag_tok", src_tok="src_tok") -> DataFrame:
    return pairs.withColumn("bow_diff", M.bow_difference(plag_tok, src_tok)).withColumn(
        "nb_words_ratio", M.word_ratio(plag_tok, src_tok)
    )


def candidate_pairs(documents: DataFrame, ratio_min: float = fixed.RATIO_MIN, ratio_max: float = fixed.RATIO_MAX,
                    bow_min: int = fixed.BOW_DIFF_MIN) -> DataFrame:
    """Minimum slice: sentences -> tokens -> lead-phrase pairs -> filters.

    P8 (5..40 tokens) and P9 (sides differ) inside ``lead_pairs``; then
    P6 (open ratio range), P7 (bow_diff > bow_min) and P10 (neither side
    contains the other, case-insensitive).
    """
    return measured_candidates(adapters.lead_pairs(documents), ratio_min, ratio_max, bow_min)


def measured_candidates(lead_pairs: DataFrame, ratio_min: float = fixed.RATIO_MIN, ratio_max: float = fixed.RATIO_MAX,
                        bow_min: int = fixed.BOW_DIFF_MIN) -> DataFrame:
    """The filters of the minimum slice over already built lead pairs."""
    p = with_measures(lead_pairs)
    p = p.where(
        (F.col("nb_words_ratio") > ratio_min) & (F.col("nb_words_ratio") < ratio_max)
        & (F.col("bow_diff") > bow_min)
        & ~M.inner_identical("plagiat_sent", "source_sent")
    )
    return p.select(
        "lang", "lead_key", "src_doc", "src_ix", "plag_doc", "plag_ix",
        "source_sent", "plagiat_sent", "bow_diff", "nb_words_ratio",
    )


def drop_identical_sentences(pairs: DataFrame, plag_col: str = "plagiat_sent", src_col: str = "source_sent") -> DataFrame:
    """Remove sentences that occur on both sides of a pair.

    Every plagiat sentence that also occurs among the source sentences is
    removed from the plagiat side (all its copies) and, copy for copy, from
    the source side (min(copies) removed, the first ones).  Remaining
    sentences are joined by one space.  When no sentence is shared, both
    strings stay untouched.  Both sides are short (P8), so this is an array
    expression inside the row: no shuffle and no pair id.
    """
    copies = lambda sents, x: F.size(F.filter(sents, lambda y: y == x))
    p = pairs.withColumns({"__p": tx.split_sentences(plag_col), "__s": tx.split_sentences(src_col)})
    keep_p = F.filter("__p", lambda x: ~F.array_contains("__s", x))
    keep_s = F.filter("__s", lambda x, i: copies(F.slice("__s", F.lit(1), i + 1), x) > copies(F.col("__p"), x))
    shared = F.arrays_overlap("__p", "__s")
    return p.withColumns({
        plag_col: F.when(shared, F.array_join(keep_p, " ")).otherwise(F.col(plag_col)),
        src_col: F.when(shared, F.array_join(keep_s, " ")).otherwise(F.col(src_col)),
    }).drop("__p", "__s")


def dedup_first(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row that is first in ``order_cols`` order.

    Done as ``min(struct(order..., row...))`` per key: a hash aggregate with
    map-side partial aggregation, so a key that repeats across a third of
    all rows is reduced to one row per map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in key_cols and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest]).alias("__first")
    g = df.groupBy(*key_cols).agg(F.min(packed).alias("__first"))
    return g.select(*[F.col(c) for c in key_cols], *[F.col("__first")[c].alias(c) for c in order_cols + rest]).select(
        *df.columns
    )
