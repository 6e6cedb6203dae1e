"""Fragments -> annotation table (sentence pairs with measures and a
fake source), the composite the span matcher runs per fragment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import text as tx
from pairloom.operators import negatives as N
from pairloom.operators import pairs as P
from pairloom.operators import spans as S


def filtered_pairs(paired: DataFrame, words_min: int = fixed.WORDS_MIN, words_max: int = fixed.WORDS_MAX) -> DataFrame:
    """P9 (sides differ) then P8 (both sides 5..40 tokens)."""
    p = paired.where(F.col("plagiat_sent") != F.col("source_sent"))
    return p.where(
        tx.word_count("plagiat_sent").between(words_min, words_max)
        & tx.word_count("source_sent").between(words_min, words_max)
    )


def _identity(df: DataFrame) -> DataFrame:
    return df


def build_annotations(fragments: DataFrame, seed: str = N.SEED, cut=_identity,
                      matched: S.Matched | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``cut`` materializes shared intermediates (see ``stages.materialize``);
    ``matched`` reuses span-matcher results computed before."""
    m = matched if matched is not None else S.match_fragments(fragments, cut)
    pairs = filtered_pairs(m["paired"])
    pairs = cut(P.drop_identical_sentences(pairs))
    index = N.fake_source_index(m.source_sentences, cut=cut)
    with_fake = N.pick_fake_sources(pairs, index, seed=seed)
    with_fake = with_fake.withColumn("p_tok", tx.tokens("plagiat_sent")).withColumn("s_tok", tx.tokens("source_sent"))
    measured = P.with_measures(with_fake, "p_tok", "s_tok").drop("p_tok", "s_tok")
    # A (plagiat, source) pair already stored from an earlier fragment or pair is skipped
    deduped = P.dedup_first(measured.select("plagiat_sent", "source_sent", "url", "i", "fake_source_sent",
                                            "bow_diff", "nb_words_ratio"),
                            ["plagiat_sent", "source_sent"], ["url", "i"])
    f = fragments.select("url", "fragment_identifier", "lang_source", "lang_plagiat", "type")
    ann = deduped.join(f, "url").select(
        F.concat(F.col("fragment_identifier"), F.lit("_"), F.col("i").cast("string")).alias("annotation_identifier"),
        "url", "plagiat_sent", "source_sent", "fake_source_sent", "lang_source", "lang_plagiat", "type",
        "nb_words_ratio", "bow_diff",
    )
    # A stored annotation is keyed by its identifier: one that comes again (page titles can repeat) replaces the earlier row.
    ann = ann.withColumn("__n", F.element_at(F.split("annotation_identifier", "_"), -1).cast("long"))
    rest = [c for c in ann.columns if c not in ("annotation_identifier", "url", "__n")]
    last = F.max(F.struct("url", "__n", *rest)).alias("__r")
    ann = ann.groupBy("annotation_identifier").agg(last).select("annotation_identifier", "__r.url", *[f"__r.{c}" for c in rest])
    m.update({"u7_pairs": pairs, "fake_index": index, "with_fake": with_fake})
    return ann, m
