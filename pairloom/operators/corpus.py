"""Corpus construction: monolingual tables, negatives, cleaning, split.

All languages are handled in one pass with ``lang`` as a column (the
per-language tables become partitions of one DataFrame).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import measures as M
from pairloom.functions import text as tx
from pairloom.operators.skew import ordered_prefix

LABELLED_COLUMNS = ["annotation_identifier", "url", "plagiat_sent", "source_sent", "bow_diff", "nb_words_ratio",
                    "isParaphrase", "lang"]


def monolingual(annotations: DataFrame, category: str = fixed.CATEGORY) -> DataFrame:
    """S12 + P3 + P4: one category, both sides in the same language (a NULL
    language drops the row, as SQL equality does)."""
    return annotations.where((F.col("type") == category) & (F.col("lang_plagiat") == F.col("lang_source"))).select(
        "annotation_identifier", "url", "plagiat_sent", "source_sent", "fake_source_sent",
        "lang_plagiat", "lang_source", "bow_diff", "nb_words_ratio",
    )


def monolingual_by_lang(mono: DataFrame, langs=tuple(fixed.CORPUS_LANGS), wr_min: float = fixed.RATIO_MIN,
                        wr_max: float = fixed.RATIO_MAX, bd_min: int = fixed.BOW_DIFF_MIN) -> DataFrame:
    """S13 + P5-P7 + P17: per-language positives with isParaphrase = 1."""
    m = mono.where(
        F.col("lang_plagiat").isin(list(langs)) & (F.col("lang_source") == F.col("lang_plagiat"))
        & (F.col("nb_words_ratio") > wr_min) & (F.col("nb_words_ratio") < wr_max) & (F.col("bow_diff") > bd_min)
    )
    return m.select(
        "annotation_identifier", "url", "plagiat_sent", "source_sent", "bow_diff", "nb_words_ratio",
        F.lit(1).alias("isParaphrase"), F.col("lang_plagiat").alias("lang"),
    )


def with_negatives(positives: DataFrame, mono: DataFrame) -> DataFrame:
    """C4: positives plus one negative per positive that has a fake source.

    J4 looks the fake source up by id among same-language monolingual rows;
    an id given to several rows counts once, with the row that is last by
    (url, plagiat, source, fake).  P11 skips empty ones, and the negative
    keeps the positive's measures (only id, source, label change).
    """
    fakes = mono.where(F.col("lang_plagiat") == F.col("lang_source")).groupBy(
        "annotation_identifier", F.col("lang_plagiat").alias("lang")).agg(
        F.max_by("fake_source_sent", F.struct("url", "plagiat_sent", "source_sent", "fake_source_sent")).alias("fake_source_sent"))
    neg = positives.join(fakes, ["annotation_identifier", "lang"], "inner").where(
        F.coalesce(F.col("fake_source_sent"), F.lit("")) != "")
    neg = neg.select(
        F.concat(F.col("annotation_identifier"), F.lit(fixed.NEGATIVE_SUFFIX)).alias("annotation_identifier"),
        "url", "plagiat_sent", F.col("fake_source_sent").alias("source_sent"), "bow_diff", "nb_words_ratio",
        F.lit(0).alias("isParaphrase"), "lang",
    )
    return positives.select(*LABELLED_COLUMNS).unionByName(neg)


def inner_identical_counts(labelled: DataFrame) -> DataFrame:
    """A5: rows skipped by P10 per (lang, label)."""
    return labelled.groupBy("lang", "isParaphrase").agg(
        F.count_if(M.inner_identical("plagiat_sent", "source_sent")).alias("skipped"),
        F.count("*").alias("total"),
    )


def drop_inner_identical(labelled: DataFrame) -> DataFrame:
    """P10: drop pairs where one lowercased side contains the other."""
    return labelled.where(~M.inner_identical("plagiat_sent", "source_sent"))


def train_test_split(labelled: DataFrame, test_share: float = fixed.TEST_SHARE) -> DataFrame:
    """Per (lang, label), rows in annotation_identifier order; the first
    floor(test_share * n) + 1 go to 'test' (all of them when n is small).

    Positions come from ``ordered_prefix``: one language may hold most rows
    and is still split across tasks.
    """
    r = ordered_prefix(labelled, ["lang", "isParaphrase"], ["annotation_identifier"])
    n_test = F.floor(F.lit(test_share) * F.col("pos_total")) + 1
    return r.withColumn("split", F.when(F.col("pos") <= n_test, F.lit("test")).otherwise(F.lit("train"))).drop(
        "pos", "pos_total")


def split_shape(split: DataFrame, keys=("plagiat_sent", "source_sent", "isParaphrase", "url")) -> DataFrame:
    """A5: frame shapes (rows, columns) per language and split."""
    return split.groupBy("lang", "split").agg(F.count("*").alias("n_rows")).withColumn(
        "n_cols", F.lit(len(keys)).cast("long"))


def corpus_export(split: DataFrame, date: str, keys=("plagiat_sent", "source_sent", "isParaphrase", "url")) -> DataFrame:
    """The rows of each split's export file with the file name they go
    to (``{lang}{date}_{split}.csv``; ``date`` unpadded, ``yyyy-M-d``)."""
    return split.select(
        "lang", "split", *keys,
        F.concat(F.col("lang"), F.lit(date), F.lit("_"), F.col("split"), F.lit(".csv")).alias("file_name"),
    )


def corpus_files(split: DataFrame, date: str, keys=("plagiat_sent", "source_sent", "isParaphrase", "url")) -> DataFrame:
    """The rows of all three files per language: train, test and the full
    ``{lang}{date}.csv``."""
    parts = corpus_export(split, date, keys).drop("lang", "split")
    full = split.select(*keys, F.concat(F.col("lang"), F.lit(date), F.lit(".csv")).alias("file_name"))
    return parts.unionByName(full)


def fragment_records(fragments: DataFrame) -> DataFrame:
    """What annotations take from their fragment, by url."""
    return fragments.select("url", "fragment_identifier", F.col("type").alias("category"),
                            tx.author_of("fragment_identifier").alias("author"))


def annotation_augmented(annotations: DataFrame, fragments: DataFrame) -> DataFrame:
    """Annotations enriched from their fragment by url (left join)."""
    return annotations.join(fragment_records(fragments), "url", "left")


def upsert_latest(old: DataFrame, new: DataFrame, key_cols: list[str], version_col: str) -> DataFrame:
    """Insert-or-update by key; the highest version wins, among equal
    versions the row that sorts last by its other columns.

    ``max_by`` per key is a hash aggregate with map-side partial
    aggregation, so a key updated many times is reduced before the shuffle.
    """
    u = old.unionByName(new)
    rest = [c for c in u.columns if c not in key_cols]
    g = u.groupBy(*key_cols).agg(F.max(F.struct(F.col(version_col).alias("__v"), F.struct(*rest).alias("__row"))).alias("__r"))
    return g.select(*key_cols, *[F.col("__r")["__row"][c].alias(c) for c in rest])


def fragment_tsv_projection(fragments: DataFrame) -> DataFrame:
    """S7 (legacy export) in a fixed column order; ``peer_reviewed`` is the
    reviewed flag as 0/1, not inverted."""
    return fragments.select(
        "url", "fragment_identifier", tx.author_of("fragment_identifier").alias("author"), "source_text",
        F.col("raw_source_text").alias("full_html"), F.col("type").alias("category"), "lang_source", "lang_plagiat",
        "plagiat_text", F.col("gesichtet").cast("int").alias("peer_reviewed"),
    )


def annotation_sheet(pairs: DataFrame, seed: str = "42", id_col: str = "annotation_identifier",
                     label_col: str | None = None) -> DataFrame:
    """The annotation sheet, pairs in a seeded shuffled order, four
    lines each: ``source,<src>`` / ``plag,<plag>`` / ``parahrase?,`` / blank.
    With ``label_col`` the third line is filled in."""
    shuffled = pairs.withColumn("rnd", F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col))))
    r = ordered_prefix(shuffled, [], ["rnd", id_col], totals=False)
    heads = fixed.SHEET_FIELDS
    label = F.coalesce(F.col(label_col).cast("string"), F.lit("")) if label_col else F.lit("")
    values = [F.col("source_sent"), F.col("plagiat_sent"), label, F.lit("")]
    lines = F.array(*[
        F.struct(F.lit(i).alias("line_no"), F.lit(h).alias("field"), v.alias("value"))
        for i, (h, v) in enumerate(zip(heads, values))
    ])
    return r.select((F.col("pos") - 1).alias("item_no"), F.explode(lines).alias("l")).select(
        "item_no", F.col("l.line_no").cast("long").alias("line_no"), "l.field", "l.value")
