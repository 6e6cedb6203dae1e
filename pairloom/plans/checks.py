"""Run counters and stopping checks.

Counters are gathered by ``Observation`` while a table is written, so no
counter costs a scan of its own; checks are expressions inside the plan that
end the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import measures as M
from pairloom.operators import corpus as Cp

COUNTERS = "counter string, lang string, n long"


def written_and_counted(df: DataFrame, store: Callable[[DataFrame], DataFrame], counts: dict[str, Column], keep: Column | None = None
                        ) -> tuple[DataFrame, dict[str, int]]:
    """``df`` (its rows that ``keep`` holds for) written by ``store``, and how many of all its rows each condition holds for.

    One pass: the conditions are counted where the rows pass on their way to the files.
    """
    seen = Observation()
    observed = df.observe(seen, *[F.count_if(c).alias(name) for name, c in counts.items()])
    out = store(observed if keep is None else observed.where(keep))
    return out, seen.get


def stop_unless(df: DataFrame, holds: Column, message: str) -> DataFrame:
    """``df``, in whose plan a row for which ``holds`` isn't true ends the run with ``message``."""
    return df.where(F.assert_true(F.coalesce(holds, F.lit(False)), message).isNull())


def paired_or_stop(left: DataFrame, right: DataFrame, keys: list[str], message: str) -> DataFrame:
    """P20: the join of two collections that must match row by row; a row of either without a partner ends the run."""
    a, b = left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True))
    return stop_unless(a.join(b, keys, "full"), F.col("__l") & F.col("__r"), message).drop("__l", "__r")


def labelled_corpus(annotations: DataFrame, store: Callable[[DataFrame], DataFrame], langs=tuple(fixed.CORPUS_LANGS)
                    ) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """(cleaned pairs, split, counters): C4, P10 and W4 with the run's figures.

    Counters per language: paraphrases and fake ones made, those skipped as
    inner identical, the rows of each split, and annotations that no language
    was found for (P18).  Each table is written once.
    """
    detected = {"errors": F.col("lang_plagiat").isNull() | F.col("lang_source").isNull()}
    mono, errors = written_and_counted(
        annotations, store, detected, (F.col("type") == fixed.CATEGORY) & (F.col("lang_plagiat") == F.col("lang_source")))
    mono = Cp.monolingual(mono)
    labelled = Cp.with_negatives(Cp.monolingual_by_lang(mono, langs), mono).withColumn("inner", M.inner_identical("plagiat_sent", "source_sent"))
    of, true, skipped = F.col("lang"), F.col("isParaphrase") == 1, F.col("inner")
    made = {}
    for x in langs:
        made |= {f"paraphrases|{x}": (of == x) & true, f"fake_paraphrases|{x}": (of == x) & ~true,
                 f"skipped_paraphrases|{x}": (of == x) & true & skipped, f"skipped_fake_paraphrases|{x}": (of == x) & ~true & skipped}
    cleaned, first = written_and_counted(labelled, store, made, ~skipped)
    cleaned = cleaned.drop("inner")
    parts = {f"{s}|{x}": (of == x) & (F.col("split") == s) for x in langs for s in ("train", "test")}
    split, second = written_and_counted(Cp.train_test_split(cleaned), store, parts)
    rows = [(name.split("|")[0], name.split("|")[1], n) for name, n in (first | second).items()]
    for x in langs:  # nothing got lost between the tables
        kept = sum(first[f"{p}|{x}"] - first[f"skipped_{p}|{x}"] for p in ("paraphrases", "fake_paraphrases"))
        if kept != second[f"train|{x}"] + second[f"test|{x}"]:
            raise RuntimeError(f"the splits of {x} don't add up to the cleaned pairs")
    return cleaned, split, [("errors", None, errors["errors"]), *rows]
