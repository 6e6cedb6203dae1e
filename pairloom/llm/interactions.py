"""Filter interaction audit by a Gray-code walk over the subsets of filters.

What every order of a set of filters removes follows from what survives each
subset of them, so no order is ever run over the documents.

1. Every row gets a mask of the filters it fails.  Rows are counted by part
   and mask (a cell: rows, and rows of each outcome) in one aggregation with
   map-side combine: at most 2^k cells a part, whatever the number of rows.
2. Per part the 2^k subsets are walked in Gray-code order, which toggles one
   filter at a time.  Each cell keeps a counter of the active filters it
   fails; a cell whose counter leaves or reaches zero leaves or joins the
   running survivors.  The survivors of each subset are stored.
3. An order of filters is a chain of subsets; a step's figures are the
   difference of two stored states.

The last filter compares texts over the whole table.  Texts are known by
their SHA-256.  Equal narrow rows are counted first, then the smallest doc_id
of every text is taken by an aggregation, and the rows that hold it are found
by a join on (text, doc_id), so a text of a third of all rows is never one
key's work.

Defined results: a null text is empty; an empty text has no words and fails
A only (and E, if an earlier document is empty, too); a null lang is the part
''; a row without doc_id neither fails E nor makes others fail it, and has no
labels; rows that share a doc_id are counted each; of several label rows of a
doc_id the largest values count, null labels count as 0; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
#: Failure conditions of one text; E, which needs the whole table, is added by ``document_masks``.
ROW_FILTERS = "ABCD"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def row_filters(text: Column) -> dict[str, Column]:
    """Whether a text fails A (under 100 words), B (under 80 % of them distinct), C (over 10 % capitals), D (markup signs)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    distinct, n = F.size(F.array_distinct(words)), F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def masked(fails: dict[str, Column]) -> Column:
    """Bit i is set where the i-th filter fails."""
    out = F.lit(0)
    for i, c in enumerate(fails.values()):
        out = out + F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def document_masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part and outcome fail just the filters of the mask."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), masked(row_filters(text)).alias("mask"))
    rows = store(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "audit_rows")
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    fails_e = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << len(ROW_FILTERS)).otherwise(0)
    return (rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .groupBy("part", (F.col("mask") + fails_e).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
                     F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n")))


def gray_walk(masks: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """states[s]: the column sums of ``counts`` over the cells that fail no filter of the subset s."""
    states = np.zeros((1 << k, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)  # active filters that a cell fails
    alive = counts.sum(axis=0)
    subset = 0
    states[0] = alive
    for step in range(1, 1 << k):
        toggled = (step & -step).bit_length() - 1  # the bit in which two neighbours of the Gray code differ
        subset ^= 1 << toggled
        hit = (masks >> toggled) & 1 == 1
        if subset >> toggled & 1:
            alive = alive - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + counts[hit & (failing == 0)].sum(axis=0)
        states[subset] = alive
    return states


def step_figures(masks: np.ndarray, counts: np.ndarray, names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step.

    ``counts`` has the columns rows, good rows, toxic rows.
    """
    k = len(names)
    states = gray_walk(masks, counts, k)
    fails = [int(counts[(masks >> f) & 1 == 1, 0].sum()) for f in range(k)]
    unique = [int(counts[masks == 1 << f, 0].sum()) for f in range(k)]
    shapley = [0] * k  # a subset s stands before f in |s|! (k - 1 - |s|)! orders
    for f in range(k):
        for s in range(1 << k):
            if not s >> f & 1:
                size = s.bit_count()
                shapley[f] += factorial(size) * factorial(k - 1 - size) * int(states[s, 0] - states[s | 1 << f, 0])
    out = []
    for order in permutations(range(k)):
        subset = 0
        for step, f in enumerate(order, 1):
            before, after = states[subset], states[subset | 1 << f]
            lost = before - after
            out.append(("".join(names[i] for i in order), step, int(after[0]), int(lost[0]), fails[f] - int(lost[0]), unique[f],
                        int(lost[1]), int(lost[2]), shapley[f]))
            subset |= 1 << f
    return out


def interactions(cells: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, good, toxic, n) cells."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:  # at most 4 * 2^k rows of one part
        n = pdf["n"].to_numpy(np.int64)
        counts = np.stack([n, n * pdf["good"].to_numpy(np.int64), n * pdf["toxic"].to_numpy(np.int64)], axis=1)
        rows = step_figures(pdf["mask"].to_numpy(np.int64), counts, names)
        return pd.DataFrame([(pdf["part"].iloc[0], *r) for r in rows], columns=["part", "filter_order", "step", *FIGURES])

    return cells.groupBy("part").applyInPandas(
        walk, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in FIGURES))


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(document_masks(documents, labels), ROW_FILTERS + "E")
