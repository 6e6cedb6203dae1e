"""Toxicity: a factorization machine over hashed terms.

score(x) = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the hashed
terms present in a text: its lower-cased words and their prefixes, so that
compounds share a stem.  The pairwise part learns combinations (an insult
next to the mention of a group) that no additive weight can express.

The model is fitted on a bounded sample of labelled rows (``sample``, the
rows of smallest hash, so the same rows at any partitioning).  Of the terms in
at least ``min_docs`` sampled texts those enter it that are associated with
the label (log-likelihood ratio over ``min_llr``), and both words of every
pair that is: words of at most ``PAIR_SPAN`` words' distance whose joint
presence is associated by ``pair_llr`` more than either alone.  So two words
that tell nothing by themselves are learnt as well.  Pairs are counted in a
hashed table of fixed size in every task; only the pairs of telling cells are
counted by name.  Fitting is mini-batch Adagrad on the driver: its input is
bounded by the sample, its result by ``BUCKETS``.  Scoring reads every whole
text once, in Arrow batches, without a shuffle.

Defined results: null, empty and wordless texts have no terms and score the
base rate (they are never predicted toxic while that is under the threshold);
labels that are null or contradict each other for one doc_id are left out of
the sample; without any usable label the score is 0 for every text; of several
texts under one doc_id the one of smallest MD5 is learnt from, whatever the
order of rows, and each is scored.  Further columns are ignored; repeated rows
give repeated results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import BLOCK_ROWS, TEXT_ROWS, mix, slices, store
from pairloom.session import batches_of

#: Hash space of the terms.
BUCKETS = 1 << 22
PREFIXES = (3, 4, 5, 6)
#: Words whose terms a task remembers: most words of a large table come once.
KNOWN_WORDS = 50_000
_DIVIDE = bytes.maketrans(bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)),
                          b" " * (0x30 + 0x27 + 5))


def words(text: str | None) -> list[str]:
    raw = (text or "").lower().encode("utf-8", "replace").translate(_DIVIDE)
    return raw.decode("utf-8").split()


def terms(word: str) -> list[int]:
    """Hashed terms of a word: itself and its proper prefixes."""
    own = [("=" + word)] + [word[:k] for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(t.encode()) % BUCKETS for t in own]


@dataclass
class Machine:
    """The fitted model: ``buckets`` (sorted) with weights ``w`` and factors ``v``."""

    bias: float
    buckets: np.ndarray
    w: np.ndarray
    v: np.ndarray

    @cached_property
    def index(self) -> dict[int, int]:
        return {int(b): i for i, b in enumerate(self.buckets)}

    def raw(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """Scores before the sigmoid; rows, cols: document and term index of each presence."""
        out = np.full(n, self.bias)
        if len(cols):
            np.add.at(out, rows, self.w[cols])
            s, q = np.zeros((n, self.v.shape[1])), np.zeros(n)
            np.add.at(s, rows, self.v[cols])
            np.add.at(q, rows, (self.v[cols] ** 2).sum(axis=1))
            out += 0.5 * ((s ** 2).sum(axis=1) - q)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _presences(texts, index: dict | None, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of each term present, once per row; ``index`` maps buckets to model positions."""
    rows, cols = [], []
    for i, text in enumerate(texts):
        got = set()
        for w in set(words(text)):
            t = known.get(w)
            if t is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                t = terms(w) if index is None else [index[b] for b in terms(w) if b in index]
                known[w] = t
            got.update(t)
        rows.append(np.full(len(got), i))
        cols.append(np.fromiter(got, np.int64, len(got)))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(cols)


def _llr(a, b, pos, neg):
    """Log-likelihood ratio of term presence (a of pos, b of neg)."""
    def h(k, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / n), 0.0) + np.where(n - k > 0, (n - k) * np.log((n - k) / n), 0.0)
    return 2 * (h(a, pos) + h(b, neg) - h(a + b, pos + neg))


#: Sampled texts a term must be in, and its least log-likelihood ratio.
MIN_DOCS, MIN_LLR = 3, 12.0
#: Sampled texts a pair (and each of its words) must be in, what its ratio must be over those of its words, their greatest
#: distance, and the cells of the hashed pair counts.
PAIR_DOCS, PAIR_LLR, PAIR_SPAN, PAIR_CELLS = 20, 30.0, 16, 1 << 22
#: Tasks that count pairs, the pairs a task holds before it passes them on, and the rows and cells that it passes on at once.
PAIR_TASKS, PAIRS_HELD, PAIR_ROWS, PAIR_BLOCK = 16, 1 << 20, 100_000, 1 << 14


def telling(a: np.ndarray, b: np.ndarray, pos: float, neg: float, min_docs: int = MIN_DOCS, min_llr: float = MIN_LLR) -> np.ndarray:
    """Which terms (in a of pos toxic and b of neg other texts) enter the model."""
    keep = a + b >= min_docs
    keep[keep] = _llr(a[keep].astype(float), b[keep].astype(float), pos, neg) >= min_llr
    return keep


def fit(rows: np.ndarray, buckets: np.ndarray, y: np.ndarray, factors: int = 8, epochs: int = 40, rate: float = 0.2,
        l2: float = 1e-5, min_docs: int = MIN_DOCS, min_llr: float = MIN_LLR, seed: int = 7,
        paired: np.ndarray | None = None) -> Machine:
    """Fit on presences (row, bucket) of a bounded sample with labels ``y``; buckets ``paired`` enter in any case."""
    n, pos = len(y), float(y.sum())
    if n == 0 or pos in (0.0, float(n)):
        return Machine(40.0 if n and pos else -40.0, np.empty(0, np.int64), np.empty(0), np.empty((0, factors)))
    uniq, at = np.unique(buckets, return_inverse=True)
    a = np.bincount(at, weights=y[rows], minlength=len(uniq))
    keep = telling(a, np.bincount(at, minlength=len(uniq)) - a, pos, n - pos, min_docs, min_llr)
    if paired is not None:
        keep |= np.isin(uniq, paired)
    new = np.cumsum(keep) - 1
    sel = keep[at]
    rows, cols = rows[sel], new[at[sel]]
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    start = np.searchsorted(rows, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    k = int(keep.sum())
    m = Machine(float(np.log(pos / (n - pos))), uniq[keep], np.zeros(k), rng.normal(0, 0.02, (k, factors)))
    gw, gv, gb = np.full(k, 1e-6), np.full((k, factors), 1e-6), 1e-6
    for _ in range(epochs):
        perm = rng.permutation(n)
        for part in np.array_split(perm, max(1, n // 256)):
            lens = start[part + 1] - start[part]
            r = np.repeat(np.arange(len(part)), lens)
            c = cols[np.repeat(start[part] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())]
            s = np.zeros((len(part), factors))
            np.add.at(s, r, m.v[c])
            err = sigmoid(m.raw(r, c, len(part))) - y[part]
            g = err.mean()
            gb += g * g
            m.bias -= rate * g / np.sqrt(gb)
            if not len(c):
                continue
            u, inv = np.unique(c, return_inverse=True)
            dw, dv = np.zeros(len(u)), np.zeros((len(u), factors))
            np.add.at(dw, inv, err[r])
            np.add.at(dv, inv, err[r][:, None] * (s[r] - m.v[c]))
            dw, dv = dw / len(part) + l2 * m.w[u], dv / len(part) + l2 * m.v[u]
            gw[u] += dw ** 2
            gv[u] += dv ** 2
            m.w[u] -= rate * dw / np.sqrt(gw[u])
            m.v[u] -= rate * dv / np.sqrt(gv[u])
    return m


def near_pairs(sequence: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (smaller, larger) buckets of frequent words at most ``PAIR_SPAN`` words apart."""
    at = np.flatnonzero(frequent[sequence])
    seq = sequence[at].astype(np.int64)
    keys = [np.empty(0, np.int64)]
    for d in range(1, min(PAIR_SPAN, len(seq) - 1) + 1):
        a, b = seq[:-d], seq[d:]
        near = (at[d:] - at[:-d] <= PAIR_SPAN) & (a != b)
        keys.append(np.unique(np.minimum(a, b)[near] * BUCKETS + np.maximum(a, b)[near]))
    both = np.unique(np.concatenate(keys))
    return both // BUCKETS, both % BUCKETS


def _cell(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix((a * BUCKETS + b).astype(np.uint64)) % np.uint64(PAIR_CELLS)).astype(np.int64)


def counted_pairs(batches: Iterator[pd.DataFrame], frequent: np.ndarray, chosen: np.ndarray) -> Iterator[pd.DataFrame]:
    """(a, b, y, n): the near pairs of chosen cells, texts of a label that name the same pair added up (over ``PAIRS_HELD`` pairs at least)."""
    held, many, fresh, n_fresh = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([held, *fresh]), return_inverse=True)
        n = np.concatenate([many, np.ones(len(at) - len(many), np.int64)])
        return keys, np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)

    def rows() -> Iterator[pd.DataFrame]:
        for i in range(0, max(1, len(held)), PAIR_ROWS):
            own, pair = held[i:i + PAIR_ROWS], held[i:i + PAIR_ROWS] >> 1
            yield pd.DataFrame({"a": pair // BUCKETS, "b": pair % BUCKETS, "y": (own & 1).astype(np.int32), "n": many[i:i + PAIR_ROWS]})

    for pdf in batches:
        for y, raw in zip(pdf["y"], pdf["sequence"], strict=True):
            a, b = near_pairs(np.frombuffer(raw, "<i4"), frequent)
            hit = chosen[_cell(a, b)]
            fresh.append((a[hit] * BUCKETS + b[hit]) * 2 + int(y))
            n_fresh += len(fresh[-1])
            if len(fresh) >= 256 or n_fresh >= PAIRS_HELD:
                held, many = added()
                fresh, n_fresh = [], 0
                if len(held) >= PAIRS_HELD:
                    yield from rows()
                    held, many = held[:0], many[:0]
    held, many = added()
    yield from rows()


def counted_cells(batches: Iterator[pd.DataFrame], frequent: np.ndarray) -> Iterator[pd.DataFrame]:
    """(block, data): how many texts of each label name a pair of a cell, ``PAIR_BLOCK`` cells a row."""
    table = np.zeros((2, PAIR_CELLS), np.int32)
    for pdf in batches:
        for y, raw in zip(pdf["y"], pdf["sequence"], strict=True):
            np.add.at(table[int(y)], _cell(*near_pairs(np.frombuffer(raw, "<i4"), frequent)), 1)
    for block in range(PAIR_CELLS // PAIR_BLOCK):
        own = table[:, block * PAIR_BLOCK:(block + 1) * PAIR_BLOCK]
        if own.any():
            yield pd.DataFrame({"block": np.array([block], np.int32), "data": [own.astype("<i4").tobytes()]})


def told_cells(batches: Iterator[pd.DataFrame], sizes: list[int], pair_docs: int, pair_llr: float) -> Iterator[pd.DataFrame]:
    """(block, told): bits of the telling cells of whole blocks, what was counted of a block added up."""
    held: dict[int, np.ndarray] = {}
    for pdf in batches:
        for block, data in zip(pdf["block"], pdf["data"], strict=True):
            got = np.frombuffer(data, "<i4").reshape(2, -1)
            held[block] = held[block] + got if block in held else got
    for block, (clean, toxic) in held.items():
        at = np.flatnonzero(clean + toxic >= pair_docs)
        llr = _llr(toxic[at].astype(float), clean[at].astype(float), float(sizes[1]), float(sizes[0]))
        told = np.zeros(PAIR_BLOCK, bool)
        told[at[llr >= pair_llr]] = True
        yield pd.DataFrame({"block": np.array([block], np.int32), "told": [np.packbits(told).tobytes()]})


def telling_pairs(features: DataFrame, counts: np.ndarray, sizes: list[int], pair_docs: int, pair_llr: float) -> np.ndarray:
    """Buckets of the words of pairs associated with the label beyond either word.

    ``features``: y and sequence (word buckets in order); ``counts``: texts of
    each label that hold a bucket.
    """
    spark = features.sparkSession
    frequent = spark.sparkContext.broadcast(counts.sum(axis=0) >= pair_docs)  # BUCKETS booleans

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from counted_cells(batches, frequent.value)

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from told_cells(batches, sizes, pair_docs, pair_llr)

    # The texts are a bounded sample: few tasks, so that what every task counted adds up to few rows.
    texts = features.select("y", "sequence").coalesce(PAIR_TASKS)
    # Cells travel as blocks of counts: a row a cell fills the executors' heaps with aggregation tables.
    counted = texts.mapInPandas(cells, "block int, data binary").repartition(PAIR_TASKS, "block")
    table = np.zeros(PAIR_CELLS, bool)
    with batches_of(spark, BLOCK_ROWS):
        for r in counted.mapInPandas(told, "block int, told binary").collect():  # PAIR_CELLS bits at most
            table[r["block"] * PAIR_BLOCK:(r["block"] + 1) * PAIR_BLOCK] = np.unpackbits(np.frombuffer(r["told"], np.uint8))
    if not table.any():
        return np.empty(0, np.int64)
    chosen = spark.sparkContext.broadcast(table)  # PAIR_CELLS booleans

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from counted_pairs(batches, frequent.value, chosen.value)

    pairs = texts.mapInPandas(named, "a long, b long, y int, n long").groupBy("a", "b").agg(
        F.sum((1 - F.col("y")) * F.col("n")).alias("clean"), F.sum(F.col("y") * F.col("n")).alias("toxic")).filter(F.col("clean") + F.col("toxic") >= pair_docs)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"pairs": [pdf[["a", "b", "clean", "toxic"]].to_numpy("<i8").tobytes()]})

    words_of = np.zeros(BUCKETS, bool)
    pos, neg = float(sizes[1]), float(sizes[0])
    for r in pairs.mapInPandas(packed, "pairs binary").toLocalIterator():
        got = np.frombuffer(r["pairs"], "<i8").reshape(-1, 4)
        ends = got[:, :2]
        alone = _llr(counts[1][ends].astype(float), counts[0][ends].astype(float), pos, neg).max(axis=1)
        beyond = _llr(got[:, 3].astype(float), got[:, 2].astype(float), pos, neg) >= alone + pair_llr
        words_of[ends[beyond].ravel()] = True
    return np.flatnonzero(words_of)


def train(documents: DataFrame, labels: DataFrame, sample: int = 12_000, label: str = "toxic", min_docs: int = MIN_DOCS,
          min_llr: float = MIN_LLR, pair_docs: int = PAIR_DOCS, pair_llr: float = PAIR_LLR, **settings) -> Machine:
    """Fit on at most ``sample`` labelled documents."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
         .filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("m"))
         .filter("y = m").select("doc_id", "y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    y = store(y, "fm_sample")

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for pdf in batches:
            pdf = pdf.assign(digest=[hashlib.md5((t or "").encode("utf-8", "replace")).digest() for t in pdf["text"]])
            pdf = pdf.sort_values(["doc_id", "digest"], kind="stable").drop_duplicates("doc_id")
            for part in slices(pdf):
                rows, cols = _presences(part["text"], None, known)
                cut = np.searchsorted(rows, np.arange(len(part) + 1))
                cols = cols.astype("<i4")
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "y": part["y"], "digest": part["digest"],
                    "terms": [np.sort(cols[cut[i]:cut[i + 1]]).tobytes() for i in range(len(part))],
                    "sequence": [np.array([terms(w)[0] for w in words(t)], "<i4").tobytes() for t in part["text"]]})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample has at most ``sample`` rows, so it may be broadcast: other texts never reach Python.
    found = docs.join(F.broadcast(y), "doc_id").mapInPandas(featurize, "doc_id long, y int, digest binary, terms binary, sequence binary")
    one = found.groupBy("doc_id").agg(F.min(F.struct("digest", "y", "terms", "sequence")).alias("f"))
    # As few files as there are tasks that read them.
    got = store(one.select("doc_id", "f.y", "f.terms", "f.sequence").coalesce(PAIR_TASKS), "fm_terms", TEXT_ROWS)

    def sampled() -> Iterator[tuple[int, np.ndarray]]:
        for r in got.select("doc_id", "y", "terms").orderBy("doc_id").toLocalIterator():
            yield r["y"], np.frombuffer(r["terms"], "<i4")

    # Two passes: counts in arrays of fixed size, then only the terms that enter.
    counts, sizes = np.zeros((2, BUCKETS), np.int32), [0, 0]
    for label_of, terms_of in sampled():
        counts[label_of][terms_of] += 1
        sizes[label_of] += 1
    if not all(sizes):
        return fit(np.empty(0, np.int64), np.empty(0, np.int64), np.array([1.0] * bool(sizes[1])))
    paired = telling_pairs(got, counts, sizes, pair_docs, pair_llr)
    keep = telling(counts[1], counts[0], sizes[1], sizes[0], min_docs, min_llr)
    keep[paired] = True
    rows, cols, y_of = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for label_of, terms_of in sampled():
        cols.append(terms_of[keep[terms_of]].astype(np.int64))
        rows.append(np.full(len(cols[-1]), len(y_of)))
        y_of.append(label_of)
    return fit(np.concatenate(rows), np.concatenate(cols), np.array(y_of, float), min_docs=min_docs, min_llr=min_llr, paired=paired, **settings)


def scores(texts: pd.Series, machine: Machine, known: dict) -> np.ndarray:
    """The scores of a batch of texts; terms and factors are held for a slice of it."""
    out = [np.empty(0)]
    for part in slices(texts.to_frame("text")):
        rows, cols = _presences(part["text"], machine.index, known)
        out.append(sigmoid(machine.raw(rows, cols, len(part))))
    return np.concatenate(out)


def score(documents: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= threshold) of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(machine)  # bounded by BUCKETS

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, known = shared.value, {}
        for pdf in batches:
            s = scores(pdf["text"], m, known)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": s, "predicted": (s >= threshold).astype("int32")})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(scored, "doc_id long, score double, predicted int")


def held_out(doc_id) -> Column:
    """Rows never learnt from: crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """doc_id, held_out, score, predicted for all documents."""
    machine = train(documents, labels.filter(~held_out("doc_id")), **settings)
    return score(documents, machine, threshold).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """The documents (all their columns) that aren't predicted toxic.

    Scoring is by row: a text is judged where it stands, without a join.
    """
    machine = train(documents, labels.filter(~held_out("doc_id")), **settings)
    shared = documents.sparkSession.sparkContext.broadcast(machine)  # bounded by BUCKETS
    known: dict = {}

    @F.pandas_udf("double")
    def toxic_score(text: pd.Series) -> pd.Series:
        return pd.Series(scores(text, shared.value, known))

    return documents.filter(toxic_score(F.col("text").cast("string")) < threshold)
