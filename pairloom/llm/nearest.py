"""Exact top-k by inner product over a pivot-distance index.

Vectors of integers; the score is the integer inner product.  To have a
metric, every vector x gets one more component sqrt(M^2 - |x|^2), M being the
largest norm, and every query is scaled to the norm M with 0 there: then the
distance of a query to x falls as the score rises.

1. Equal vectors are one class, known by its few smallest ids: later ones can
   never be among the first k.
2. Index: pivots are fitted on a bounded sample; every class is keyed by its
   nearest pivot and its distance to it.  The distances of a pivot are cut
   into rings (annuli), whose edges come from the sample and whose true
   smallest and largest distance and size from all classes.  The directory of
   rings has at most ``RINGS`` entries a vector length and is sent to tasks.
3. Search: by the triangle inequality the distance of a query to a ring is at
   least how far its distance to the pivot lies outside the ring, so a ring
   has an upper bound on its scores.  A query opens its rings in order of
   that bound, a few first and four times as many each round, and stops at the
   first whose bound is under its k-th best score so far.  What remains
   unopened cannot hold a result, so results are exact.

A ring of many classes, or one that many queries open, is split into blocks of
``MEMBERS`` classes and ``QUERIES`` queries; a task compares one block by a
matrix product.  Products are exact: in doubles where all sums stay under
2^53, else in Python's integers.

Defined results: a vector that is null or holds null or non-finite components
takes no part; components are cut to 64 bits, and so are scores; vectors of
different lengths are not compared; rows without vec_id are no queries, and
as candidates come last among equal scores; of rows that share a vec_id each
is a query and a candidate of its own; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import store

#: Classes that pivots are fitted on, and their bytes; vector lengths that get an index (others are one ring); most rings of a length.
SAMPLE, SAMPLE_BYTES, LENGTHS, RINGS = 20_000, 16 << 20, 64, 4096
#: Classes and queries of a block; rings opened in the first round.
MEMBERS, QUERIES, FIRST = 1024, 1024, 4
#: Part of a bound that rounding may take.
SLACK = 1e-9


def scaled(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component, x as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("long"))


def finite(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def matrix(blobs) -> np.ndarray:
    """The rows of equally long packed vectors."""
    blobs = list(blobs)
    if not blobs or not blobs[0]:
        return np.zeros((len(blobs), 0), np.int64)
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b, cut to 64 bits."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    if a.shape[1] * max(1.0, np.abs(x).max(initial=0)) * np.abs(y).max(initial=0) < 2.0 ** 53:
        return (x @ y.T).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(int(s), low), high) for s in r] for r in (a.astype(object) @ b.T.astype(object)).tolist()],
                    np.int64).reshape(len(a), len(b))


def packed(embeddings: DataFrame, factor: int) -> DataFrame:
    """(vec_id, vec, dim, norm, own): usable rows, their integers as 64-bit little-endian, their norm and their product with themselves."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = [np.asarray(x, "<i8") for x in pdf["ints"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "vec": [x.tobytes() for x in v], "dim": [len(x) for x in v],
                                "norm": [float(np.sqrt((x.astype(np.float64) ** 2).sum())) for x in v],
                                "own": [int(products(x[None], x[None])[0, 0]) for x in v]})

    fine = embeddings.filter(finite(F.col("embedding")))
    return fine.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), factor).alias("ints")).mapInPandas(
        rows, "vec_id long, vec binary, dim int, norm double, own long")


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, dim, norm, ids, absent): every distinct vector and its ``keep`` smallest ids, repeated ones repeated;
    null ids are the largest long, ``absent`` of them at the end."""
    some = rows.groupBy("vec", "dim", "norm", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(keep)).cast("int").alias("many"))
    # The limit on the rank is applied in every task before the shuffle, too.
    order = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last())
    few = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    held = F.array_sort(F.collect_list(F.struct("rank", F.coalesce("vec_id", F.lit((1 << 63) - 1)).alias("id"), "many")))
    ids = F.slice(F.flatten(F.transform(held, lambda r: F.array_repeat(r["id"], r["many"]))), 1, keep)
    named = F.coalesce(F.sum(F.when(F.col("vec_id").isNotNull(), F.col("many"))), F.lit(0))
    return (few.groupBy("vec", "dim", "norm").agg(ids.alias("ids"), named.alias("named"))
            .select("vec", "dim", "norm", "ids", (F.size("ids") - F.least(F.size("ids"), F.col("named"))).cast("int").alias("absent")))


class Index:
    """Pivots, ring edges and, once every class is counted, the directory of rings of one vector length."""

    def __init__(self, sample: np.ndarray, norm: float, rings: int, seed: int = 7):
        self.norm = norm
        x = self.lifted(sample)
        k = max(1, min(round(rings ** 0.5), len(x)))
        c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
        for _ in range(6):
            near = self._far2(x, c).argmin(axis=1)
            total, n = np.zeros_like(c), np.bincount(near, minlength=k)
            np.add.at(total, near, x)
            c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        self.pivots = c
        far = np.sqrt(self._far2(x, c))
        near = far.argmin(axis=1)
        share = np.arange(1, max(1, rings // k)) / max(1, rings // k)
        self.edges = [np.unique(np.quantile(far[near == p, p], share)) if (near == p).any() else np.empty(0) for p in range(k)]
        self.start = np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])])

    @staticmethod
    def _far2(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1), 0)

    def lifted(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        return np.concatenate([x, np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0))[:, None]], axis=1)

    def keys(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ring and pivot distance of vectors."""
        far = np.sqrt(self._far2(self.lifted(v), self.pivots))
        near = far.argmin(axis=1)
        r = far[np.arange(len(v)), near]
        ring = self.start[near]
        for p in np.unique(near):
            ring[near == p] += np.searchsorted(self.edges[p], r[near == p])
        return ring, r

    def directory(self, rings: list[tuple[int, float, float]]) -> None:
        """(ring, smallest, largest distance) of the rings that hold classes."""
        self.ring, self.low, self.high = (np.array(x) for x in zip(*sorted(rings), strict=True))
        self.owner = np.searchsorted(self.start, self.ring, side="right") - 1

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query: its rings in order, and the upper bounds on the scores there, never rising."""
        x = q.astype(np.float64)
        size = np.sqrt((x * x).sum(axis=1))
        scale = np.where(size > 0, self.norm / np.where(size > 0, size, 1), 1.0)
        y = np.concatenate([x * scale[:, None], np.zeros((len(x), 1))], axis=1)
        far = np.sqrt(self._far2(y, self.pivots))[:, self.owner]
        # Rounding in squares of distances may move a distance by about the root of it.
        off = np.maximum(np.maximum(self.low - far, far - self.high) - 2 * SLACK ** 0.5 * self.norm, 0)
        least2 = off * off
        own2 = (y * y).sum(axis=1)
        best = (own2[:, None] + self.norm ** 2 - least2) / (2 * scale[:, None])
        best += SLACK * (self.norm * size + 1)[:, None] + 1e-6
        order = np.argsort(-best, axis=1, kind="stable")
        return self.ring[order], np.take_along_axis(best, order, 1)


def fit(cls: DataFrame) -> dict[int, Index]:
    """An index for each of the commonest vector lengths, from its classes of smallest hash."""
    lengths = (cls.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm"))
               .orderBy(F.desc("n"), "dim").limit(LENGTHS).collect())
    out = {}
    for r in lengths:
        most = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * max(1, r["dim"]))))
        own = cls.filter(F.col("dim") == r["dim"]).select("vec").orderBy(F.xxhash64("vec"), "vec").limit(most).collect()
        out[r["dim"]] = Index(matrix([bytes(x["vec"]) for x in own]), r["norm"] * (1 + 1e-12), int(min(RINGS, max(1, r["n"] ** 0.5 / 2))))
    return out


def keyed(cls: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """Classes with a number, their ring and their pivot distance (ring 0 for lengths without an index)."""
    shared = cls.sparkSession.sparkContext.broadcast(indexes)  # at most LENGTHS * sqrt(RINGS) pivots

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                part = part.drop(columns="norm")
                part["ring"], part["far"] = 0, 0.0
                if dim in shared.value:
                    part["ring"], part["far"] = shared.value[dim].keys(matrix(part["vec"]))
                yield part

    out = cls.select(F.monotonically_increasing_id().alias("cid"), "vec", "dim", "norm", "ids", "absent")
    return store(out.mapInPandas(rows, "cid long, vec binary, dim int, ids array<bigint>, absent int, ring long, far double"), "top_index")


def opened(queries: DataFrame, indexes: dict[int, Index], begin: int, end: int) -> DataFrame:
    """(cid, vec, dim, ring): the rings of ranks begin..end that may still hold a result; queries have ``worst``, null while too few are found."""
    shared = queries.sparkSession.sparkContext.broadcast(indexes)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                if dim not in shared.value:
                    if begin == 0:
                        yield pd.DataFrame({"cid": part["cid"], "vec": part["vec"], "dim": dim, "ring": 0})
                    continue
                for s in range(0, len(part), 256):
                    some = part.iloc[s:s + 256]
                    rings, best = shared.value[dim].bounds(matrix(some["vec"]))
                    worst = some["worst"].astype("Float64").to_numpy(np.float64, na_value=-np.inf)
                    worst -= np.where(np.isfinite(worst), np.abs(worst) * SLACK, 0)  # longs as doubles
                    a, b = np.nonzero(best[:, begin:end] >= worst[:, None])
                    yield pd.DataFrame({"cid": some["cid"].to_numpy()[a], "vec": some["vec"].to_numpy()[a], "dim": dim, "ring": rings[a, b + begin]})

    return queries.mapInPandas(rows, "cid long, vec binary, dim int, ring long")


def compared(members: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cid, score, vec_id): the k best rows of every block for every query that opens its ring."""
    key = ["dim", "ring"]
    wanted = store(wanted, "top_wanted")
    sizes = (members.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("mb"))
             .join(wanted.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("qb")), key))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n))
    m = members.join(sizes, key).select(*key, own("mb").alias("mb"), every("qb").alias("qb"), "cid", "ids", "absent", "vec")
    q = wanted.join(sizes, key).select(*key, every("mb").alias("mb"), own("qb").alias("qb"), "cid",
                                       F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("int").alias("absent"), "vec")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        m, q = pdf[pdf["ids"].notna()], pdf[pdf["ids"].isna()]
        if not len(m) or not len(q):
            return pd.DataFrame({"cid": [], "score": [], "vec_id": []})
        score = products(matrix(q["vec"]), matrix(m["vec"]))
        n = min(k, len(m))
        least = np.partition(score, len(m) - n, axis=1)[:, len(m) - n]
        a, b = np.nonzero(score >= least[:, None])
        many = np.array([len(x) for x in m["ids"]])
        flat = np.concatenate([np.asarray(x, np.int64) for x in m["ids"]])
        null = np.concatenate([np.arange(n) >= n - int(x) for n, x in zip(many.tolist(), m["absent"], strict=True)])
        start = np.cumsum(many) - many
        at = np.repeat(start[b] - np.cumsum(many[b]) + many[b], many[b]) + np.arange(many[b].sum())
        a, s = np.repeat(a, many[b]), np.repeat(score[a, b], many[b])
        got = pd.DataFrame({"cid": q["cid"].to_numpy()[a], "score": s, "vec_id": pd.array(flat[at], "Int64"), "null": null[at]})
        got.loc[got["null"], "vec_id"] = pd.NA
        got = got.sort_values(["cid", "score", "vec_id"], ascending=[True, False, True], na_position="last")
        return got.groupby("cid").head(k)[["cid", "score", "vec_id"]]

    return m.unionByName(q).groupBy(*key, "mb", "qb").applyInPandas(best, "cid long, score long, vec_id long")


def leaders(rows: DataFrame, k: int) -> DataFrame:
    """The k best (score, vec_id) of every cid; tasks drop what can't be among them before the shuffle."""
    order = Window.partitionBy("cid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(members: DataFrame, queries: DataFrame, indexes: dict[int, Index], k: int) -> DataFrame:
    """(cid, score, vec_id, rank): the k best rows of every query class."""
    found, begin, step = None, 0, FIRST
    most = max([1, *(len(x.ring) for x in indexes.values())])
    while begin < most:
        state = queries.withColumn("worst", F.lit(None).cast("long"))
        if found is not None:
            state = queries.join(found.groupBy("cid").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("worst")), "cid", "left")
        more = compared(members, opened(state, indexes, begin, begin + step), k)
        got = more if found is None else found.select("cid", "score", "vec_id").union(more)
        found = store(leaders(got, k), "top_found")
        begin, step = begin + step, 4 * step
    return found


def top_k(embeddings: DataFrame, queries: Column, k: int = 5, factor: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest score for every row whose vec_id ``queries`` is true for, the row itself left out."""
    rows = store(packed(embeddings, factor), "top_rows")
    cls = store(classes(rows, k + 1), "top_classes")
    indexes = fit(cls)
    members = keyed(cls, indexes)
    edges: dict[int, list] = {dim: [] for dim in indexes}
    directory = members.groupBy("dim", "ring").agg(F.min("far").alias("low"), F.max("far").alias("high"))
    for r in directory.filter(F.col("dim").isin(list(indexes))).collect():  # at most RINGS a length
        edges[r["dim"]].append((r["ring"], r["low"], r["high"]))
    for dim, rings in edges.items():
        indexes[dim].directory(rings)
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), "vec", "own")
    wanted = store(members.join(asked.select("vec").distinct(), "vec").select("cid", "vec", "dim"), "top_queries")
    found = search(members.select("cid", "ids", "absent", "vec", "dim", "ring"), wanted, indexes, k + 1)
    # A class finds k + 1 rows, so that every row of it can leave out itself; of equal (score, vec_id) any one may go.
    lists = (found.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("top"))
             .join(wanted.select("cid", "vec"), "cid").select("vec", F.transform("top", lambda r: F.struct(r["score"].alias("score"), r["vec_id"].alias("vec_id"))).alias("top")))
    self_at = F.array_position("top", F.struct(F.col("own").alias("score"), F.col("query_id").alias("vec_id")))
    rest = F.slice(F.filter("top", lambda r, i: i + 1 != F.col("self_at")), 1, k)
    return (asked.join(lists, "vec").withColumn("self_at", self_at).select("query_id", F.posexplode(rest).alias("at", "r"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score")))


def nearest_every_50th(embeddings: DataFrame, k: int = 5) -> DataFrame:
    """``top_k`` for the rows whose vec_id is divisible by 50."""
    return top_k(embeddings, F.col("vec_id") % 50 == 0, k)
