"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from pairloom.llm import nearest

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=5):
    """The k best (rank, vec_id, score) of every query row, rows told apart by their place."""
    fine = [(i, v, [math.floor(256 * x) for x in vec]) for i, (v, vec) in enumerate(rows)
            if vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for i, q, x in fine:
        if q is None or q % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), v is None, v or 0, v) for j, v, y in fine if j != i and len(x) == len(y)]
        out += [(q, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in nearest.nearest_every_50th(df).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(v, x, 1) for v, x in rows], SCHEMA).repartition(4)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert got(df) == brute(rows)


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim)) * 3
    return [[float(x) for x in centres[i % 6] + rng.normal(size=dim) * 0.1] for i in range(n)]


def test_hot_copies_ties_and_odd_rows(spark):
    rows = [(i, v) for i, v in enumerate(clustered(300, 4, 1))]
    rows += [(i, rows[7][1]) for i in range(300, 700)]  # one vector many times, queries among them
    rows += [(i, [0.0] * 4) for i in range(700, 720)]
    rows += [(None, rows[0][1]), (None, [9.0] * 4), (None, [9.0] * 4), (50, rows[0][1]), (50, rows[50][1]), (50, rows[50][1]), (-50, [1.0] * 4)]
    rows += [(800, None), (850, [float("nan")] * 4), (900, [float("inf"), 0.0, 0.0, 0.0]), (950, [None, 1.0, 1.0, 1.0]), (1000, []), (1001, []),
             (1050, [1.0, 2.0]), (1051, [3.0, -4.0]), (1100, [5.0])]
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, rows).limit(0)) == []


def test_sums_beyond_doubles_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 21 for _ in range(3)]) for i in range(120)]
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("first", [1, 4])
def test_blocks_and_rounds(spark, monkeypatch, first):
    """Small blocks, many rings, several rounds."""
    monkeypatch.setattr(nearest, "MEMBERS", 16)
    monkeypatch.setattr(nearest, "QUERIES", 2)
    monkeypatch.setattr(nearest, "FIRST", first)
    rows = [(i, v) for i, v in enumerate(clustered(900, 8, 2))]
    assert got(frame(spark, rows)) == brute(rows)


def test_bounds_hold_and_prune():
    """No score of a ring is over its bound, and most rings are under the best scores of clustered vectors."""
    v = np.floor(256 * np.array(clustered(4000, 8, 5))).astype(np.int64)
    norm = float(np.sqrt((v.astype(float) ** 2).sum(axis=1).max()))
    index = nearest.Index(v[:1000], norm, 64)
    ring, far = index.keys(v)
    index.directory([(int(r), float(far[ring == r].min()), float(far[ring == r].max())) for r in np.unique(ring)])
    q = v[::50]
    rings, best = index.bounds(q)
    scores = q @ v.T
    skipped = 0
    for i in range(len(q)):
        fifth = np.sort(scores[i])[-6]
        for r, b in zip(rings[i], best[i], strict=True):
            assert scores[i][ring == r].max() <= b
            skipped += b < fifth
    assert skipped > 0.5 * rings.size
