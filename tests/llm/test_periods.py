"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest

from pairloom.llm import periods

SCHEMA = "doc_id long, text string"


def brute_words(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute_runs(w):
    """Every longest stretch per period, then the smallest period of each stretch."""
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in best.items())


def sha(x):
    return hashlib.sha256(x).hexdigest()


def brute(doc_id, text):
    w = brute_words(doc_id, text)
    runs = brute_runs(w)
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def got(df):
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in periods.run_digest(df).collect()), key=repr)


def test_whole_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = sorted((brute(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in want) > 10
    assert got(df) == want


def random_text(rng):
    """Few letters, repeated blocks of all lengths, blocks within blocks, and defects."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        block = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60]))]
        if rng.random() < 0.4:
            block = block * rng.randrange(3, 9) + [rng.choice("abc")]
        out += block * rng.choice([1, 2, 3, 4, 9, 30])
        out += out[-len(block):][:rng.randrange(len(block) + 1)]
        if rng.random() < 0.5 and out:
            out[rng.randrange(len(out))] = "d"
    return " ".join(out[:700])


def test_runs_of_random_repeats(spark):
    rng = random.Random(11)
    rows = [(i, random_text(rng)) for i in range(250)]
    rows += [(1000 + n, " ".join(["x"] * n)) for n in (1, 23, 24, 25, 47, 48, 49, 100, 257)]
    rows += [(2000 + n, " ".join("ab"[i % 2] for i in range(n))) for n in (23, 24, 25, 64)]
    rows += [(3000 + q, " ".join([*map(str, range(q))] * 3)) for q in (7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65)]
    rows += [(4000 + q, " ".join(([*map(str, range(q))] * 3)[:-1])) for q in (8, 9, 16, 33)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == sorted((brute(*r) for r in rows), key=repr)


def test_tiles_alone():
    """Every run of a text is found from the tiles' fragments, stitched by hand."""
    rng = random.Random(2)
    for _ in range(60):
        w = [x.encode() for x in random_text(rng).split()]
        codes, parts = periods.numbered(w), {}
        for s, c in periods.tiles(codes):
            low = max(0, c - s)
            for q, a, b in periods.solve(codes[low:c + 4 * s].tolist(), c - low, s):
                parts.setdefault(q, set()).update(range(low + a, low + b))
        runs = brute_runs(w)
        for s, length, q in runs:
            assert set(range(s, s + length - q)) <= parts.get(q, set()), (s, length, q)


def test_odd_rows_and_extra_columns(spark):
    rep = "a b c " * 20
    rows = [(None, rep), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, rep), (4, rep), (4, "x " * 30), (5, "one"), (6, "w " * 30_000)]
    df = spark.createDataFrame([(d, t, "r", 1, "s") for d, t in rows], SCHEMA + ", row string, period int, s string")
    want = sorted((brute(d, t) for d, t in rows[:-1]), key=repr)
    found = got(df)
    assert [r for r in found if r[0] != 6] == [r for r in want if r[0] != 6]
    assert [r[1:6] for r in found if r[0] == 6] == [brute(6, "w " * 300)[1:3] + (30_000, 1, 30_000_000)]
    assert got(df.limit(0)) == []


def test_own_words_only_and_kept_text(spark):
    rows = [(i, "p q " * 20 + "end") for i in range(30)]
    out = periods.find_runs(spark.createDataFrame(rows, SCHEMA), rule=lambda d, n: None).collect()
    assert {r["collapsed"] for r in out} == {"p q end"} and {tuple(r["runs"][0]) for r in out} == {(0, 40, 2)}


@pytest.mark.parametrize("x", ["", "a", "aaaa", "abab", "abaab", "abcabcab", "zzzyzzz"])
def test_z_function(x):
    codes = [ord(c) for c in x]
    z = periods.z_function(codes)
    assert z == [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]
