"""Substring dedup against brute force."""

import hashlib
import random

from pairloom.llm import substrings


def brute(rows, window=13):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i:i + window])] < d:
                    gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "Ö,", "日本"]
    passages = [[rng.choice(words) for _ in range(rng.choice([12, 13, 14, 30, 80]))] for _ in range(12)]
    rows = []
    for d in range(80):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += [rng.choice(words) for _ in range(rng.randrange(0, 15))]
            p = rng.choice(passages)
            a = rng.randrange(0, max(1, len(p) - 13))
            w += p if rng.random() < 0.6 else p[a:a + rng.randrange(10, 40)]
        rows.append((d * 7 % 83, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "x " * 13), (205, "x " * 40), (None, rows[0][1]), (None, None)]
    return rows + [(300, rows[0][1]), (300, rows[0][1]), (300, rows[3][1])]


def test_digest_against_brute_force(spark):
    rows = made(4)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, rid long, kept string").repartition(5)
    got = sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.substring_digest(df).collect()], key=str)
    assert got == brute(rows)


def test_small_shards_and_split_phrases(spark, monkeypatch):
    """Windows met in different shards give the same result."""
    rows = made(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substrings, "SHARD_BYTES", 500)
    monkeypatch.setattr(substrings, "HOT", 0.0)
    got = sorted([tuple(r) for r in substrings.substring_digest(df).collect()], key=str)
    assert got == brute(rows)


def test_empty_table_and_cutting(spark):
    schema = "doc_id long, text string, lang string"
    assert substrings.substring_digest(spark.createDataFrame([], schema)).count() == 0
    p = " ".join(f"p{i}" for i in range(20))
    df = spark.createDataFrame([(1, f"a {p} b", "x"), (2, f"c {p}\nd  e", "y"), (3, p, "z"), (4, "", None), (5, None, "q"), (None, p, "n")], schema)
    got = {r["doc_id"]: (r["text"], r["lang"]) for r in substrings.cut_repeats(df).collect()}
    assert got == {1: (f"a {p} b", "x"), 2: ("c d e", "y"), 4: ("", None), 5: (None, "q"), None: (p, "n")}


def test_least_phrases_is_the_minimum_of_each_window():
    import numpy as np

    from pairloom.llm.common import window_hash

    h = np.random.default_rng(0).integers(0, 1 << 62, 60).astype(np.uint64)
    for window in (3, 5, 6, 13, 20):
        k = window_hash(h, min(5, window), 3)
        span = window - min(5, window) + 1
        assert (substrings.least_phrases(h, window) == [k[i:i + span].min() for i in range(len(h) - window + 1)]).all()


def test_cutting_rows_that_share_a_doc_id(spark):
    p, q = " ".join(f"p{i}" for i in range(20)), " ".join(f"q{i}" for i in range(20))
    rows = [(1, p), (2, f"c {p}"), (2, f"c {p}"), (2, f"c {p}"), (3, f"own {p}"), (3, "other words"), (3, f"more {p} x"), (3, p), (4, q), (4, q),
            (None, p), (None, p)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int").repartition(4)
    got = sorted((r["n"], r["doc_id"], r["text"]) for r in substrings.cut_repeats(df).collect() if r["doc_id"] is not None)
    assert got == [(0, 1, p), (1, 2, "c"), (2, 2, "c"), (3, 2, "c"), (4, 3, "own"), (5, 3, "other words"), (6, 3, "more x"), (8, 4, q), (9, 4, q)]
    assert substrings.cut_repeats(df).filter("doc_id is null").count() == 2


def twins(n):
    """Two words of n letters that sums of powers modulo 2^64 can't tell apart (Thue and Morse)."""
    return ["".join("ab"[(i.bit_count() + k) & 1] for i in range(n)) for k in (0, 1)]


def test_long_words_are_told_apart(spark):
    rows = []
    for k, n in enumerate((64, 256, 1024, 4096)):
        x, y = twins(n)
        rows += [(10 * k, " ".join([x] * 14)), (10 * k + 1, " ".join([y] * 14)), (10 * k + 2, " ".join([x, y] * 8)), (10 * k + 3, " ".join([y] * 13 + [x]))]
    rows += [(90, "L" * 100_000 + " " + " ".join("abcdefghijklm")), (91, "L" * 99_999 + "M " + " ".join("abcdefghijklm"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in substrings.substring_digest(df).collect()], key=str) == brute(rows)


def test_word_hashes():
    import numpy as np

    from pairloom.llm.common import hashed_texts, word_hashes

    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab\xc3") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 24, 33, 255, 256, 257, 300]))) for _ in range(5000)]
    words += [w.encode() for n in (8, 64, 128, 256, 1024) for w in twins(n)]
    a, b = word_hashes(b" ".join(words)), word_hashes(b" \t".join(words), 1)
    assert len(set(a.tolist())) == len(set(b.tolist())) == len(set(words)) and not (a == b).any()
    texts = [b" ".join(words[i:i + 50]) for i in range(0, len(words), 50)] + [b"", b" ", b"x", b"y " * 100_000, b"z"]
    assert all((x == word_hashes(t)).all() and len(x) == len(t.split()) for x, t in zip(hashed_texts(texts), texts, strict=True))
    assert np.concatenate(list(hashed_texts(texts, 1)))[:len(words)].tolist() == b.tolist()
