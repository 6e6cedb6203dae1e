"""Learnt sentence boundaries and languages."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pairloom.functions import text as tx
from pairloom.operators import boundaries as B
from pairloom.operators import langmodel as LM
from pairloom.plans.stages import materialize


def corpus(rng, n=120):
    words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnrst')}{rng.choice('aeiou')}" for _ in range(60)]
    out = []
    for _ in range(n):
        sents = []
        for _ in range(rng.randrange(1, 8)):
            s = [rng.choice(words) for _ in range(rng.randrange(3, 12))]
            if rng.random() < 0.4:
                s.insert(rng.randrange(len(s)), "Dr.")
            if rng.random() < 0.3:
                s.insert(1, "z.B.")
            if rng.random() < 0.3:
                s[-1:] = ["am", "3.", "Mai"]
            sents.append(" ".join(s).capitalize() + rng.choice([".", ".", "!", "?"]))
        out.append("  ".join(sents) + rng.choice(["", " ", " 5."]))
    return [*out, "", None, ".", "Dr.", "Ende ... ja.", "x. y. z.", "\n a. \n b."]


def types(text):
    return [(re.sub(r"\.+$", "", w).lower(), w.endswith(".")) for w in re.findall(r"[^\W_][^\W_.]*(?:\.[^\W_.]*)*", text or "")]


def brute_tables(texts):
    n, stop, pairs = Counter(), Counter(), Counter()
    for t in texts:
        w = types(t)
        for i, (x, s) in enumerate(w):
            n[x] += 1
            stop[x] += s
            if s and i + 1 < len(w) and re.fullmatch(r"[0-9]+|[^\W\d_]", x):
                pairs[x, w[i + 1][0]] += 1
    total, chance = sum(n.values()), sum(stop.values()) / sum(n.values())
    abbr = {}
    for x in n:
        if stop[x] and not re.fullmatch("[0-9.]+", x):
            a, b, size = stop[x], n[x] - stop[x], len(x.replace(".", ""))
            tie = 2 * (a * math.log(0.99 / chance) + b * math.log(0.01 / (1 - chance)))
            score = tie * math.exp(-size) * (len(x) - size + 1) * size ** -b
            if score >= 0.3:
                abbr[x] = score
    ln = lambda v: v * math.log(v) if v > 0 else 0.0
    tied = {}
    for (x, y), k in pairs.items():
        if k >= 2:
            t = [k, n[x] - k, n[y] - k, total - n[x] - n[y] + k]
            ratio = 2 * (sum(map(ln, t)) - ln(t[0] + t[1]) - ln(t[2] + t[3]) - ln(t[0] + t[2]) - ln(t[1] + t[3]) + ln(sum(t)))
            if ratio >= 7.88 and k / n[x] > n[y] / total:
                tied[x, y] = ratio
    return abbr, tied


def brute_sentences(text, abbr, tied):
    pieces = re.split(r"(?<=[.!?])(?=[ \t\n\r\f\x0b])", text or "")
    out, held, at = [], "", 0
    for i, p in enumerate(pieces):
        held += p
        last = types(p)[-1:] if re.search(r"[^\W_][^\W_.]*(?:\.[^\W_.]*)*$", p) and p.endswith(".") else []
        following = types(pieces[i + 1])[:1] if i + 1 < len(pieces) else []
        veto = bool(last) and (last[0][0] in abbr or bool(following) and (last[0][0], following[0][0]) in tied)
        if not veto or i + 1 == len(pieces):
            s = held.strip(" \t\n\r\f\x0b")
            if s:
                begin = at + len(held) - len(held.lstrip(" \t\n\r\f\x0b"))
                out.append((begin, begin + len(s), s))
            at, held = at + len(held), ""
    return out


def test_tables_and_sentences_against_brute_force(spark):
    texts = corpus(random.Random(8))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, type string")
    abbr, tied = brute_tables(texts)
    assert {"dr", "z.b"} <= set(abbr) and ("3", "mai") in tied
    a, c = B.learn(df, "text", materialize)
    got = {r["type"]: r["score"] for r in a.collect()}
    assert set(got) == set(abbr) and all(math.isclose(got[x], abbr[x], rel_tol=1e-6) for x in got)
    found = {(r["type"], r["next"]): r["ratio"] for r in c.collect()}
    assert set(found) == set(tied) and all(math.isclose(found[x], tied[x], rel_tol=1e-6) for x in found)
    rows = B.learnt_sentences(df, a, c).collect()
    for i, t in enumerate(texts):
        own = sorted((r["ix"], r["start"], r["end"], r["sent"]) for r in rows if r["doc_id"] == i)
        assert [x[1:] for x in own] == brute_sentences(t, abbr, tied), t
        assert all(t[s:e] == x for _, s, e, x in own)


def test_no_statistics_no_veto(spark):
    schema = "doc_id long, text string"
    for rows in ([], [(1, "no stop at all")], [(1, "a. b."), (2, None)]):
        df = spark.createDataFrame(rows, schema)
        a, c = B.learn(df, "text", materialize)
        want = df.select("doc_id", F.explode(tx.split_sentences("text")).alias("s"))
        assert sorted((r["doc_id"], r["sent"]) for r in B.learnt_sentences(df, a, c).collect()) == sorted(map(tuple, want.collect()))


def brute_grams(text):
    t = " " + re.sub(r"(?:[\W\d_]|[\U00010000-\U0010ffff])+", " ", (text or "").lower()) + " "
    return [t[i:i + 3] for i in range(len(t) - 2)]


def test_trigrams(spark):
    texts = ["Ab c", "ÄÖ-ü 12x", "", None, "a", "𝒜bc 𝒜", "x" * 5000, "a\nb\tc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(LM.trigrams(F.coalesce("t", F.lit("")))).collect()] == [brute_grams(t) for t in texts]


def test_better_than_the_vote_on_held_out_rows(spark):
    """Learnt from the other rows, on whole texts and on short ones where the vote finds too few words."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    model, languages = LM.train(d.where(~LM.held_out(F.col("doc_id"))), materialize)
    assert model.count() <= LM.BUCKETS and model.where("l0 is null").count() == 0
    test = d.where(LM.held_out(F.col("doc_id"))).withColumn("text", F.array_join(F.slice(F.split("text", " "), 1, 6), " "))
    right = lambda df: df.where(F.col("lang") == F.col("detected")).count()
    learnt = right(test.join(LM.detect(test, model, languages), "doc_id"))
    vote = right(tx.with_language(test, "text", "detected"))
    assert learnt > vote and learnt >= 0.9 * test.count()


def test_odd_texts(spark):
    df = spark.createDataFrame([(1, "a", "aaa bbb"), (2, "b", "ccc ddd"), (3, None, "aaa"), (4, "a", None), (5, "a", "")], "doc_id int, lang string, text string")
    model, languages = LM.train(df, materialize)
    assert sorted(languages) == ["a", "b"]
    assert {r["doc_id"]: r["detected"] for r in LM.detect(df, model, languages).collect()} == {1: "a", 2: "b", 3: "a", 4: None, 5: None}
    none, empty = LM.train(df.limit(0), materialize)
    assert {r["detected"] for r in LM.detect(df, none, empty).collect()} == {None}


def test_texts_are_counted_in_one_pass(spark):
    from pairloom.operators import boundaries as Bd

    df = spark.createDataFrame([(1, "Am 3. Mai kam Dr. Abc. Am 3. Mai ging er."), (2, "3. Mai Dr. x")], "doc_id int, text string")
    seen = []
    Bd.learn(df, "text", lambda d: seen.append(d) or d)
    assert seen[0].columns == ["word", "next", "n"]
    got = {(r["word"], r["next"]): r["n"] for r in seen[0].collect()}
    assert got[("3.", "Mai")] == 3 and got[("Dr.", None)] == 2 and ("Mai", "kam") not in got
    assert {r["type"]: (r["n"], r["n_stop"]) for r in Bd.word_counts(df).collect()}["am"] == (2, 0)


def test_no_row_is_made_for_a_trigram(spark):
    df = spark.createDataFrame([(1, "a", "aaa bbb"), (2, "b", "ccc ddd")], "doc_id int, lang string, text string")
    model, languages = LM.train(df, materialize)
    assert "Generate" not in LM.detect(df, model, languages)._jdf.queryExecution().executedPlan().toString()


def test_buckets_are_those_of_the_trigrams():
    import hashlib

    texts = [" abc ", "  ", " äöü é "]
    of, buckets = LM._Hashed()(texts)
    want = [(i, int(hashlib.md5(t[k:k + 3].encode()).hexdigest()[:4], 16)) for i, t in enumerate(texts) for k in range(len(t) - 2)]
    assert list(zip(of.tolist(), buckets.tolist())) == want


def test_texts_of_one_id_are_judged_together(spark):
    df = spark.createDataFrame([(1, "a", "aaa bbb"), (2, "b", "ccc ddd")], "doc_id int, lang string, text string")
    model, languages = LM.train(df, materialize)
    twice = spark.createDataFrame([(7, "aaa bbb"), (7, "ccc"), (8, "ccc ddd")], "doc_id int, text string")
    assert sorted(map(tuple, LM.detect(twice, model, languages).collect())) == [(7, "a"), (7, "a"), (8, "b")]
