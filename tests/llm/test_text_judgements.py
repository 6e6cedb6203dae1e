"""Licence scans, toxicity and decontamination."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pairloom.llm import decontamination, licences, toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_licence(text):
    w = plain_words(text)
    hits = [(i, label) for p, label in licences.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_licence_places_on_whole_documents(spark, docs, texts):
    got = {r["doc_id"]: r for r in licences.scan_licences(docs).collect()}
    assert len(got) == len(texts)
    for d, t in texts:
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licence(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_licence_odd_texts_and_templates(spark):
    cut = plain_words(licences.TEMPLATES["bsd"].split("\n\n")[0])
    rows = [(1, None), (2, ""), (3, "MIT License mit license, MIT--LICENSE; the mit licenses"), (4, "gnu general public license apache license"),
            (5, "x " * 3000 + licences.TEMPLATES["bsd"].upper()), (6, " ".join(cut[:8] + ["(new)"] + cut[8:])), (7, " ".join(cut[:6])),
            (None, "mit license"), (3, "mit mit license license")]
    got = licences.scan_licences(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, labels string")).collect()
    assert len(got) == len(rows)
    for r, (d, t) in zip(got, rows):
        assert (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (d, *brute_licence(t))
    by = {r["doc_id"]: r for r in got}
    assert by[5]["labels"] == "bsd" and by[5]["score"] == 1.0 and by[6]["labels"] == "bsd" and by[7]["labels"] == "" and by[7]["spans"] == []
    assert licences.scan_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    seqs = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(6)]
    a = licences.SuffixAutomaton(seqs)
    subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [rng.randrange(4) for _ in range(300)]
    state = length = 0
    for i, w in enumerate(text):
        state, length = a.step(state, length, w)
        want = max((n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in subs), default=0)
        assert length == want
        ends = {(k, e) for k, at in a.ends[state].items() for e in at}
        run = text[i + 1 - length:i + 1]
        assert not length or ends == {(k, e) for k, s in enumerate(seqs) for e in range(length - 1, len(s)) if s[e + 1 - length:e + 1] == run}


def brute_chain(matches, gap):
    """The most template words of any rising subset of matches that ends with each one, by recursion."""
    def best(i):
        end, n, at = matches[i]
        return max([n] + [best(j) + n - max(0, e - (end - n), t - (at - n)) for j, (e, _, t) in enumerate(matches)
                          if e < end and t < at and end - n - e <= gap])
    return [best(i) for i in range(len(matches))]


def test_chains_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        matches = sorted({(rng.randrange(5, 60), rng.randrange(1, 6), rng.randrange(5, 25)) for _ in range(rng.randrange(1, 12))})
        gap = rng.randrange(0, 9)
        assert [c for _, _, c in licences.chain(matches, gap)] == brute_chain(matches, gap)


def test_matches_of_every_template_against_brute_force():
    """A template's own longest runs, also where another template has a longer one there."""
    rng = random.Random(4)
    templates = {f"t{k}": " ".join(rng.choice("abc") for _ in range(rng.randrange(6, 30))) for k in range(5)}
    for _ in range(40):
        text = " ".join(rng.choice([rng.choice("abcd"), rng.choice(list(templates.values()))]) for _ in range(12))
        w, share = text.split(), {}
        for label, t in templates.items():
            s = t.split()
            same = {(i, j) for i, x in enumerate(w) for j, y in enumerate(s) if x == y}
            longest = {}
            for i, j in sorted(same):
                longest[i, j] = longest.get((i - 1, j - 1), 0) + 1
            here = {i: max(n for (a, _), n in longest.items() if a == i) for i, _ in longest}
            runs = sorted((i, n, j) for (i, j), n in longest.items() if n == here[i] >= licences.LONG and here.get(i + 1, 0) <= n)
            if runs:
                share[label] = max(c for _, _, c in licences.chain(runs)) / len(s)
        assert abs(licences.Scanner(templates, {}).scan(text)[6] - max([0.0, *share.values()])) < 1e-12


def test_whole_notices_and_their_spans():
    scan = licences.Scanner(licences.TEMPLATES, licences.BASE).scan
    for label, notice in licences.TEMPLATES.items():
        got = scan("int main ( ) " + notice + " # include")
        n = len(plain_words(notice))
        assert label in got[5].split(",") and got[6] == 1.0
        assert (label, 2, n + 1, n, 1.0) in [tuple(s.values()) for s in got[7]]
        w = notice.split()
        again = " ".join(w[:40] + w[20:26] + w[40:])  # six words come again in the middle
        assert label in scan(again)[5].split(",") and (len(w) < 46 or scan(again)[6] == 1.0)
    grant = licences.TEMPLATES["mit"].split()
    assert scan(" ".join(grant[:45]))[5] == "mit" and scan(" ".join(grant[:12]))[5] == ""
    twice = scan(licences.TEMPLATES["mpl"] + " filler words " * 50 + licences.TEMPLATES["mpl"])
    assert [s["label"] for s in twice[7]] == ["mpl", "mpl"] and twice[7][0]["last_word"] < twice[7][1]["first_word"]


def test_machine_learns_an_interaction():
    """Neither term alone decides; both together do."""
    rng = np.random.default_rng(0)
    insult, group = rng.integers(0, 2, 1500), rng.integers(0, 2, 1500)
    y = (insult & group).astype(float)
    rows, cols = [], []
    for i in range(1500):
        got = [*([11] if insult[i] else []), *([22] if group[i] else []), 33]
        rows += [i] * len(got)
        cols += got
    m = toxicity.fit(np.array(rows), np.array(cols), y, epochs=40)
    at = {int(b): i for i, b in enumerate(m.buckets)}
    def score(*terms):
        c = np.array([at[t] for t in terms if t in at])
        return toxicity.sigmoid(m.raw(np.zeros(len(c), int), c, 1))[0]
    assert score(11, 22) > 0.8 and score(11) < 0.3 and score(22) < 0.3 and score() < 0.3
    assert (m.v[at[11]] * m.v[at[22]]).sum() > 1


def test_words_that_tell_only_together(spark):
    """Toxic where exactly one of two words stands: each is as common in both classes."""
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = [f"filler{rng.randrange(300)}" for _ in range(10)] + ["zorgel"] * a + ["blimfa"] * b
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(a != b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(got[d]["predicted"], y) for d, _, y in rows if got[d]["held_out"]]
    assert len(held) > 800 and sum(p == y for p, y in held) / len(held) > 0.95


def test_score_is_the_double_sum_and_rows_may_come_in_any_order(spark):
    rng = random.Random(5)
    bad, good = ["idiot", "moron", "trash"], ["calm", "kind", "plain"]
    rows = [(i, " ".join(rng.choice(bad if i % 2 and rng.random() < 0.4 else good) for _ in range(8)), i % 2) for i in range(400)]
    rows += [(2, "idiot idiot moron", 0), (3, "calm", 1)]  # other texts under the same ids
    labels = spark.createDataFrame([(d, y) for d, _, y in rows[:400]], "doc_id long, toxic int")
    frames = [spark.createDataFrame([r[:2] for r in x], "doc_id long, text string").repartition(n) for x, n in ((rows, 1), (rows[::-1], 5))]
    machines = [toxicity.train(f, labels, sample=300) for f in frames]
    assert machines[0].bias == machines[1].bias and (machines[0].v == machines[1].v).all() and (machines[0].w == machines[1].w).all()
    m = machines[0]
    got = {(r["doc_id"], r["i"]): r["score"] for r in toxicity.score(frames[0], m).withColumn("i", F.lit(0)).collect()}
    by_text = {}
    for d, text, _ in rows:
        at = sorted({m.index[b] for w in set(text.split()) for b in toxicity.terms(w) if b in m.index})
        raw = m.bias + sum(m.w[i] for i in at) + sum(float(m.v[i] @ m.v[j]) for i in at for j in at if i < j)
        by_text.setdefault(d, []).append(1 / (1 + np.exp(-raw)))
    assert all(min(abs(s - x) for x in by_text[d]) < 1e-9 for (d, _), s in got.items())
    assert len(toxicity.train(frames[0], labels, sample=300, min_docs=10 ** 6, pair_docs=10 ** 6).buckets) == 0


def test_near_pairs_against_brute_force():
    rng = np.random.default_rng(2)
    frequent = np.zeros(toxicity.BUCKETS, bool)
    frequent[:30] = True
    for n in (0, 1, 2, 17, 90):
        seq = rng.integers(0, 40, n).astype("<i4")
        want = {(min(a, b), max(a, b)) for i, a in enumerate(seq.tolist()) for b in seq[i + 1:i + toxicity.PAIR_SPAN + 1].tolist()
                if a != b and a < 30 and b < 30}
        a, b = toxicity.near_pairs(seq, frequent)
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(want)


def test_held_out_accuracy(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert len(got) > 100 and right / len(got) >= 0.93
    assert sum(r["predicted"] > r["toxic"] for r in got) <= 0.02 * len(got)


def test_pairs_of_copies_are_added_up_in_the_task():
    rng = random.Random(3)
    own = [np.array([rng.randrange(40) for _ in range(50)], "<i4") for _ in range(5)]
    rows = [(i % 2, own[i % 5]) for i in range(1500)]
    frequent, chosen = np.zeros(toxicity.BUCKETS, bool), np.ones(toxicity.PAIR_CELLS, bool)
    frequent[:40] = True
    want = Counter((a, b, y) for y, s in rows for a, b in zip(*map(np.ndarray.tolist, toxicity.near_pairs(s, frequent)), strict=True))
    batches = [pd.DataFrame({"y": [y for y, _ in rows[i:i + 400]], "sequence": [s.tobytes() for _, s in rows[i:i + 400]]}) for i in range(0, 1500, 400)]
    got = pd.concat(toxicity.counted_pairs(iter(batches), frequent, chosen))
    assert len(got) == len(want) and {(r.a, r.b, r.y): r.n for r in got.itertuples()} == want
    assert len(pd.concat(toxicity.counted_pairs(iter([]), frequent, chosen))) == 0


def test_pair_counts_travel_as_few_blocks(monkeypatch):
    monkeypatch.setattr(toxicity, "PAIR_ROWS", 100)
    rng = random.Random(4)
    rows = [(i % 2, np.array([rng.randrange(60) for _ in range(40)], "<i4")) for i in range(300)]
    rows += [(1, np.array([61, 62], "<i4"))] * 40
    frequent, sizes = np.zeros(toxicity.BUCKETS, bool), [150, 190]
    frequent[:63] = True
    parts = [pd.DataFrame({"y": [y for y, _ in part], "sequence": [s.tobytes() for _, s in part]}) for part in (rows[:200], rows[200:], rows[:0])]
    sent = [x for part in parts for x in toxicity.counted_cells(iter([part]), frequent)]
    assert all(len(x) == 1 and len(x["data"][0]) == 8 * toxicity.PAIR_BLOCK for x in sent)
    assert len(sent) <= 2 * toxicity.PAIR_CELLS // toxicity.PAIR_BLOCK
    want = np.zeros((2, toxicity.PAIR_CELLS))
    for y, s in rows:
        np.add.at(want[y], toxicity._cell(*toxicity.near_pairs(s, frequent)), 1)
    want = np.flatnonzero((want.sum(axis=0) >= 20) & (toxicity._llr(want[1], want[0], 190.0, 150.0) >= 5.0))
    got = [block * toxicity.PAIR_BLOCK + np.flatnonzero(np.unpackbits(np.frombuffer(told, np.uint8)))
           for x in toxicity.told_cells(iter(sent), sizes, 20, 5.0) for block, told in zip(x["block"], x["told"], strict=True)]
    assert len(want) and sorted(np.concatenate(got).tolist()) == want.tolist()
    pairs = list(toxicity.counted_pairs(iter(parts), frequent, np.ones(toxicity.PAIR_CELLS, bool)))
    assert sum(map(len, pairs)) > 1000 and max(map(len, pairs)) <= 100


def test_few_words_are_remembered():
    texts, known = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(150)], {}
    rows, cols = toxicity._presences(texts, None, known)
    assert 0 < len(known) <= 60_000
    want = {(i, t) for i, text in enumerate(texts) for w in text.split() for t in toxicity.terms(w)}
    assert len(rows) == len(want) and set(zip(rows.tolist(), cols.tolist(), strict=True)) == want


def test_features_are_stored_in_few_files(spark, docs, monkeypatch):
    files, store = {}, toxicity.store

    def stored(df, label, *rows):
        files[label] = len((out := store(df, label, *rows)).inputFiles())
        return out

    monkeypatch.setattr(toxicity, "store", stored)
    confs = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        machine = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), sample=200)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(machine.buckets) and files["fm_terms"] <= toxicity.PAIR_TASKS


def test_a_batch_is_scored_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    texts = pd.Series([None, "", " ".join(f"w{i}" for i in range(90_000)), *(" ".join(f"w{x}" for x in rng.integers(0, 400, 2000)) for _ in range(300))])
    buckets = np.unique([b for i in range(400) for b in toxicity.terms(f"w{i}")])
    machine = toxicity.Machine(-1.0, buckets, rng.normal(size=len(buckets)), rng.normal(size=(len(buckets), 4)) / 50)
    rows, cols = toxicity._presences(texts, machine.index, {})
    want, held, raw = toxicity.sigmoid(machine.raw(rows, cols, len(texts))), [], toxicity.Machine.raw
    monkeypatch.setattr(toxicity.Machine, "raw", lambda self, r, c, n: (held.append(len(c)), raw(self, r, c, n))[1])
    assert (toxicity.scores(texts, machine, {}) == want).all()
    assert sum(held) == len(cols) and max(held) < len(cols) / 2
    assert len(toxicity.scores(texts[:0], machine, {})) == 0


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(i, "you idiot here" if i % 2 else "calm words here", 1.0) for i in range(60)]
                                 + [(100, None, 0.0), (101, "", 0.0), (None, "you idiot", 0.0), (102, "idiot " * 30_000, 0.0), (3, "you idiot", 0.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(None, 1, 0), (5, None, 0), (7, 0, 0), (100, 0, 0)],
                                   "doc_id long, toxic int, text int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 65 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[None] == by[102] == by[9] == 1 and by[100] == by[101] == by[8] == 0
    assert {r["predicted"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(0, 60, 2)} | {100, 101}


def brute_contamination(rows, items, window=13):
    wins = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    sizes = {len(k) for k in wins}
    out = []
    for d, text in rows:
        w, hit, ids = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    ids |= wins[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["the", "of", "Á", "x9"]) if rng.random() < 0.4 else f"w{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(30, None), (31, ""), (32, items[7][1]), (None, "the of"), (33, "a a a a a a a a a a a a a a")]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            w += [word() for _ in range(rng.randrange(20))] + [rng.choice(items)[1]]
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(x or "" for x in w)))
    rows += [(100, None), (101, ""), (102, "A a, a-a" * 400), (None, items[10][1]), (5, items[11][1]), (103, "word " * 20_000 + (items[12][1] or ""))]
    docs = spark.createDataFrame([(*r, "q", 7) for r in rows], "doc_id long, text string, item_id string, h int").repartition(3)
    bench = spark.createDataFrame([(i, t) for i, t in items if i is not None], "item_id long, text string")
    got = sorted([tuple(r) for r in decontamination.contamination(docs, bench).collect()], key=str)
    assert got == brute_contamination(rows, [x for x in items if x[0] is not None])
    none = decontamination.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["n_hit"] or r["contaminated"] for r in none)
    assert decontamination.contamination(docs.limit(0), bench).count() == 0
    left = decontamination.drop_contaminated(docs.filter("doc_id <> 5"), bench)
    bad = {r[0] for r in brute_contamination(rows, [x for x in items if x[0] is not None]) if r[-1]}
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {d for d, _ in rows if d is not None and d != 5 and d not in bad}


def test_contaminated_rows_go_one_by_one(spark):
    """Rows without doc_id and rows of a repeated one don't share a verdict."""
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, item), (None, "clean a"), (None, "clean b"), (None, None), (5, item), (5, "clean c"), (5, None), (6, item), (6, item),
            (7, "clean d"), (7, "clean d"), (8, item)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["n"] for r in left.collect()) == [i for i, (_, t) in enumerate(rows) if t != item]
