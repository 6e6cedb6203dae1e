"""The filter audit against filters that are really applied in every order."""

import itertools
import random
import re

import numpy as np

from pairloom.llm import interactions

FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text, earlier):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": earlier}


def brute(docs, labels):
    """Runs every order over every row."""
    good, toxic = {}, {}
    for d, q, t in labels:
        if d is not None:
            good[d], toxic[d] = good.get(d, 0) | (q == 1), toxic.get(d, 0) | (t == 1)
    rows = []
    for d, text, lang in docs:
        earlier = any(e is not None and d is not None and e < d and (t or "") == (text or "") for e, t, _ in docs)
        rows.append((lang or "", fails(text or "", earlier), good.get(d, 0), toxic.get(d, 0)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                lost = [r for r in left if r[1][f]]
                gone = len([r for r in own if r[1][f]]) - len(lost)
                left = [r for r in left if not r[1][f]]
                total[f] += len(lost)
                out[part, "".join(order), step] = [len(left), len(lost), gone, sum(r[1][f] and sum(r[1].values()) == 1 for r in own),
                                                   sum(r[2] for r in lost), sum(r[3] for r in lost)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in FIGURES) for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_order_on_random_rows(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["word", "Word", "WORD", f"t{rng.randrange(300)}", "a|b", "x"]) for _ in range(rng.choice([0, 5, 99, 100, 101, 160])))
             for _ in range(25)] + [None, "", " ", "É" * 9 + "A", "AAAAAAAAAA", "a\x00b"]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(120)]
    docs += [(None, texts[0], "en"), (None, texts[0], "xx"), (5, texts[1], "en"), (5, texts[1], "en"), (5, texts[1], "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, lang string, part string, n int")
    lb = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(interactions.filter_audit(df, lb)) == brute(docs, labels)
    assert interactions.filter_audit(df.limit(0), lb).count() == 0
    alone = got(interactions.filter_audit(df, lb.limit(0)))
    assert alone == brute(docs, [])


def test_gray_walk_gives_the_survivors_of_every_subset():
    rng = np.random.default_rng(1)
    masks, counts = rng.integers(0, 32, 40), rng.integers(0, 9, (40, 3))
    states = interactions.gray_walk(masks, counts, 5)
    for s in range(32):
        assert (states[s] == counts[(masks & s) == 0].sum(axis=0)).all()
