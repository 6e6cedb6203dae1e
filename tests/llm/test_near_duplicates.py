"""Jaccard components and embedding links against brute force."""

import math
import random

import numpy as np
import pytest

from pairloom.llm import jaccard, vectors

SF = "/root/testdata/sf0.01"


def shingle_set(text, size=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([(len(w), *w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_jaccard(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    by = {}
    for d, s in sets.items():
        for t in s:
            by.setdefault(t, []).append(d)
    pairs = {(a, b) for ds in by.values() for a in ds for b in ds if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, components(sets, links)


def test_jaccard_on_whole_documents(spark, docs, texts):
    sets, comp = brute_jaccard(texts)
    got = jaccard.jaccard_components(docs).collect()
    assert len(got) == len(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), comp[d]) for d in sets}


def test_jaccard_edges_of_the_threshold_and_odd_rows(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for _ in range(40):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 5, 7, 8, 12, 20, 60]))]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One"), (n + 4, "oNE"), (n + 5, "a b c d"), (n + 6, "a b c d")]
    sets, comp = brute_jaccard(rows)
    df = spark.createDataFrame([(d, t, "x", d) for d, t in rows], "doc_id long, text string, g string, n long")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert got == {d: (len(sets[d]), comp[d]) for d in sets}


def test_jaccard_empty_null_and_repeated(spark):
    schema = "doc_id long, text string"
    assert jaccard.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, None)], schema)
    got = sorted(jaccard.jaccard_components(df).collect(), key=str)
    assert [tuple(r) for r in sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))] == [
        (None, 1, None), (1, 1, 1), (1, 1, 1), (2, 0, 2)]


def test_group_blocks_and_salts(spark, monkeypatch):
    """A group far over the block sizes gives the same components."""
    monkeypatch.setattr(jaccard, "MEMBERS", 3)
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(40):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
        rows.append((d, " ".join(w)))
    sets, comp = brute_jaccard(rows)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == comp


def brute_vectors(rows, least=0.93):
    fine = {}
    for i, v, label in rows:
        if v is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            fine[i] = (label, x / np.linalg.norm(x))
    links, edges = dict.fromkeys((r[0] for r in rows), 0), []
    for a, (la, x) in fine.items():
        for b, (lb, y) in fine.items():
            if a < b and la == lb and len(x) == len(y) and x @ y >= least:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    return links, components(links, edges)


def test_vectors_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()]
    links, comp = brute_vectors(rows)
    got = vectors.near_duplicates(df).collect()
    found = sum(r["n_links"] for r in got)
    assert found >= 0.9 * sum(links.values()) and all(r["n_links"] <= links[r["vec_id"]] for r in got)
    assert {r["vec_id"]: r["component_id"] for r in got} == comp
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_with_a_large_group_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + rng.normal(size=16) * 0.05], 1) for i in range(60)]
    rows += [(100 + i, [float(x) for x in rng.normal(size=16)], i % 2) for i in range(60)]
    rows += [(200, rows[0][1], 1), (201, [2 * x for x in rows[0][1]], 1), (202, rows[0][1], None), (203, None, 1), (204, [], 1),
             (205, [0.0] * 16, 1), (206, [float("nan")] * 16, 1), (207, [float("inf")] + [1.0] * 15, 1), (208, [None] * 16, 1), (209, [1.0, 2.0], 1)]
    links, comp = brute_vectors(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    got = vectors.near_duplicates(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (links[i], comp[i]) for i in links}
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def planted(n, pairs, seed=3, dim=64):
    """n random vectors of one label; the first ``pairs`` have a near copy at a cosine of about 0.94."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(pairs, dim))
    u -= (u * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    y = 0.94 * x[:pairs] + np.sqrt(1 - 0.94 ** 2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    return [(i, v, 1) for i, v in enumerate(np.concatenate([x, y]).tolist())]


def brute_links(rows, least=0.93):
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return dict(zip([r[0] for r in rows], ((x @ x.T >= least).sum(axis=1) - 1).tolist(), strict=True))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)


def test_a_split_cell_loses_no_links(spark, monkeypatch):
    """One cell in many blocks, at production BLOCK and NEAR; the audit is not there to help."""
    monkeypatch.setattr(vectors, "CELL", 1 << 30)
    rows = planted(4000, 100)
    reps = vectors.classes(frame(spark, rows)).cache()
    links, edges = vectors.search(reps, vectors.fit_cells(reps), 0.93, 0.15)
    want = {i: n for i, n in brute_links(rows).items() if n}
    assert len(want) == 200 and {r["rep"]: r["links"] for r in links.collect() if r["links"]} == want
    assert len({frozenset((r["a"], r["b"])) for r in edges.collect()}) == 100


def test_builds_under_the_target_end_in_an_exact_comparison(spark, monkeypatch):
    monkeypatch.setattr(vectors, "range_search", lambda *a: iter(()))  # a graph that finds nothing
    rows = planted(900, 60)
    got = vectors.near_duplicates(frame(spark, rows), margin=0.6).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == brute_links(rows)
    assert {r["component_id"] for r in got} == set(range(900))


def test_audit_counts_classes_and_wants_evidence(spark, monkeypatch):
    """A lost pair counts as much as a lost group, and a sample without links proves nothing."""
    rng = np.random.default_rng(4)
    rows = planted(300, 5)
    rows += [(1000 + i, [float(v) for v in np.asarray(rows[50][1]) + rng.normal(size=64) * 1e-3], 1) for i in range(80)]
    reps = vectors.classes(frame(spark, rows)).cache()
    want = {i: n for i, n in brute_links(rows).items() if n}
    linked, every = vectors.linked_sample(reps, 0.93)
    assert every and linked == want
    only_group = spark.createDataFrame([(i, n) for i, n in want.items() if n > 1], "rep long, links long")
    assert vectors.audit_recall(only_group, linked) == 81 / 91  # over links it would be 6480 of 6490
    monkeypatch.setattr(vectors, "AUDIT", 1)
    monkeypatch.setattr(vectors, "DRAWN", 4)
    monkeypatch.setattr(vectors, "EVIDENCE", 50)
    monkeypatch.setattr(vectors, "range_search", lambda *a: iter(()))
    rows = planted(900, 5)
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == brute_links(rows)


def test_a_table_with_few_links_is_judged_by_planted_copies(spark, monkeypatch):
    """Too few drawn classes have links: the graph stays, and planted copies neither count nor join groups."""
    monkeypatch.setattr(vectors, "AUDIT", 1)
    monkeypatch.setattr(vectors, "DRAWN", 4)
    monkeypatch.setattr(vectors, "PLANTED", 60)
    search, audit, built, judged = vectors.search, vectors.audit_recall, [], []
    monkeypatch.setattr(vectors, "search", lambda *a, **k: built.append(k.get("exact", False)) or search(*a, **k))
    monkeypatch.setattr(vectors, "audit_recall", lambda got, want: judged.append(len(want)) or audit(got, want))
    rows = planted(900, 5)
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    links = brute_links(rows)
    assert {r["vec_id"]: r["n_links"] for r in got} == links and len(got) == len(rows)
    assert {r["component_id"] for r in got} == set(range(900))
    assert True not in built and min(judged) >= 60


def test_planted_copies(spark):
    rows = [(i, v, 1) for i, v in enumerate([[1.0, 0.0], [0.0, 3.0], [5.0, 5.0]])] + [(9, [2.0], 1)]
    reps = vectors.classes(frame(spark, rows)).cache()
    own = {r["rep"]: r for r in reps.collect()}
    out = vectors.plant(reps, 0.93)
    assert len(out) == 4 and not {r["rep"] for r in out} & set(own) and all(r["many"] == 0 for r in out)
    best = [max(float(vectors.unit([r["vec"]])[0] @ vectors.unit([o["vec"]])[0]) for o in own.values() if o["dim"] == r["dim"]) for r in out]
    assert all(0.93 < c <= 1 + 1e-12 for c in best)
    assert vectors.plant(reps.limit(0), 0.93) == []


def test_jaccard_of_long_words(spark):
    from tests.llm.test_substrings import twins

    rows = []
    for k, n in enumerate((64, 256, 1024, 4096)):
        x, y = twins(n)
        rows += [(10 * k, " ".join([x] * 9)), (10 * k + 1, " ".join([y] * 9)), (10 * k + 2, f"{x} {y} " * 6), (10 * k + 3, f"{x} {y} " * 7)]
    rows += [(80, "L" * 100_000), (81, "L" * 100_000), (82, "L" * 99_999 + "M")]
    sets, comp = brute_jaccard(rows)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), comp[d]) for d in sets}


def test_dropping_by_row(spark):
    """Rows that share a doc_id, or have none, are judged by their own text."""
    w, u = " ".join(f"w{i}" for i in range(40)), " ".join(f"u{i}" for i in range(40))
    v = " ".join(f"v{i}" for i in range(40))
    rows = [(1, w), (5, w), (5, u), (7, u + " zz"), (8, v), (8, v), (8, v), (None, v), (None, "n " + u), (None, "only here once"), (None, "only here once"),
            (9, None), (9, None), (10, ""), (None, None), (11, "solo text of its own here")]
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, at int, row string").repartition(3)
    out = jaccard.drop_near_duplicates(df)
    assert out.columns == df.columns
    got = sorted((r["at"] for r in out.collect()))
    assert [x for x in got if x not in (4, 5, 6, 9, 10)] == [0, 2, 11, 12, 13, 14, 15]
    assert len([x for x in got if x in (4, 5, 6)]) == 1 and len([x for x in got if x in (9, 10)]) == 1
    assert jaccard.drop_near_duplicates(df.limit(0)).count() == 0


def test_sketch_leaves_a_task_block_by_block(monkeypatch):
    import pandas as pd

    from pairloom.llm import jaccard as J

    class Docs:
        def mapInPandas(self, rows, schema):
            return rows

    monkeypatch.setattr(J, "store", lambda rows, label: rows)
    rows = J.signatures(Docs(), 5)
    frames = list(rows(iter([pd.DataFrame({"row": [b"a"], "doc_id": [1], "text": ["a b c d e f"]})])))
    blocks = [f for f in frames if f["kind"].iloc[0] == 1]
    assert all(len(f) == 1 for f in blocks) and [f["block"].iloc[0] for f in blocks] == list(range(1 << J.SKETCH - J.SKETCH_BLOCK))


def test_blocks_are_merged_and_python_is_given_few_rows(spark):
    import pandas as pd

    from pairloom.llm import common

    rng = np.random.default_rng(2)
    made = [(int(b), rng.integers(0, 60_000, 8).astype("<u2")) for b in rng.integers(0, 5, 300)]
    df = spark.createDataFrame([(b, bytearray(x.tobytes())) for b, x in made], "block int, data binary").coalesce(1)
    got = list(common.merged_blocks(df, common.add_up, "u2"))
    assert len(got) == len({b for b, _ in got}) == 5
    for b, x in got:
        assert (x == np.minimum(sum(y.astype(np.int64) for c, y in made if c == b), 0xFFFF)).all()
    assert list(common.merged_blocks(df.limit(0), common.add_up, "u2")) == []

    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(pdf)]})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(50, numPartitions=1).mapInPandas(sizes, "n long")
    assert sorted(r["n"] for r in common.store(rows, "few", 20).collect()) == [10, 20, 20]
    assert [r["n"] for r in common.store(rows, "many").collect()] == [50] and spark.conf.get(name) == before
