"""The pipeline against brute force, stage by stage, and the registered queries."""

import hashlib
import os
import zlib

import numpy as np

import corpus_pipeline
from pairloom.llm import queries, toxicity
from tests.llm.test_near_duplicates import brute_jaccard
from tests.llm.test_substrings import brute as brute_substrings
from tests.llm.test_text_judgements import brute_contamination

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    from pairloom.llm.tokens import default_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "substring_dedup", "decontamination", "packing"]
    kept = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()]
        out = stage(spark, kept, SF)
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        if name == "toxicity":
            judged = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 0").collect()
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in judged}
        elif name == "jaccard_join":
            _, comp = brute_jaccard(before)
            assert sorted(r["doc_id"] for r in rows) == sorted(d for d in comp if comp[d] == d)
        elif name == "substring_dedup":
            want = {d: (n, lost, sha) for d, n, lost, sha in brute_substrings(before)}
            old = dict(before)
            got = {r["doc_id"]: r for r in rows}
            assert set(got) == {d for d, (n, lost, _) in want.items() if not lost or lost < n}
            for d, r in got.items():
                words = (r["text"] or "").encode().split()
                assert hashlib.sha256(b" ".join(words)).hexdigest() == want[d][2]
                assert want[d][1] or r["text"] == old[d]
                assert r["text"] is None or r["n_chars"] == len(r["text"])
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert sorted(r["doc_id"] for r in rows) == sorted(x[0] for x in brute_contamination(before, bench) if not x[-1])
        else:
            t = Tokenizer.from_file(default_path())
            want = []
            for d, text in before:
                ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
                want += [(d, i, zlib.crc32(ids[s:s + 4096].tobytes())) for i, s in enumerate(range(0, len(ids), 4096))]
            assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows) == sorted(want)
            total, used = sum(r["length"] for r in rows), len({r["sequence_id"] for r in rows})
            assert used <= -(-total // 4096) + 1
        kept = spark.createDataFrame(rows, out.schema)
    run = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in run.collect()) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in kept.collect())


def test_registered_queries():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert "pairloom.llm" not in "".join(
        open(os.path.join(d, f)).read() for top in ("functions", "operators", "plans", "sources", "streaming")
        for d, _, fs in os.walk(os.path.join(os.path.dirname(corpus_pipeline.__file__), "pairloom", top)) for f in fs if f.endswith(".py"))
