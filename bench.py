"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is fully executed with the ``noop`` sink (every column is
computed, nothing is collected).  The materialized stages (lead pairs,
fragments, annotations, tf-idf) are timed as their own entries, so the
queries that read them are timed on top of the written tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "candidate_pairs",
    "detect_language",
    "page_links",
    "sentence_offsets",
    "paired_annotations",
    "fake_source_pick",
    "train_test_split",
    "corpus_export",
    "retrieval_in_group",
    "retrieval_global",
    "accuracy_by_group",
    "roc_auc",
    "annotator_agreement",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pairloom.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    from pairloom.plans import registry as R
    from pairloom.plans import stages

    times: dict[str, float] = {}

    def run(name, fn):
        t0 = time.time()
        df = fn()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    run("stage_sentences", lambda: stages.sentences(spark, sf_dir))
    run("stage_lead_pairs", lambda: stages.lead_pairs(spark, sf_dir))
    run("stage_fragments", lambda: stages.fragments(spark, sf_dir))
    run("stage_annotations", lambda: stages.annotations(spark, sf_dir))
    run("stage_tfidf", lambda: R._tfidf(spark, sf_dir)[0])
    for q in HEADLINE:
        run(q, lambda q=q: R.QUERIES[q](spark, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
