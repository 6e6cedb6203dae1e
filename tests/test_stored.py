"""Stored tables merged and read in part, sheets as files, known figures of the original report."""

import os
import random

from pairloom import fixed
from pairloom.operators import corpus as Cp
from pairloom.operators import evaluate as E
from pairloom.plans import stages
from pairloom.sources import files as FS
from pairloom.sources import stored as St

KEYED = "k long, v string, version int"


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}", 0) for i in range(400)] + [(None, "none", 0), (7, "later", 1), (7, "earlier", 0)]
    df = spark.createDataFrame(rows, KEYED)
    St.create_merged(df, path, ["k"], "version", buckets=16)
    want = {k: (v, n) for k, v, n in rows if k != 7} | {7: ("later", 1)}
    for batch in ([(7, "stale", 0), (8, "new", 1), (8, "newer", 2), (1000, "added", 0)], [(None, "some", 3)], []):
        before = _files(path)
        b = spark.createDataFrame(batch, KEYED)
        touched = St.merge_batch(spark, b, path, ["k"], "version", stages.materialize, buckets=16)
        assert touched == sorted({r[0] for r in b.select(St.bucket_of(["k"], 16)).collect()})
        gone, new = before - _files(path), _files(path) - before
        assert {int(f.split("bucket=")[1].split("/")[0]) for f in gone | new} == set(touched) and len(touched) <= 4
        for k, v, n in batch:
            if k not in want or n > want[k][1]:
                want[k] = (v, n)
        again = St.read_merged(spark, path, df.schema)
        assert {r["k"]: (r["v"], r["version"]) for r in again.collect()} == want and again.count() == len(want)
    St.merge_batch(spark, spark.createDataFrame([(8, "newer", 2)], KEYED), path, ["k"], "version", stages.materialize, buckets=16)
    assert St.read_merged(spark, path, df.schema).count() == len(want)  # a repeated batch changes nothing


def test_only_wanted_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(i, "en" if i % 3 else "de", i % 2) for i in range(30)], "id long, lang string, isParaphrase int")
    St.write_by_label(df, path)
    got = St.select_by_label(spark, path, df.schema, 1)
    assert {r["id"] for r in got.collect()} == {i for i in range(30) if i % 2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(isParaphrase" in plan and "PushedFilters: []" in plan
    langs = spark.createDataFrame([("de",), ("de",)], "lang string")
    assert {r["id"] for r in St.select_by_label(spark, path, df.schema, 0, langs).collect()} == {i for i in range(30) if i % 6 == 0}
    assert St.select_by_label(spark, path, df.schema, 1, langs.limit(0)).count() == 0


def test_sheet_is_written_as_lines_and_read_back(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"a{i:03}", 'He said "no",\nthen 5,3;' if i % 4 else "parahrase?,2", f"plain {i}", rng.randrange(3)) for i in range(60)]
    df = spark.createDataFrame(rows, "annotation_identifier string, source_sent string, plagiat_sent string, label int").repartition(5)
    path = str(tmp_path / "sheet")
    filled = Cp.annotation_sheet(df, label_col="label")
    FS.write_sheet(filled, path)
    by_id = {r[2]: r[3] for r in rows}
    order = {r["item_no"]: r["value"] for r in filled.collect() if r["field"] == "plag"}
    got = [r for r in FS.read_label_file(spark, path, "^" + fixed.LABEL_LINE_PATTERN_2).collect()]
    assert {r["item_no"]: r["label"] for r in got} == {n: by_id[v] for n, v in order.items()} and len(got) == 60
    lines = [line for f in sorted(os.listdir(path)) if f.endswith(".txt") for line in open(os.path.join(path, f)).read().split("\n")[:-1]]
    assert len(lines) == 240 and lines[3::4] == [""] * 60 and all(x.startswith("source,") for x in lines[::4])
    assert 'source,"He said ""no"", then 5,3;"' in lines
    FS.write_sheet(Cp.annotation_sheet(df), path)
    assert FS.read_label_file(spark, path, "^" + fixed.LABEL_LINE_PATTERN_2).count() == 0


def test_label_counts_of_an_annotators_file(spark, tmp_path):
    """Fifty items in the layout of the first annotator's file: 22, 16 and 12 of the labels."""
    labels = [0] * 22 + [1] * 16 + [2] * 12
    random.Random(2).shuffle(labels)
    tail = ";" * 12
    text = "".join(f'source,"In 1995, see (3)."{tail}\nplag,"Also 3, 4."{tail}\n{x}{tail}\n{tail}\n' for x in labels)
    (tmp_path / "a.txt").write_text(text)
    got = sorted(tuple(r) for r in FS.read_label_file(spark, str(tmp_path / "a.txt")).collect())
    assert got == list(enumerate(labels)) and [labels.count(x) for x in (0, 1, 2)] == [22, 16, 12]


def test_micro_average_of_the_report(spark):
    """12,369 of 15,802 right gives the report's total, whatever the groups."""
    df = spark.range(15802).selectExpr("concat('g', id % 226) as author", "id < 12369 as correct")
    got = {r["author"]: r for r in E.accuracy_by_group(df, "author").collect()}
    assert len(got) == 227 and got[None]["accuracy"] == 0.7827490191115049 and got[None]["size"] == 15802
    assert sum(r["size"] for k, r in got.items() if k) == 15802 and sum(r["n_correct"] for k, r in got.items() if k) == 12369


def test_train_and_test_are_the_whole_corpus(spark):
    df = spark.createDataFrame([(f"i{i}", "en" if i % 5 else "de", i % 2, f"p{i}", f"s{i}", "u") for i in range(103)],
                               "annotation_identifier string, lang string, isParaphrase int, plagiat_sent string, source_sent string, url string")
    split = Cp.train_test_split(df).collect()
    assert sorted(r["annotation_identifier"] for r in split) == sorted(f"i{i}" for i in range(103))
    for lang in ("en", "de"):
        for label in (0, 1):
            mine = [r["split"] for r in split if r["lang"] == lang and r["isParaphrase"] == label]
            assert mine.count("test") == int(0.2 * len(mine)) + 1
