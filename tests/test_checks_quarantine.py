"""Counters gathered while writing, checks that end the run, and rows set aside."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators import spans as S
from pairloom.plans import checks, pipeline
from pairloom.sources import quarantine as Q


def test_counted_in_the_pass_that_writes(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(x):
        reads.add(1)
        return x

    df = spark.range(1000).select(seen(F.col("id").cast("int")).alias("x"))

    def store(d):
        d.write.parquet(str(tmp_path / "t"))
        return spark.read.parquet(str(tmp_path / "t"))

    out, n = checks.written_and_counted(df, store, {"even": F.col("x") % 2 == 0, "all": F.lit(True), "none": F.lit(False)}, F.col("x") < 10)
    assert n == {"even": 500, "all": 1000, "none": 0} and out.count() == 10
    assert reads.value == 1000


def test_unequal_sides_end_the_run(spark):
    rows = [("u", s, k, f"{s} {k}") for s in ("plag", "src") for k in ("a", "b")]
    schema = "url string, side string, key string, sent string"
    assert S.paired(spark.createDataFrame(rows, schema)).count() == 2
    for wrong in (rows[:-1], rows[1:], [*rows, ("v", "src", "a", "x")]):
        with pytest.raises(PySparkException, match="different annotations"):
            S.paired(spark.createDataFrame(wrong, schema)).collect()
    with pytest.raises(PySparkException, match="too large"):
        checks.stop_unless(spark.range(5), F.when(F.col("id") < 4, True), "too large").count()


def test_sides_are_counted_before_pairing(spark):
    runs = [("u", "plag", 1, "a"), ("u", "plag", 2, "a"), ("u", "src", 1, "a"), ("u", "src", 1, "b"), ("v", "plag", 1, "c"), ("w", "plag", 1, "d"), ("w", "src", 1, "e")]
    got = {tuple(r) for r in S.side_counts(spark.createDataFrame(runs, "url string, side string, para_no int, key string")).collect()}
    assert got == {("u", 1, 2, 1, False), ("v", 1, 0, 1, False), ("w", 1, 1, 2, True)}


def test_pipeline_leaves_its_counters(spark, tmp_path):
    paths = pipeline.run(spark, "/root/testdata/sf0.001", str(tmp_path))
    n = {(r["counter"], r["lang"]): r["n"] for r in spark.read.schema(checks.COUNTERS).json(paths["counters"]).collect()}
    assert n["paraphrases", "en"] > 0 and n["errors", None] > 0 and n["skipped_paraphrases", "en"] > 0
    files = [os.path.join(d, f) for d, _, fs in os.walk(paths["corpus"]) for f in fs if f.endswith(".csv")]
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(files).count()
    assert back == sum(v for (k, _), v in n.items() if k in ("train", "test"))
    assert json.dumps(sorted(map(str, n)))


def test_damaged_records_are_set_aside(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.StringType())])
    good = ["1,0.5,a", '2,,"b, c"', '3,1e3,"say ""x"""', ",2,"]
    bad = {"4,0.5": "missing fields", "5,1,a,b": "surplus fields", "x,1,a": "wrong kind of value", "6,one,a": "wrong kind of value",
           '7,"1,2",a': "wrong kind of value"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([*good, *bad]) + "\n")
    df = Q.read_csv_leniently(spark, str(tmp_path / "in"), schema, header=False)
    df.write.parquet(str(tmp_path / "p"))
    ok, set_aside = Q.quarantined_csv(spark.read.parquet(str(tmp_path / "p")), schema, {"no id": F.col("id").isNotNull()})
    assert sorted(tuple(r) for r in ok.collect()) == [(1, 0.5, "a"), (2, None, "b, c"), (3, 1000.0, 'say "x"')]
    assert {r[Q.CORRUPT]: r["reasons"] for r in set_aside.where(F.col(Q.CORRUPT).isNotNull()).collect()} == {k: [v] for k, v in bad.items()}
    assert [r["reasons"] for r in set_aside.where(F.col(Q.CORRUPT).isNull()).collect()] == [["no id"]]


def test_rows_with_several_failures(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (-1, "b")], "n int, s string")
    good, bad = Q.split_rows(df, {"n": F.col("n") > 0, "s": F.col("s").isNotNull()})
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert sorted((str(r["n"]), r["reasons"]) for r in bad.collect()) == [("-1", ["n"]), ("None", ["n", "s"])]
    assert Q.split_rows(df.limit(0), {"n": F.col("n") > 0})[1].count() == 0
