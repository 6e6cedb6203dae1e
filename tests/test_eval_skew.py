import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom.operators import evaluate as E
from pairloom.operators import tfidf as TF
from pairloom.operators.skew import ordered_prefix, salted_join


def test_ordered_prefix_matches_row_number_on_hot_group(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string")))).alias("g"),
                                  F.col("id"))
    got = ordered_prefix(df, ["g"], ["id"], partitions=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    bad = got.join(want, ["g", "id"]).where(F.col("pos") != F.col("rn"))
    assert got.count() == 3000 and bad.count() == 0
    assert got.where(F.col("g") == "hot").select(F.max("pos_total")).first()[0] == 1000


def test_salted_join_equals_join(spark):
    big = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], ["k", "v"])
    assert salted_join(big, small, ["k"], "id", salts=4).count() == big.join(small, "k").count()


def test_sampler_no_self_and_sizes(spark):
    items = spark.createDataFrame([(f"i{n}", "g1" if n < 30 else "g2") for n in range(35)], ["id", "g"])
    c = E.sample_candidates(items, "id", ["g"], k=20)
    assert c.where(F.col("q_id") == F.col("c_id")).count() == 0
    per = {r["q_id"]: r["count"] for r in c.groupBy("q_id").count().collect()}
    assert per["i0"] == 19 and per["i31"] == 4
    assert c.groupBy("q_id", "c_id").count().where("count > 1").count() == 0


def test_argmax_ties_count_as_correct(spark):
    # d1's target ties with a distractor, d2's target shares nothing, d3 is beaten by a distractor
    items = spark.createDataFrame([(i, "g") for i in ("d1", "d2", "d3")] + [("alone", "h")], ["id", "grp"])
    w = [("d1", "src", "a", 1.0), ("d1", "plag", "a", 1.0), ("d2", "src", "b", 1.0), ("d2", "plag", "z", 1.0),
         ("d3", "src", "c", 1.0), ("d3", "plag", "a", 1.0), ("d3", "plag", "b", 0.0), ("alone", "src", "q", 1.0), ("alone", "plag", "r", 1.0)]
    weights = spark.createDataFrame(w, ["id", "side", "term", "weight"])
    got = {r["id"]: r for r in E.retrieval(items, weights, "id", ["grp"], "plag").collect()}
    assert got["d1"]["correct"] and got["d1"]["target_sim"] == got["d1"]["best_distractor_sim"] == 1.0
    assert got["d2"]["correct"] and got["d2"]["target_sim"] == 0.0 and got["d2"]["n_candidates"] == 3
    assert got["alone"]["correct"] and got["alone"]["best_distractor_sim"] is None and got["alone"]["n_candidates"] == 1
    beaten = weights.union(spark.createDataFrame([("d2", "plag", "c", 0.5)], weights.schema))
    assert not {r["id"]: r for r in E.retrieval(items, beaten, "id", ["grp"], "plag").collect()}["d3"]["correct"]


def test_agreement(spark):
    a1 = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], ["item_no", "label"])
    a2 = spark.createDataFrame([(0, 0), (1, 2), (2, 2)], ["item_no", "label"])
    r = E.annotator_agreement(a1, a2).first()
    assert abs(r["agreement_with_2"] - 2 / 3) < 1e-12 and r["agreement_without_2"] == 1.0 and r["n_unmatched"] == 0


def test_auc(spark):
    perfect = spark.createDataFrame([("x", 0.9, 1), ("x", 0.8, 1), ("x", 0.2, 0), ("x", 0.1, 0)], ["lang", "score", "isParaphrase"])
    flat = spark.createDataFrame([("x", 0.5, 1), ("x", 0.5, 0), ("x", 0.5, 1)], ["lang", "score", "isParaphrase"])
    assert E.roc_auc(E.roc_points(perfect, ["lang"]), ["lang"]).first()["auc"] == 1.0
    assert E.roc_auc(E.roc_points(flat, ["lang"]), ["lang"]).first()["auc"] == 0.5
    rev = perfect.withColumn("score", -F.col("score"))
    assert E.roc_auc(E.roc_points(rev, ["lang"]), ["lang"]).first()["auc"] == 0.0


def test_accuracy_rollup_micro_average(spark):
    res = spark.createDataFrame([("a", True), ("a", False), ("b", True)], ["author", "correct"])
    rep = {r["author"]: r for r in E.accuracy_by_group(res, "author").collect()}
    assert rep["a"]["accuracy"] == 0.5 and abs(rep[None]["accuracy"] - 2 / 3) < 1e-12 and rep[None]["size"] == 3


def test_tfidf_weights_have_unit_length(spark):
    from pairloom.operators import tfidf as TF

    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the mat and the log",
             "cat dog mat log", "on the mat the cat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ["doc", "text"])
    a, _ = TF.tfidf_weights(docs, ["doc"], min_df=1, max_df=100)
    assert a.count() == sum(len(set(t.split()) - {"a"}) for t in texts)
    norms = a.groupBy("doc").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-9 for r in norms)


def test_copies_of_a_text_share_their_terms(spark):
    """df counts documents, not texts; every document has its weights; a text is tokenised once."""
    rows = [("a", "one two two"), ("b", "one two two"), ("c", "one three"), ("d", None), ("e", ""), ("f", "one two two")]
    docs = spark.createDataFrame(rows, "doc string, text string")
    assert {(r["term"], r["many"], r["tf"]) for r in TF.term_counts(docs).collect()} == {
        ("one", 3, 1), ("two", 3, 2), ("one", 1, 1), ("three", 1, 1)}
    weights, vocab = TF.tfidf_weights(docs, ["doc"], min_df=1, max_df=100)
    assert {r["term"]: r["df"] for r in vocab.collect()} == {"one": 4, "two": 3, "three": 1}
    idf = {t: math.log(7 / (1 + n)) + 1 for t, n in (("one", 4), ("two", 3), ("three", 1))}
    got = {(r["doc"], r["term"]): r["weight"] for r in weights.collect()}
    norm = math.hypot(idf["one"], 2 * idf["two"])
    want = {(d, "one"): idf["one"] / norm for d in "abf"} | {(d, "two"): 2 * idf["two"] / norm for d in "abf"}
    norm = math.hypot(idf["one"], idf["three"])
    want |= {("c", "one"): idf["one"] / norm, ("c", "three"): idf["three"] / norm}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
