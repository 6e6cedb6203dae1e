"""SQL-callable functions and bucketed joins."""

import pytest

from pairloom.functions import measures as M
from pairloom.functions import text as tx
from pairloom.plans import sql as Sq
from pairloom.sources import bucketed


def test_sql_functions_are_the_library_functions(spark):
    rows = [("It's \"quoted\", isn't it? (Yes.)", "it is; quoted: 'x' \\ y!"), ("", "a"), (None, "a b"), ("Äpfel 3,5 %", "Äpfel 3,5 %"), ("abc", "xabcx")]
    df = spark.createDataFrame(rows, "a string, b string")
    Sq.register_functions(spark)
    df.createOrReplaceTempView("two_sides")
    got = spark.sql("""
        SELECT a, b, sentence_tokens(a) t, bow_difference(sentence_tokens(a), sentence_tokens(b)) d, inner_identical(a, b) i,
               word_ratio(sentence_tokens(a), sentence_tokens(b)) r, token_jaccard(sentence_tokens(a), sentence_tokens(b)) j FROM two_sides""")
    ta, tb = tx.tokens("a"), tx.tokens("b")
    want = df.select("a", "b", ta.alias("t"), M.bow_difference(ta, tb).alias("d"), M.inner_identical("a", "b").alias("i"),
                     M.word_ratio(ta, tb).alias("r"), M.jaccard(ta, tb).alias("j"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_table_function_over_cells(spark):
    sides = spark.createDataFrame([
        ("u1", "plag", '<p><span class="c">one <b>x</b> two</span></p><span class="d">out</span><hr><span class="e">late</span>'),
        ("u1", "src", None), ("u2", "src", ""), ("u2", "plag", '<p><span class="c"> </span></p>')], "url string, side string, html string")
    got = sorted(tuple(r) for r in Sq.annotated_spans_sql(spark, sides).collect())
    assert got == [("u1", "plag", 0, 0, "d", "out"), ("u1", "plag", 1, 0, "c", "one two")]
    assert Sq.annotated_spans_sql(spark, sides.limit(0)).count() == 0


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_join_has_no_exchange_and_deals_a_hot_key(spark, no_broadcast):
    rows = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(900)] + [(1000, None), (1001, "alone")]
    many = spark.createDataFrame(rows, "id int, url string")
    one = spark.createDataFrame([(f"k{i}", i) for i in range(6)] + [("hot", 99), ("unused", 5), (None, 7)], "url string, v int")
    stored = bucketed.store_for_join(many, one, "url", buckets=8, share=50)
    out = bucketed.join_stored(*stored, "url")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    sizes = {r["slot"]: r["count"] for r in stored[0].where("url = 'hot'").groupBy("slot").count().collect()}
    assert len(sizes) == 12 and max(sizes.values()) < 100
    got = sorted(map(tuple, out.select("id", "url", "v").collect()), key=str)
    assert got == sorted(map(tuple, many.join(one, "url", "left").select("id", "url", "v").collect()), key=str)
    empty = bucketed.store_for_join(many.limit(0), one, "url", buckets=4)
    assert bucketed.join_stored(*empty, "url").count() == 0
