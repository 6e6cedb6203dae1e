from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import text as tx
from pairloom.operators import corpus as Cp
from pairloom.operators import negatives as N
from pairloom.operators import pairs as P


def test_drop_identical_sentences(spark):
    df = spark.createDataFrame([("a", "S. S. T.", "S. U."), ("b", "X y.", "Z w.")], ["pair_id", "plagiat_sent", "source_sent"])
    out = {r["pair_id"]: (r["plagiat_sent"], r["source_sent"]) for r in P.drop_identical_sentences(df).collect()}
    assert out["a"] == ("T.", "U.")
    assert out["b"] == ("X y.", "Z w.")
    more = spark.createDataFrame([(1, "S. T. S.", "S. U. S. V. S."), (2, "A.", "A."), (3, "A. A. B.", "A. C.")], ["n", "plagiat_sent", "source_sent"])
    got = {r["n"]: (r["plagiat_sent"], r["source_sent"]) for r in P.drop_identical_sentences(more).collect()}
    assert got == {1: ("T.", "U. V. S."), 2: ("", ""), 3: ("B.", "C.")}
    assert "Exchange" not in P.drop_identical_sentences(more)._jdf.queryExecution().executedPlan().toString()


def test_repeated_ids_do_not_multiply_rows(spark):
    rows = [("x_1", u, "p", f"s{u}", 9, 1.0, 1, "en") for u in ("a", "b")]
    pos = spark.createDataFrame(rows, Cp.LABELLED_COLUMNS)
    mono = spark.createDataFrame([("x_1", u, "p", f"s{u}", f"fake {u}", "en", "en", 9, 1.0) for u in ("a", "b")],
                                 ["annotation_identifier", "url", "plagiat_sent", "source_sent", "fake_source_sent", "lang_plagiat", "lang_source",
                                  "bow_diff", "nb_words_ratio"])
    got = Cp.with_negatives(pos, mono).collect()
    assert len(got) == 4 and {r["source_sent"] for r in got if not r["isParaphrase"]} == {"fake b"}
    assert Cp.train_test_split(spark.createDataFrame(rows + rows[:1], Cp.LABELLED_COLUMNS)).count() == 3


def test_sinks_keep_blanks_quotes_and_line_ends(spark, tmp_path):
    from pairloom.sources import files as FS

    values = ['  lead', 'trail  ', 'say "hi", you', 'two\nlines', 'tab\there', "back\\slash", '""']
    df = spark.createDataFrame([("en", "test", v, v[::-1], 1, "u") for v in values] + [("en", "train", "t", "s", 0, "u")],
                               ["lang", "split", "plagiat_sent", "source_sent", "isParaphrase", "url"])
    FS.write_tsv(df.select("plagiat_sent", "source_sent"), str(tmp_path / "tsv"))
    back = spark.read.options(**FS.LOSSLESS).option("sep", "\t").option("multiLine", True).csv(str(tmp_path / "tsv"))
    assert sorted(r["plagiat_sent"] for r in back.collect()) == sorted([*values, "t"])
    FS.write_corpus_files(df, str(tmp_path / "files"), "2024-1-1")
    for name, n in (("en2024-1-1_test.csv", 7), ("en2024-1-1_train.csv", 1), ("en2024-1-1.csv", 8)):
        got = FS.read_corpus_csv(spark, str(tmp_path / "files" / f"file_name={name}")).collect()
        assert len(got) == n and (n == 1 or {r["plagiat_sent"] for r in got} >= set(values))


def test_dedup_first(spark):
    df = spark.createDataFrame([("p", "s", "u2", 0, "x"), ("p", "s", "u1", 3, "y"), ("q", "s", "u3", 1, "z")],
                               ["plagiat_sent", "source_sent", "url", "i", "v"])
    out = sorted(tuple(r) for r in P.dedup_first(df, ["plagiat_sent", "source_sent"], ["url", "i"]).collect())
    assert out == [("p", "s", "u1", 3, "y"), ("q", "s", "u3", 1, "z")]


def fake_source_candidates_bruteforce(pairs, source_sents):
    """J7 written as the plain theta join (pairs x sentences of the fragment);
    for tests on small fixtures only."""
    s = source_sents.withColumn("n", tx.word_count("sent"))
    p = pairs.withColumn("n_plag", tx.word_count("plagiat_sent"))
    j = p.join(s.withColumnRenamed("sent", "fake"), "url")
    ratio = F.col("n_plag") / F.col("n")
    return j.where(
        F.col("n").between(fixed.WORDS_MIN, fixed.WORDS_MAX) & (ratio >= fixed.RATIO_MIN) & (ratio <= fixed.RATIO_MAX)
        & (F.col("fake") != F.col("source_sent"))
    )


def _sents(spark, url, texts):
    return spark.createDataFrame([(url, i, t) for i, t in enumerate(texts)], "url string, sent_no long, sent string")


def test_fake_source_ratio_bounds_and_bruteforce(spark):
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    src = _sents(spark, "u", [words(n, "f") for n in [5, 6, 10, 12, 13, 20, 21, 40]] + ["dup " + words(9, "d")] * 3
                 + [words(9, "e")])
    pairs = spark.createDataFrame([("u", i, words(n, "p"), s) for i, (n, s) in enumerate(
        [(10, words(10, "s")), (6, "dup " + words(9, "d")), (30, words(30, "s")), (9, "dup " + words(9, "d"))]
        + [(10, words(10, "s"))] * 0)], "url string, i long, plagiat_sent string, source_sent string")
    index = N.fake_source_index(src)
    picked = {r["i"]: r["fake_source_sent"] for r in N.pick_fake_sources(pairs, index).collect()}
    brute = fake_source_candidates_bruteforce(pairs, src)
    allowed = {}
    for r in brute.collect():
        allowed.setdefault(r["i"], set()).add(r["fake"])
    for i, fake in picked.items():
        assert (fake == "" and i not in allowed) or fake in allowed[i]
    counts = {r["i"]: r["n_acceptable"] for r in N.acceptable_counts(pairs, index).collect()}
    want = {r["i"]: r["count"] for r in brute.groupBy("i").count().collect()}
    assert counts == {i: want.get(i, 0) for i in counts}
    # the source's own copies are never picked, and the ratio bounds are closed
    assert picked[1] != "dup " + words(9, "d") and picked[3] != "dup " + words(9, "d")


def test_fake_source_draw_is_spread_over_candidates(spark):
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    src = _sents(spark, "u", [words(10, f"c{k}x") for k in range(8)])
    pairs = spark.createDataFrame([("u", i, words(10, "p"), words(10, "s")) for i in range(64)],
                                  "url string, i long, plagiat_sent string, source_sent string")
    picked = {r["fake_source_sent"] for r in N.pick_fake_sources(pairs, N.fake_source_index(src)).collect()}
    assert len(picked) >= 6


def test_no_candidate_gives_empty(spark):
    src = _sents(spark, "u", ["a b c"])
    pairs = spark.createDataFrame([("u", 0, "p q r s t", "x y z w v")], "url string, i long, plagiat_sent string, source_sent string")
    assert N.pick_fake_sources(pairs, N.fake_source_index(src)).first()["fake_source_sent"] == ""


def _mono(spark, rows):
    return spark.createDataFrame(rows, "annotation_identifier string, url string, plagiat_sent string, source_sent string, "
                                       "fake_source_sent string, lang_plagiat string, lang_source string, bow_diff long, "
                                       "nb_words_ratio double")


def test_ratio_filter_is_open_and_negatives(spark):
    mono = _mono(spark, [("x_1", "u", "p1", "s1", "F", "de", "de", 7, 1.0), ("x_2", "u", "p2", "s2", "G", "de", "de", 7, 0.5),
                         ("x_3", "u", "p3", "s3", "", "de", "de", 7, 1.2), ("x_4", "u", "p4", "s4", "H", "de", "de", 7, 1.5)])
    pos = Cp.monolingual_by_lang(mono)
    assert sorted(r["annotation_identifier"] for r in pos.collect()) == ["x_1", "x_3"]
    lab = Cp.with_negatives(pos, mono)
    neg = [r.asDict() for r in lab.where(F.col("isParaphrase") == 0).collect()]
    assert len(neg) == 1 and neg[0]["annotation_identifier"] == "x_1_f" and neg[0]["source_sent"] == "F"
    assert neg[0]["bow_diff"] == 7 and neg[0]["nb_words_ratio"] == 1.0


def test_null_language_dropped(spark):
    ann = spark.createDataFrame([("a", "u", "p", "s", "f", None, "de", "Verschleierung", 1.0, 9)],
                                "annotation_identifier string, url string, plagiat_sent string, source_sent string, "
                                "fake_source_sent string, lang_source string, lang_plagiat string, type string, "
                                "nb_words_ratio double, bow_diff long")
    assert Cp.monolingual(ann).count() == 0


def test_split_sizes(spark):
    rows = []
    for lang, n in [("a", 1), ("b", 4), ("c", 5), ("d", 10)]:
        rows += [(f"{lang}{i:03d}", lang, 1) for i in range(n)]
    df = spark.createDataFrame(rows, ["annotation_identifier", "lang", "isParaphrase"])
    out = Cp.train_test_split(df).where(F.col("split") == "test").groupBy("lang").count().collect()
    assert dict((r["lang"], r["count"]) for r in out) == {"a": 1, "b": 1, "c": 2, "d": 3}
    first = Cp.train_test_split(df).where((F.col("lang") == "d") & (F.col("split") == "test"))
    assert sorted(r["annotation_identifier"] for r in first.collect()) == ["d000", "d001", "d002"]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], ["k", "v", "version"])
    new = spark.createDataFrame([(2, "B", 1), (3, "c", 1)], ["k", "v", "version"])
    out = sorted(tuple(r) for r in Cp.upsert_latest(old, new, ["k"], "version").collect())
    assert out == [(1, "a", 0), (2, "B", 1), (3, "c", 1)]


def test_corpus_csv_round_trip(spark, tmp_path):
    from pairloom.sources import files as FS

    df = spark.createDataFrame([("de", "test", 'a "quoted",\nline', "s", 1, "u")],
                               ["lang", "split", "plagiat_sent", "source_sent", "isParaphrase", "url"])
    path = str(tmp_path / "corpus")
    FS.write_corpus_csv(df, path)
    back = FS.read_corpus_csv(spark, path).first()
    assert back["plagiat_sent"] == 'a "quoted",\nline' and back["isParaphrase"] == 1
