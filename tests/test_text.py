from pyspark.sql import functions as F

from pairloom.functions import measures as M
from pairloom.functions import text as tx


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys()))
    return df.select(expr.alias("r")).first()["r"]


def test_text_before_hr(spark):
    assert one(spark, tx.text_before_hr("h"), h="<td>abcd<br/>bla<hr>bla</td>") == "abcd bla"
    assert one(spark, tx.text_before_hr("h"), h='<td>a<hr class="x">b</td>') == "a b"
    assert one(spark, tx.text_before_hr("h"), h="<td>a<HR>b</td>") == "a"


def test_list_overlap(spark):
    r = one(spark, F.array_intersect(F.split("a", ","), F.split("b", ",")), a="a,b,c,d,e", b="a,c,e,g")
    assert r == ["a", "c", "e"]


def test_clean_control_chars(spark):
    assert one(spark, tx.clean_control_chars("t"), t="a\u0007b​c") == "a b c"


def test_tokens(spark):
    assert one(spark, tx.tokens("t"), t="Hi, there (x)!") == ["Hi", "there", "(", "x", ")"]
    assert one(spark, tx.tokens_all("t"), t="Hi, there!") == ["Hi", ",", "there", "!"]


def test_sentences_and_offsets(spark):
    t = "One two. Three four!  Five\nsix? x"
    assert one(spark, tx.split_sentences("t"), t=t) == ["One two.", "Three four!", "Five\nsix?", "x"]
    from pairloom.sources.adapters import sentence_offsets

    rows = sentence_offsets(spark.createDataFrame([(1, t)], ["doc_id", "text"])).orderBy("ix").collect()
    assert [(r["start"], r["end"]) for r in rows] == [(0, 8), (9, 20), (22, 31), (32, 33)]
    assert all(t[r["start"]:r["end"]] == r["sent"] for r in rows)


def test_measures(spark):
    assert one(spark, M.bow_difference(F.split("a", " "), F.split("b", " ")), a="a a b", b="b c") == 2
    assert one(spark, M.word_ratio(F.split("a", " "), F.array().cast("array<string>")), a="x y z") is None
    assert abs(one(spark, M.jaccard(F.split("a", ","), F.split("b", ",")), a="a,b", b="b,c") - 1 / 3) < 1e-12
    assert one(spark, M.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), a="") is None


def test_inner_identical(spark):
    assert one(spark, M.inner_identical("p", "s"), p="Abc", s="abc def") is True
    assert one(spark, M.inner_identical("p", "s"), p="", s="anything") is True
    assert one(spark, M.inner_identical("p", "s"), p="abc", s="xyz") is False


def test_detect_language(spark):
    rows = [("the cat and the dog of the house", "en"), ("der Hund und die Katze", "de"), ("zzz qqq", None), (None, None)]
    got = tx.with_language(spark.createDataFrame([(t,) for t, _ in rows], "t string"), "t", "lang").collect()
    assert [r["lang"] for r in got] == [lang for _, lang in rows]
    tie = tx.with_language(spark.createDataFrame([("x y",)], "t string"), "t", "lang", {"abd": ["x"], "abc": ["y"]}).first()
    assert tie["lang"] == "abc"


def test_file_stem_and_author(spark):
    assert one(spark, tx.file_stem("p"), p="de2018-5-15.csv") == "de2018-5-15"
    assert one(spark, tx.author_of("i"), i="Aaf/Fragment 009 01_7") == "Aaf"


def test_stopword_file_and_label_files(spark, tmp_path):
    from pairloom.sources import files as FS

    sw = tmp_path / "sw.txt"
    sw.write_text("aber\nals\nhier\thinter\n\n", encoding="utf-8")
    assert sorted(r["word"] for r in FS.read_stopwords(spark, str(sw)).collect()) == ["aber", "als", "hier", "hinter"]
    f1 = tmp_path / "a1.txt"
    f1.write_text('source,"x";;;\nplag,"y";;;\n1;;;\n;;;\nsource,"z";;;\nplag,"w";;;\nparahrase?\n2;;;\n;;;\n', encoding="utf-8")
    assert [r["label"] for r in FS.read_label_file(spark, str(f1)).orderBy("item_no").collect()] == [1, 2]
    f2 = tmp_path / "a2.txt"
    f2.write_text('source,x\nplag,y\nparahrase?,0\n\nsource,z\nplag,w\nparahrase?,2 \n', encoding="utf-8")
    got = FS.read_label_file(spark, str(f2), r"parahrase\?,(\d).*").orderBy("item_no").collect()
    assert [r["label"] for r in got] == [0, 2]


def test_fragment_page_fields(spark):
    from pairloom.operators.pages import fragment_fields

    html = ('<html><body><h1>Aaf/Fragment 009 01</h1><div class="fragment"><dl><dt>Typus</dt><dd>Verschleierung</dd>'
            '<dd><a href="/x"><img alt="Yes" src="y.png"></a></dd></dl><table><tr><td>meta</td></tr></table>'
            '<table><tr><td>head</td><td>head</td></tr><tr><td>plag <b>text</b><hr>refs</td><td>src text</td></tr>'
            '</table></div></body></html>')
    r = fragment_fields(spark.createDataFrame([("u", html)], ["url", "html"])).first()
    assert r["fragment_identifier"] == "Aaf/Fragment 009 01" and r["type"] == "Verschleierung" and r["source"] == "wiki"
    two = html.replace("<dd><a", "<dd>second</dd><dd><a").replace('alt="Yes"', 'alt="No"').replace("<dl>", '<dl><dt><img alt="Yes"></dt>')
    r2 = fragment_fields(spark.createDataFrame([("u", two), ("v", "<h1>x</h1><p>no box</p>"), ("w", None)], ["url", "html"])).collect()
    assert [(x["url"], x["type"], x["gesichtet"]) for x in r2] == [("u", "Verschleierung second", False)]
    assert r["gesichtet"] is True and r["plagiat_text"] == "plag text" and r["source_text"] == "src text"
    assert r["raw_plagiat_text"].startswith("<td>plag")


def test_lenient_casts_and_flags(spark):
    from pairloom.functions import measures as M

    df = spark.createDataFrame([(bytearray(b"\x00"), "1.5"), (bytearray(b"\x01"), "x"), (None, None), (bytearray(b"\xff"), "2")], "b binary, t string")
    out = df.select(M.byte_flag("b").alias("f"), M.decoded("b").alias("d"), M.as_number("t").alias("n"), "t", "b")
    assert [(r["f"], r["d"], r["n"]) for r in out.collect()] == [(0, "\x00", 1.5), (1, "\x01", None), (None, None, None), (1, None, 2.0)]
    r = out.agg(M.failures("t", "n").alias("n"), M.failures("b", "d").alias("d")).first()
    assert (r["n"], r["d"]) == (1, 1)


def test_inline_tags_and_references(spark):
    html = "Wor<b>t</b> M&uuml;ller&nbsp;&#228;x &amp;quot; a<br>b<p>c</p>d<!-- x -->e<script>var x = 1;</script><td>f</td>g &bogus; R&D"
    assert one(spark, tx.strip_markup("t"), t=html) == "Wort Müller äx &quot; a b c de f g &bogus; R&D"


def test_links_in_either_quotes_with_references_and_dots(spark):
    from pairloom.operators.pages import page_links

    html = """<a href="../x?p=1&amp;q=2">1</a><A class='paginator-next' href='/wiki/A/Fragment_1'>2</A><a href=c>3</a><a name="n">4</a><a href="//h/d/./e/../f">5</a>
    <a href="mailto:x@y">6</a><a href="?p=2">7</a><a href="#top">8</a>"""
    rows = page_links(spark.createDataFrame([(1, "http://a/b/p/q", html)], "page_id long, url string, html string")).orderBy("link_no").collect()
    assert [r["abs_url"] for r in rows] == ["http://a/b/x?p=1&q=2", "http://a/wiki/A/Fragment_1", "http://a/b/p/c", "http://h/d/f",
                                            "mailto:x@y", "http://a/b/p/q?p=2", "http://a/b/p/q#top"]
    assert [r["is_next"] for r in rows][:2] == [False, True] and rows[1]["is_fragment_link"]
