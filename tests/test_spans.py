from pyspark.sql import functions as F

from pairloom.operators import spans as S


def frag(spark, plag, src, url="u"):
    return spark.createDataFrame([(url, plag, src)], ["url", "raw_plagiat_text", "raw_source_text"])


def sp(cls, text):
    return f'<span class="{cls}">{text}</span>'


def runs_of(spark, html):
    m = S.match_fragments(frag(spark, html, html))
    return sorted((r["key"], r["start"], r["end"]) for r in m["runs"].where(F.col("side") == "plag").collect())


def test_offsets(spark):
    html = "<td><p>" + sp("t", "abc") + sp("t", "defg") + sp("t", "hi") + "</p></td>"
    m = S.match_fragments(frag(spark, html, html))
    starts = [r["start"] for r in m["offsets"].where(F.col("side") == "plag").orderBy("span_no").collect()]
    assert starts == [1, 5, 10]


def test_run_merge_across_plain_span(spark):
    html = "<td><p>" + sp("fragmark1", "A b") + sp("t", "x") + sp("fragmark1", "C") + "</p></td>"
    assert runs_of(spark, html) == [("fragmark1_a b c", 1, 8)]


def test_three_runs(spark):
    html = "<td><p>" + sp("fragmark1", "A") + sp("fragmark2", "B") + sp("fragmark1", "C") + "</p></td>"
    assert [k for k, _, _ in runs_of(spark, html)] == ["fragmark1_a", "fragmark1_c", "fragmark2_b"]


def test_later_offsets_win(spark):
    html = "<td><p>" + sp("fragmark1", "A") + sp("fragmark2", "B") + sp("fragmark1", "A") + "</p></td>"
    r = dict((k, (s, e)) for k, s, e in runs_of(spark, html))
    assert r["fragmark1_a"] == (5, 6)


def test_span_after_hr_ignored(spark):
    html = "<td><p>" + sp("fragmark1", "A") + "</p><hr>" + sp("fragmark9", "Z") + "</td>"
    assert [k for k, _, _ in runs_of(spark, html)] == ["fragmark1_a"]


def test_sentence_lookup(spark):
    sents = spark.createDataFrame([("u", "plag", 0, 0, 0, 10, "s0"), ("u", "plag", 0, 1, 11, 20, "s1")],
                                  "url string, side string, para_no long, ix long, start long, end long, sent string")
    runs = spark.createDataFrame([("u", "plag", 0, "k1", 10, 11), ("u", "plag", 0, "k2", 25, 25)],
                                 "url string, side string, para_no long, key string, start long, end long")
    common = spark.createDataFrame([("u", "k1"), ("u", "k2")], ["url", "key"])
    ks = {r["key"]: r["sent"] for r in S.key_sentences(runs, sents, common).collect()}
    assert ks == {"k1": "s0 s1", "k2": "s1"}


def test_last_paragraph_wins(spark):
    ks = spark.createDataFrame([("u", "plag", 1, "k", "first"), ("u", "plag", 2, "k", "second")],
                               ["url", "side", "para_no", "key", "sent"])
    assert S.last_wins(ks).first()["sent"] == "second"


def test_pair_ids_have_gaps_after_filters(spark):
    from pairloom.plans.annotations import filtered_pairs

    kt = spark.createDataFrame([
        ("u", "plag", "a", "one two three four five"), ("u", "src", "a", "one two three four six"),
        ("u", "plag", "b", "same same same same same"), ("u", "src", "b", "same same same same same"),
        ("u", "plag", "c", "x y z w v"), ("u", "src", "c", "x y z w q"),
    ], ["url", "side", "key", "sent"])
    p = filtered_pairs(S.paired(kt))
    assert sorted(r["i"] for r in p.collect()) == [0, 2]


def test_word_count_bounds(spark):
    from pairloom.plans.annotations import filtered_pairs

    def words(n, w="w"):
        return " ".join(f"{w}{i}" for i in range(n))

    rows = []
    for i, n in enumerate([4, 5, 40, 41]):
        rows.append(("u", i, f"k{i}", words(n, "p"), words(n, "s")))
    df = spark.createDataFrame(rows, ["url", "i", "key", "plagiat_sent", "source_sent"])
    assert sorted(r["i"] for r in filtered_pairs(df).collect()) == [1, 2]


def test_nested_markup_parser(spark):
    from pairloom.functions.markup_parser import parse_spans

    html = ('<td><span class="h">Head</span><p><span class="fragmark1">A <span class="x">inner</span> b</span>'
            '<span class="t">  two\n words </span></p><p><span class="fragmark2">C</span></p>'
            '<hr><span class="fragmark1">z</span></td>')
    got = [(s["para_no"], s["span_no"], s["cls"], s["text"]) for s in parse_spans(html)]
    assert got == [(0, 0, "h", "Head"), (1, 0, "fragmark1", "A b"), (1, 1, "x", "inner"), (1, 2, "t", "two words"),
                   (2, 0, "fragmark2", "C")]
    from pairloom.functions.markup_parser import extract_spans_parsed

    df = spark.createDataFrame([("u", "plag", html)], ["url", "side", "html"])
    assert extract_spans_parsed(df).count() == 5


def test_a_run_replaces_the_keys_it_passes_through(spark):
    rows = [("u", "plag", 1, i, cls, t, len(t)) for i, (cls, t) in enumerate(
        [("fragmark1", "A"), ("fragmark2", "X"), ("fragmark1", "A"), ("fragmark1", "B")])]
    spans = spark.createDataFrame(rows, "url string, side string, para_no long, span_no long, cls string, text string, len long")
    got = {r["key"]: (r["start"], r["end"]) for r in S.span_runs(S.span_offsets(spans)).collect()}
    assert got == {"fragmark2_x": (3, 4), "fragmark1_a b": (5, 8)}


def test_parser_on_nested_markup():
    from pairloom.functions.markup_parser import parse_spans

    got = parse_spans('<td><span class="h">top</span><p>x<span id="1" class="fragmark1">zeta<br>eta <b>bold</b> end</span>'
                      '<div><span class="text">after</span></div><p><span class="fragmark2">A&uuml;<span class="in">n</span></span><hr><span class="z">no</span>')
    assert [(g["para_no"], g["cls"], g["text"]) for g in got] == [
        (0, "h", "top"), (1, "fragmark1", "zeta eta end"), (0, "text", "after"), (2, "fragmark2", "A\u00fc"), (2, "in", "n")]


def test_plain_cells_are_cut_as_the_parser_walks_them():
    """Cells of plain tags don't enter ``html.parser``; what they give is the same, and other markup still does."""
    import random

    from pairloom.functions import markup_parser as mp

    def walked(html):
        p = mp._Spans()
        p.feed(html)
        p.close()
        return [(para, cls, "".join(parts)) for para, cls, parts in p.spans]

    plain = ['<span class="fragmark1">', "<span>", "</span>", "<p>", '<p class="q">', "</p>", "<br>", "<b>", "</b>", "<div>", "</div>", "<li>", "a. ",
             "b &amp; c", "&am", ">", "\n", "  ", "<hr>", "<td>", "</td>", '<span id="m" class="x" class="y">']
    other = ["<!-- x -->", "<", "<script>", "</script>", "<HR>", "<span class='q'>", '<span class="a&amp;b">', '</p class="x">', "<x-y>", "<hr/>"]
    rng, cut = random.Random(5), 0
    for i in range(6000):
        html = "".join(rng.choice(plain + other * (i % 2)) for _ in range(rng.randint(0, 14)))
        got = mp._plain_spans(html)
        cut += got is not None
        assert got is None or [(para, cls, "".join(parts)) for para, cls, parts in got] == walked(html), html
    assert cut > 3000
    assert mp._plain_spans('<p><!-- <span> --><span class="a">x</span></p>') is None
    assert mp._spans_of('<p><!-- <span> --><span class="a">x</span></p>') == [(1, 0, "a", "x")]


def test_only_annotated_paragraphs_are_cut_into_sentences(spark, monkeypatch):
    from pairloom.functions import markup_parser as mp

    seen, cut = [], mp.sentences_of_spans
    monkeypatch.setattr(mp, "sentences_of_spans", lambda texts: seen.append(1) or cut(texts))
    spans = [(0, "One. Two", "text"), (1, "a Three.", "fragmark1"), (2, "Four five", "fragmark1"), (3, "end. Six.", "text")]
    assert mp.runs_as_they_grow([(0, "One. Two.", "text")], "fragmark") == [] and not seen
    assert mp.runs_as_they_grow(spans, "fragmark") == [
        (0, "fragmark1", "a Three.", None, None, None), (0, "fragmark1", "a Three. Four five", 10, 28, "Two a Three. Four five end.")]
    # the same by the expressions for tables of spans and sentences
    rows = [("u", "src", 1, n, cls, text, len(text)) for n, text, cls in spans]
    table = spark.createDataFrame(rows, "url string, side string, para_no long, span_no long, cls string, text string, len long")
    runs = S.span_runs(S.span_offsets(table))
    assert [tuple(r) for r in S.key_sentences(runs, S.paragraph_sentences(table), runs.select("url", "key")).collect()] == [
        ("u", "src", 1, "fragmark1_a three. four five", "Two a Three. Four five end.")]


def test_a_later_run_replaces_the_keys_it_grows_through(spark):
    spans = ['<span class="fragmark1">Ä b</span><span class="fragmark2">x</span><span class="fragmark1">ä B</span><span class="fragmark1">c</span>',
             '<span class="fragmark1">ä</span><span class="fragmark3">y</span><span class="fragmark1">Ä</span>']
    html = "<td>" + "".join(f"<p>{s}</p>" for s in spans) + "</td>"
    m = S.match_sides(spark.createDataFrame([("u", "src", [html])], "url string, side string, cells array<string>"))
    assert sorted((r["para_no"], r["key"], r["start"], r["end"]) for r in m["runs"].collect()) == [
        (1, "fragmark1_ä b c", 7, 12), (1, "fragmark2_x", 5, 6), (2, "fragmark1_ä", 5, 6), (2, "fragmark3_y", 3, 4)]
    want = S.span_runs(m["offsets"])
    assert sorted(map(tuple, m["runs"].collect())) == sorted(map(tuple, want.select(*m["runs"].columns).collect()))
