"""Lead pairs, fragments and term counts that move no text once per fragment."""

from pyspark.sql import functions as F

from pairloom.operators import spans as S
from pairloom.operators import tfidf as TF
from pairloom.sources import adapters

TEXTS = [
    "The old house stands near a river. It is big & old. We saw the man there today.",
    "The old house fell down last year again. We saw the man there twice, oh. It is big <now> here.",
    "We saw the man there never. The old house was sold to me. Short one.",
]


def _docs(spark):
    rows = [(i, t, "en", "web") for i, t in enumerate(TEXTS * 2)] + [(3, TEXTS[1], "en", "web"), (9, None, "en", "web"), (None, TEXTS[0], "en", "web")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_lead_pairs_move_no_tokens(spark):
    seen = []
    pairs = adapters.lead_pairs(_docs(spark), cut=lambda df: seen.append(df.columns) or df)
    assert seen == [["lang", "lead_key", "sent", "doc_id", "ix", "source"]]
    rows = pairs.collect()
    assert rows and all(r["src_doc"] != r["plag_doc"] and r["src_tok"][:3] == r["source_sent"].split()[:3] for r in rows)
    assert all(" ".join(r["plag_tok"][:3]).lower() == r["lead_key"] for r in rows)


def test_cells_of_the_index_are_the_cells_of_the_fragments(spark):
    docs = _docs(spark)
    pairs = adapters.lead_pairs(docs)
    sents = adapters.document_sentences(adapters.tokenized_sentences(docs))
    index = adapters.fragment_index(docs, pairs, sents)
    assert not {"text", "html", "raw_source_text"} & set(index.columns)
    f = adapters.fragments_of(index, docs, sents)
    want = sorted(map(tuple, S.fragment_sides(f).collect()))
    got = sorted(map(tuple, adapters.fragment_cells(index, sents).select("url", "side", "html").collect()))
    assert got == want and any(u.startswith("doc/") for u, _, _ in got) and any(u.startswith("edit/") for u, _, _ in got)
    assert all(h.startswith('<td><span class="text">Head of ') and "fragmark" in h for _, _, h in got)
    assert adapters.fragment_names(index).count() == f.count()


def test_matcher_makes_only_what_is_asked_for(spark):
    html = '<td><p><span class="fragmark1">one two</span><span class="text">three four.</span></p></td>'
    m = S.match_fragments(spark.createDataFrame([("u", html, html)], ["url", "raw_plagiat_text", "raw_source_text"]))
    assert not m and m["runs"].count() == 2 and set(m) == {"spans", "runs"}
    assert m["paired"].count() == 1


def test_weights_from_digests_are_those_of_the_texts(spark):
    docs = _docs(spark).where("doc_id is not null")
    want, vocab = TF.tfidf_weights(docs, ["doc_id"], min_df=1, max_df=5)
    named = docs.select("doc_id", TF.text_digest("text").alias("digest"))
    got, vocab2 = TF.tfidf_weights(named, ["doc_id"], min_df=1, max_df=5, texts=docs.select("text"))
    rounded = lambda w: sorted(map(tuple, w.withColumn("weight", F.round("weight", 9)).collect()))
    assert rounded(got) == rounded(want) and sorted(map(tuple, vocab.collect())) == sorted(map(tuple, vocab2.collect()))


def test_no_span_and_no_sentence_of_a_side_is_kept(spark):
    from pairloom.plans.annotations import build_annotations

    html = lambda w: ('<td><p><span class="fragmark1">one two</span><span class="text">three four five ' + w + '. Here are some more words to pick.</span></p></td>')
    f = spark.createDataFrame([("u", html("six"), html("seven"), "f", "en", "en", "t")],
                              "url string, raw_plagiat_text string, raw_source_text string, fragment_identifier string, lang_source string, lang_plagiat string, type string")
    seen = []
    ann, _ = build_annotations(f, cut=lambda df: seen.append(df.columns) or df)
    assert [r["fake_source_sent"] for r in ann.collect()] == ["Here are some more words to pick."]
    assert seen == [["url", "side", "runs"], ["url", "side", "key", "sent"], ["url", "i", "key", "plagiat_sent", "source_sent"],
                    ["url", "i", "n_acceptable", "fake"]]


def test_side_cells_come_as_often_as_their_fragment(spark):
    docs = _docs(spark)
    sents = adapters.document_sentences(adapters.tokenized_sentences(docs))
    index = adapters.fragment_index(docs, adapters.lead_pairs(docs), sents)
    rows = adapters.side_cells(index, sents).collect()
    assert len({(r["url"], r["side"]) for r in rows}) == len(rows)
    got = sorted((r["url"], r["side"], c) for r in rows for c in r["cells"])
    assert got == sorted(map(tuple, adapters.fragment_cells(index, sents).select("url", "side", "html").collect())) and len(got) > len(rows)


def test_stored_sentences_hold_lead_keys_and_no_tokens(spark, tmp_path):
    from pairloom.plans import stages

    docs = spark.createDataFrame([(i % 4, f"The same three words begin sentence number {i} here. Another short one of seven words.", "en", "s")
                                  for i in range(6)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stored = stages.sentences(spark, str(tmp_path))
    assert "tok" not in stored.columns and "lead_key" in stored.columns
    tokens = adapters.tokenized_sentences(docs)
    for of in (lambda s: adapters.lead_pairs(docs, tok_sentences=s), lambda s: adapters.document_sentences(s).select("doc_id", "first")):
        kept, made = of(stored), of(tokens)
        assert kept.count() > 0 and kept.exceptAll(made).isEmpty() and made.exceptAll(kept).isEmpty()


def test_stages_give_python_few_rows(spark):
    import pandas as pd

    from pairloom.plans import stages

    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = spark.range(3 * stages.CELL_ROWS, numPartitions=1).mapInPandas(sizes, "n long")
    assert {r["n"] for r in stages.materialize(rows).collect()} == {stages.CELL_ROWS}
