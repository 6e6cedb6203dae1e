"""Span matching: annotated markup cells -> aligned sentence pairs.

A fragment's side (``plag`` / ``src``) is a row, and steps 1 to 3 and 5 are
done where its cell is parsed (``growth_udf``, ``keyed``): no span and no
sentence of a side leaves the task that made the side's cell, and sentences
are only cut in paragraphs with annotations.  What goes on is a row per key:

1. spans               T8/T9/P13/P14: ``<span>`` elements before the first
                       ``<hr>`` with their own text, from a real parse of
                       nested markup (``markup_parser``); paragraph 0 = spans
                       outside ``<p>``.  ``extract_spans`` is the same for flat
                       markup in built-in expressions
2. ``span_offsets``    W2: running offset, start 1, ``+= len + 1``
3. ``span_runs``       W3: consecutive annotation spans of one class form a
                       run (plain spans between them do not break it); key =
                       class + '_' + lowered texts; A16 later offsets win
4. ``common_keys``     J1: keys present on both sides of a fragment
5. ``key_sentences``   J6/A13: a run maps to the sentences of its paragraph
                       text from the first sentence whose end >= start to the
                       first whose end >= end (else the last sentence)
6. ``last_wins``       A15: a later paragraph overwrites a key's sentence
7. ``paired``          J2/W1: inner join of the sides on (url, key); the
                       pair number ``i`` is the key's rank in binary order

``span_runs``, ``paragraph_sentences`` and ``key_sentences`` are the same
rules for tables of spans, runs and sentences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom import fixed
from pairloom.functions import html as H
from pairloom.functions import text as tx
from pairloom.functions.markup_parser import growth_udf, paragraphs_udf, sentences_udf

SIDE_KEY = ["url", "side", "para_no"]


def fragment_sides(fragments: DataFrame) -> DataFrame:
    """(url, side, html) with side in {'plag', 'src'}."""
    return fragments.select(
        "url",
        F.explode(F.array(
            F.struct(F.lit("plag").alias("side"), F.col("raw_plagiat_text").alias("html")),
            F.struct(F.lit("src").alias("side"), F.col("raw_source_text").alias("html")),
        )).alias("s"),
    ).select("url", "s.side", "s.html")


def extract_spans(sides: DataFrame) -> DataFrame:
    """(url, side, para_no, span_no, cls, text, len) for non-blank spans."""
    paras = sides.select("url", "side", F.posexplode(H.paragraphs("html")).alias("para_no", "chunk"))
    sp = paras.select("url", "side", "para_no", F.posexplode(H.spans("chunk")).alias("span_no", "s"))
    sp = sp.select(
        "url", "side", F.col("para_no").cast("long").alias("para_no"), F.col("span_no").cast("long").alias("span_no"),
        F.col("s.cls").alias("cls"), tx.squeeze_ws(F.col("s.text")).alias("text"),
    )
    return sp.where(F.length("text") > 0).withColumn("len", F.length("text").cast("long"))


def span_offsets(spans: DataFrame) -> DataFrame:
    """start = 1 + sum(len + 1) of the earlier spans of the paragraph."""
    w = Window.partitionBy(*SIDE_KEY).orderBy("span_no").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.lit(1) + F.coalesce(F.sum(F.col("len") + 1).over(w), F.lit(0))).cast("long")
    return spans.withColumn("start", start).withColumn("end", F.col("start") + F.col("len"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs_of(spans: Column, marker: str = fixed.ANNOTATION_CLASS_PREFIX) -> Column:
    """W3 + A16: the merged annotation runs (key, start, end) of a paragraph's ordered spans."""
    def entries(run, n):
        key = lambda texts: F.concat(F.get(run, F.lit(0))["cls"], F.lit("_"), F.array_join(texts, " "))
        place = F.struct(F.array_min(F.transform(run, lambda s: s["start"])).alias("start"),
                         F.array_max(F.transform(run, lambda s: s["start"] + s["len"])).alias("end"))
        gone = F.lit(None).cast("struct<start:bigint,end:bigint>").alias("o")

        def of(texts):
            # A run passes through the keys of its own beginnings: each growth of a run
            # replaces the key it had, also where an earlier run of the paragraph ended
            # with that very key.  A16: of the runs that end with a key the last counts.
            passed = F.transform(F.slice(texts, 2, F.size(texts)), lambda _, k: F.struct(
                key(F.slice(texts, F.lit(1), k + 1)).alias("key"), n.alias("n"), gone))
            return F.concat(F.array(F.struct(key(texts).alias("key"), n.alias("n"), place.alias("o"))), passed)
        return _let(F.transform(run, lambda s: F.lower(s["text"])), of)

    def cut(marked):
        first = F.transform(marked, lambda s, i: F.when((i == 0) | ~F.get(marked, i - 1)["cls"].eqNullSafe(s["cls"]), i))
        return _let(F.filter(first, lambda i: i.isNotNull()), lambda starts: F.transform(
            starts, lambda at, n: F.slice(marked, at + 1, F.coalesce(F.get(starts, n + 1), F.size(marked)) - at)))

    def last(found):
        kept = F.filter(found, lambda e, i: e["o"].isNotNull() & ~F.coalesce(F.get(found, i + 1)["key"] == e["key"], F.lit(False)))
        return F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["o"]["start"].alias("start"), e["o"]["end"].alias("end")))

    runs = _let(F.filter(spans, lambda s: s["cls"].startswith(marker)), cut)
    return _let(F.array_sort(F.flatten(F.transform(runs, entries))), last)


def text_of(spans: Column) -> Column:
    """A paragraph's text: ' ' + its ordered spans joined by ' ' + ' '."""
    return F.concat(F.lit(" "), F.array_join(F.transform(spans, lambda s: s["text"]), " "), F.lit(" "))


def sentences_of(text: Column) -> Column:
    """The sentences (start, end, sent) of a text, 0-based start, exclusive end."""
    def step(acc, piece):
        def add(sent):
            start = acc["at"] + F.length(piece) - F.length(F.regexp_replace(piece, "^" + tx.WS + "+", ""))
            one = F.struct(start.cast("long").alias("start"), (start + F.length(sent)).cast("long").alias("end"), sent.alias("sent"))
            return F.when(sent != "", F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(piece)).cast("long").alias("at"), _let(tx.trim_ws(piece), add).alias("out"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,sent:string>>")
    return F.aggregate(tx.sentence_pieces(text), F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def sentence_range(sentences: Column, start: Column, end: Column) -> Column:
    """J6 + A13: the ordered sentences from the first with end >= start to the first with end >= ``end``, else the last; null without any."""
    hit = lambda pos: F.least(F.size(F.filter(sentences, lambda s: s["end"] < pos)), F.size(sentences) - 1)
    found = F.transform(F.slice(sentences, hit(start) + 1, hit(end) - hit(start) + 1), lambda s: s["sent"])
    return F.when(F.size(sentences) > 0, F.array_join(found, " "))


def keyed(growth: Column) -> Column:
    """W3 + A16: the runs (para_no, key, start, end) of a side, each with the text ``sent`` of its sentences, from its runs as they grow.

    A run passes through the keys of its own beginnings: each growth of a run
    replaces the key it had, also where an earlier run of the paragraph ended
    with that very key.  Of the runs that end with a key the last counts.
    """
    def last(found):
        same = lambda e, o: F.coalesce((o["para_no"] == e["para_no"]) & (o["key"] == e["key"]), F.lit(False))
        kept = F.filter(found, lambda e, i: e["start"].isNotNull() & ~same(e, F.get(found, i + 1)))
        return F.transform(kept, lambda e: F.struct(*[e[c].alias(c) for c in ("para_no", "key", "start", "end", "sent")]))

    entries = F.transform(growth, lambda e: F.struct(
        e["para_no"].alias("para_no"), F.concat(e["cls"], F.lit("_"), F.lower(e["text"])).alias("key"), e["n"].alias("n"),
        e["start"].alias("start"), e["end"].alias("end"), e["sent"].alias("sent")))
    return _let(F.sort_array(entries), last)


def side_spans(sides: DataFrame) -> DataFrame:
    """(url, side, paragraphs, growth) of (url, side, cells), a row a side: its parsed spans, and its runs as they grow; what isn't read isn't made."""
    return sides.select("url", "side", paragraphs_udf("cells").alias("paragraphs"), growth_udf(fixed.ANNOTATION_CLASS_PREFIX)("cells").alias("growth"))


def span_rows(spans: DataFrame) -> DataFrame:
    """(url, side, para_no, span_no, cls, text, len) of ``side_spans``."""
    paras = spans.select("url", "side", F.explode("paragraphs").alias("p"))
    return paras.select("url", "side", "p.para_no", F.explode("p.spans").alias("s")).select(
        *SIDE_KEY, "s.span_no", "s.cls", "s.text", "s.len")


def _paragraph_spans(spans: DataFrame, *columns: str) -> DataFrame:
    return spans.groupBy(*SIDE_KEY).agg(F.array_sort(F.collect_list(F.struct("span_no", *columns))).alias("spans"))


def span_runs(offsets: DataFrame, marker: str = fixed.ANNOTATION_CLASS_PREFIX) -> DataFrame:
    """W3 + A16: merged annotation runs, one row per (url, side, para, key)."""
    marked = offsets.where(F.col("cls").startswith(marker)).withColumn("len", F.col("end") - F.col("start"))
    runs = _paragraph_spans(marked, "start", "cls", "text", "len").select(*SIDE_KEY, F.explode(runs_of(F.col("spans"), marker)).alias("r"))
    return runs.select(*SIDE_KEY, "r.key", "r.start", "r.end")


def common_keys(runs: DataFrame) -> DataFrame:
    """(url, key) present on both sides."""
    on = lambda side: F.max((F.col("side") == side).cast("int"))
    both = runs.groupBy("url", "key").agg(on("plag").alias("p"), on("src").alias("s")).where("p = 1 and s = 1")
    return both.where(F.col("url").isNotNull() & F.col("key").isNotNull()).select("url", "key")


def key_counts(runs: DataFrame, common: DataFrame) -> DataFrame:
    """A4: per fragment, common keys and total source annotations."""
    total = runs.where(F.col("side") == "src").groupBy("url").agg(F.count("*").alias("n_src_annotations"))
    n_common = common.groupBy("url").agg(F.count("*").alias("n_common"))
    return total.join(n_common, "url", "full").select(
        "url", F.coalesce("n_common", F.lit(0)).alias("n_common"),
        F.coalesce("n_src_annotations", F.lit(0)).alias("n_src_annotations"),
    )


def side_counts(runs: DataFrame) -> DataFrame:
    """P20: per fragment the annotation keys of both sides, those without a partner, and whether the sides are of equal size.

    Keys are reduced to one row per (fragment, key) with a flag per side, then
    counted: aggregations with map-side combine, no join.
    """
    on = lambda side: F.max((F.col("side") == side).cast("int")).cast("long").alias(side)
    keys = runs.groupBy("url", "key").agg(on("plag"), on("src"))
    return keys.groupBy("url").agg(
        F.sum("plag").alias("n_plag"), F.sum("src").alias("n_src"), F.count_if(F.col("plag") != F.col("src")).alias("n_unmatched"),
    ).withColumn("sizes_equal", F.col("n_plag") == F.col("n_src"))


def paragraph_sentences(spans: DataFrame) -> DataFrame:
    """(url, side, para_no, ix, start, end, sent) of each paragraph text."""
    sents = _paragraph_spans(spans, "text").select(*SIDE_KEY, F.posexplode(sentences_of(text_of(F.col("spans")))).alias("ix", "s"))
    return sents.select(*SIDE_KEY, F.col("ix").cast("long").alias("ix"), "s.start", "s.end", "s.sent")


def key_sentences(runs: DataFrame, sentences: DataFrame, common: DataFrame) -> DataFrame:
    """J6 + A13: sentence text for every common key of every paragraph."""
    r = runs.join(common, ["url", "key"], "left_semi").groupBy(*SIDE_KEY).agg(F.collect_list(F.struct("key", "start", "end")).alias("runs"))
    s = sentences.groupBy(*SIDE_KEY).agg(F.array_sort(F.collect_list(F.struct("ix", "end", "sent"))).alias("sents"))
    found = F.transform("runs", lambda x: F.struct(x["key"].alias("key"), sentence_range(F.col("sents"), x["start"], x["end"]).alias("sent")))
    return r.join(s, SIDE_KEY).select(*SIDE_KEY, F.explode(found).alias("f")).select(*SIDE_KEY, "f.key", "f.sent").where("sent is not null")


def common_key_sentences(kept: DataFrame, common: DataFrame) -> DataFrame:
    """``key_sentences`` of runs that have their sentences with them (``keyed``)."""
    k = kept.select("url", "side", F.explode("runs").alias("r")).select(*[F.col(c) for c in ("url", "side")], "r.para_no", "r.key", "r.sent")
    return k.where("sent is not null").join(common, ["url", "key"], "left_semi").select(*SIDE_KEY, "key", "sent")


def last_wins(key_sents: DataFrame) -> DataFrame:
    """Per (url, side, key) the sentence of the last paragraph."""
    return key_sents.groupBy("url", "side", "key").agg(F.max_by("sent", "para_no").alias("sent"))


def paired(key_text: DataFrame) -> DataFrame:
    """J2 + W1: (url, i, key, plagiat_sent, source_sent).

    Only keys of both sides have a text; a text without a partner ends the run (P20).
    """
    from pairloom.plans.checks import paired_or_stop

    p = key_text.where(F.col("side") == "plag").select("url", "key", F.col("sent").alias("plagiat_sent"))
    s = key_text.where(F.col("side") == "src").select("url", "key", F.col("sent").alias("source_sent"))
    j = paired_or_stop(p, s, ["url", "key"], "the sides of a fragment have different annotations")
    w = Window.partitionBy("url").orderBy("key")
    return j.select("url", (F.row_number().over(w) - 1).cast("long").alias("i"), "key", "plagiat_sent", "source_sent")


def match_fragments(fragments: DataFrame, cut=lambda df: df) -> dict[str, DataFrame]:
    """Steps 1-7: every intermediate by name.

    ``cut`` is applied to the intermediates that feed several later steps
    (runs with their sentences, key texts); the pipeline passes a checkpoint
    there so each later plan starts from a written table.
    """
    return match_sides(merged_cells(fragment_sides(fragments)), cut)


def merged_cells(sides: DataFrame) -> DataFrame:
    """(url, side, cells) of (url, side, html): a row a side, whatever the rows of a url."""
    return sides.groupBy("url", "side").agg(F.collect_list("html").alias("cells"))


def match_sides(sides: DataFrame, cut=lambda df: df, asked: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """``match_fragments`` of the sides (url, side, cells), a row a side.

    ``asked`` gives the source sides (url, cells and the columns of a table by
    url) of the urls of that table; by default they are joined.
    """
    return Matched(sides, cut, asked)


class Matched(dict):
    """The matcher's tables by name, each made (and cut) when it is first asked for."""

    def __init__(self, sides: DataFrame, cut: Callable[[DataFrame], DataFrame], asked: Callable[[DataFrame], DataFrame] | None = None):
        super().__init__()
        self.sides, self.cut, self.kept = sides, cut, None
        self.asked = asked or (lambda asks: sides.where("side = 'src'").drop("side").join(asks, "url"))

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._made(name)
        return self[name]

    def _keyed(self) -> DataFrame:
        """(url, side, runs): all that is kept of a side's cell."""
        if self.kept is None:
            self.kept = self.cut(self["spans"].select("url", "side", keyed(F.col("growth")).alias("runs")))
        return self.kept

    def _made(self, name: str) -> DataFrame:
        match name:
            case "spans":
                return side_spans(self.sides)
            case "offsets":
                return span_offsets(span_rows(self["spans"]))
            case "runs":
                return self._keyed().select("url", "side", F.explode("runs").alias("r")).select(*SIDE_KEY[:2], "r.para_no", "r.key", "r.start", "r.end")
            case "common":
                return common_keys(self["runs"])
            case "sentences":
                return paragraph_sentences(span_rows(self["spans"]))
            case "key_sentences":
                return common_key_sentences(self._keyed(), self["common"])
            case "key_text":
                return self.cut(last_wins(self["key_sentences"]))
            case "paired":
                return paired(self["key_text"])
        raise KeyError(name)

    def source_sentences(self, asks: DataFrame) -> DataFrame:
        """A row of ``asks`` by url with ``sents``, every sentence of its source side; the cells are parsed again, not kept."""
        found = self.asked(asks).withColumn("sents", sentences_udf("cells"))
        return found.select("url", *[c for c in asks.columns if c != "url"], "sents")
