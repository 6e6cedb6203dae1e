"""Nested-markup span extraction (T8/T9 with a real HTML parser).

The regex path in ``functions/html.py`` covers flat markup.  For nested
markup these Arrow UDFs walk each cell and return, in document order, every
``span`` before the first ``<hr>`` with its paragraph number (0 = outside any
``<p>``, k = the k-th ``<p>``), its class and its own text (text of its
direct children only, whitespace collapsed).  Spark still partitions the
cells; the Python part is a per-row helper.

A cell is cut at its tags by one regular expression; one that has any other
markup than plain tags (comments, scripts, odd attributes, stray ``<``) is
walked with the standard library's ``html.parser`` instead.  Results are built
as flat Arrow columns, not as an object per span.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("para_no", T.LongType()),
    T.StructField("span_no", T.LongType()),
    T.StructField("cls", T.StringType()),
    T.StructField("text", T.StringType()),
]))

_WS = re.compile(r"[ \t\n\r\f\x0b]+")
#: Start tags that end an open paragraph (fixed values of the HTML syntax).
_BLOCK = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "dd", "dt", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "main", "menu", "nav", "ol", "p", "pre", "section",
          "summary", "table", "ul"}
_VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "col", "area", "base", "source", "track", "embed", "param"}


class _Spans(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int | None]] = []   # (tag, span index or None)
        self.spans: list[list] = []                      # [para, cls, own text parts]
        self.p_count = 0
        self.p_open: list[int] = []
        self.done = False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "hr":
            self.done = True
            return
        if tag == "br":
            self.handle_data(" ")
        if tag in _VOID:
            return
        if tag in _BLOCK and self.p_open:
            self.handle_endtag("p")
        idx = None
        if tag == "p":
            self.p_count += 1
            self.p_open.append(self.p_count)
        elif tag == "span":
            cls = dict(attrs).get("class") or ""
            para = self.p_open[-1] if self.p_open else 0
            self.spans.append([para, cls, []])
            idx = len(self.spans) - 1
        self.stack.append((tag, idx))

    def handle_endtag(self, tag):
        if self.done or tag in _VOID:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                for t, _ in self.stack[k:]:
                    if t == "p" and self.p_open:
                        self.p_open.pop()
                del self.stack[k:]
                return

    def handle_data(self, data):
        if self.done or not self.stack:
            return
        _, idx = self.stack[-1]
        if idx is not None:
            self.spans[idx][2].append(data)


#: A span without tags in it or another plain tag, and the elements whose content is markup like any other: where a cell
#: has nothing else, it is cut at these.
_TAG = re.compile(r'<span((?: [a-z-]+="[^"<>&]*")*)>([^<]*)</span>|<(/?)([a-z]+[1-6]?)((?: [a-z-]+="[^"<>&]*")*)>')
_CLASS = re.compile(r' class="([^"]*)"')
_PLAIN = frozenset("a b big br code dd div dl dt em font h1 h2 h3 h4 h5 h6 i li ol p pre small span strong sub sup table tbody td th tr u ul".split())


def _plain_spans(html: str) -> list[tuple[int, str, list[str]]] | None:
    """(paragraph, class, own text parts) of every span before the first ``<hr>``, as ``_Spans`` has them; null if the cell has other markup."""
    hr = html.find("<hr>")
    stop = len(html) if hr < 0 else hr
    cut = _TAG.split(html[:stop])
    names = cut[4::6]
    whole = names.count(None)
    if html.count("<", 0, stop) != len(names) + whole or not _PLAIN.issuperset(filter(None, names)):
        return None
    spans: list[tuple[int, str, list[str]]] = []
    stack: list[tuple[str, list[str] | None]] = []
    p_open: list[int] = []
    p_count, own = 0, None  # own: the parts of the innermost open element, if it is a span
    coded, classes = "&" in html, {}

    def close(name: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                for t, _ in stack[k:]:
                    if t == "p" and p_open:
                        p_open.pop()
                del stack[k:]
                return

    for text, span, inner, slash, name, attrs in zip(cut[::6], cut[1::6], cut[2::6], cut[3::6], names, cut[5::6]):
        if text and own is not None:
            own.append(entities.unescape(text) if coded else text)
        if name is None:
            cls = classes.get(span)
            if cls is None:
                cls = classes[span] = (_CLASS.findall(span) or [""])[-1]
            spans.append((p_open[-1] if p_open else 0, cls, [entities.unescape(inner) if coded else inner]))
            continue
        if name == "br":
            if not slash and own is not None:
                own.append(" ")
            continue
        if slash:
            if attrs:
                return None
            if stack and stack[-1][0] == name != "p":
                stack.pop()
            else:
                close(name)
            own = stack[-1][1] if stack else None
            continue
        if p_open and name in _BLOCK:
            close("p")
        own = None
        if name == "span":
            own = []
            spans.append((p_open[-1] if p_open else 0, (_CLASS.findall(attrs) or [""])[-1], own))
        elif name == "p":
            p_count += 1
            p_open.append(p_count)
        stack.append((name, own))
    if cut[-1] and own is not None:
        own.append(entities.unescape(cut[-1]) if coded else cut[-1])
    return spans


def _spans_of(html: str | None) -> list[tuple[int, int, str, str]]:
    """(para_no, span_no, cls, text) of a cell's spans."""
    if html is None:
        return []
    spans = _plain_spans(html)
    if spans is None:
        p = _Spans()
        p.feed(html)
        p.close()
        spans = p.spans
    out, per_para = [], {}
    odd = any(c in html for c in "&\t\n\r\f\x0b")  # else blanks are all that can be doubled
    for para, cls, parts in spans:
        n = per_para.get(para, 0)
        per_para[para] = n + 1
        text = parts[0] if len(parts) == 1 else "".join(parts)
        out.append((para, n, cls, (_WS.sub(" ", text) if odd or "  " in text else text).strip(" ")))
    return out


def parse_spans(html: str | None) -> list[dict]:
    return [{"para_no": para, "span_no": n, "cls": cls, "text": text} for para, n, cls, text in _spans_of(html)]


#: Cells worked on at once: only their spans are held as objects.
SLICE = 200


def _arrow(of: Callable[[Iterable], pa.Array], returns, what: pa.DataType):
    """A UDF of a column of cells; ``of`` makes the Arrow column of some of them."""
    def run(cells: pa.Array) -> pa.Array:
        done = [of(cells.slice(i, SLICE).to_pylist()) for i in range(0, len(cells), SLICE)]
        return pa.concat_arrays(done) if done else pa.array([], what)

    run.__annotations__ = {"cells": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, returns)


def _lists(ends: list[int], **columns: tuple[list, pa.DataType] | pa.Array) -> pa.Array:
    """A column of lists of structs from the structs' columns and where every list ends."""
    made = [c if isinstance(c, pa.Array) else pa.array(c[0], c[1]) for c in columns.values()]
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.StructArray.from_arrays(made, names=list(columns)))


_LONG, _TEXT = pa.int64(), pa.string()


def _span_lists(cells: Iterable[str | None]) -> pa.Array:
    rows, ends = [], []
    for html in cells:
        rows += _spans_of(html)
        ends.append(len(rows))
    para, no, cls, text = zip(*rows, strict=True) if rows else ((), (), (), ())
    return _lists(ends, para_no=(para, _LONG), span_no=(no, _LONG), cls=(cls, _TEXT), text=(text, _TEXT))


def _list_of(**fields: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct(list(fields.items())))


_SPAN_LIST = _list_of(para_no=_LONG, span_no=_LONG, cls=_TEXT, text=_TEXT)
spans_udf = _arrow(_span_lists, SPAN_TYPE, _SPAN_LIST)


#: A side's paragraphs: its spans that hold text, with length and running offset (start 1, ``+= len + 1``).
PARAGRAPHS_TYPE = T.ArrayType(T.StructType([
    T.StructField("para_no", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("span_no", T.LongType()),
        T.StructField("cls", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("len", T.LongType()),
        T.StructField("start", T.LongType()),
    ]))),
]))


def parse_paragraphs(cells) -> list[tuple[int, list[tuple[int, str, str]]]]:
    """(para_no, spans of (span_no, text, cls)) of a side; one given in several cells has the spans of all of them in a paragraph, by number."""
    found: dict[int, list[tuple]] = {}
    for html in cells:
        for para, no, cls, text in _spans_of(html):
            if text:
                found.setdefault(para, []).append((no, text, cls))
    return [(para, sorted(found[para])) for para in sorted(found)]


def _paragraph_lists(sides: Iterable[list[str | None]]) -> pa.Array:
    para, ends, span_ends = [], [], []
    no, cls, text, size, start = [], [], [], [], []
    for cells in sides:
        for para_no, spans in parse_paragraphs(cells or ()):
            para.append(para_no)
            at = 1
            for n, t, c in spans:
                no.append(n)
                cls.append(c)
                text.append(t)
                size.append(len(t))
                start.append(at)
                at += len(t) + 1
            span_ends.append(len(no))
        ends.append(len(para))
    spans = _lists(span_ends, span_no=(no, _LONG), cls=(cls, _TEXT), text=(text, _TEXT), len=(size, _LONG), start=(start, _LONG))
    return _lists(ends, para_no=(para, _LONG), spans=spans)


_PARAGRAPH_LIST = _list_of(para_no=_LONG, spans=_list_of(span_no=_LONG, cls=_TEXT, text=_TEXT, len=_LONG, start=_LONG))
#: So declared, no filter is pushed below the parser and nothing merged with it: a cell is made and parsed once.
paragraphs_udf = _arrow(_paragraph_lists, PARAGRAPHS_TYPE, _PARAGRAPH_LIST).asNondeterministic()


_BREAK = re.compile("[.!?] ")  # a sentence ends before the blank


def sentences_of_spans(texts: Iterable[str]) -> list[tuple[int, str]]:
    """The sentences (exclusive end, sent) of a paragraph's text, ' ' + its spans joined by ' ' + ' '; the spans hold no other blanks."""
    whole = " " + " ".join(texts) + " "
    at, out = 0, []
    for stop in (*[m.end() - 1 for m in _BREAK.finditer(whole)], len(whole)):
        sent = whole[at:stop].lstrip(" ")
        start = stop - len(sent)
        sent = sent.rstrip(" ")
        if sent:
            out.append((start + len(sent), sent))
        at = stop
    return out


#: A side's annotation runs (W3) as they grow: every one with its place and the text of its sentences (J6, A13), and
#: before it, without these, the shorter texts that it passes through.  ``n`` numbers the runs of a paragraph.
GROWTH_TYPE = T.ArrayType(T.StructType([
    T.StructField("para_no", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("cls", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("sent", T.StringType()),
]))
_GROWTH_LIST = _list_of(para_no=_LONG, n=_LONG, cls=_TEXT, text=_TEXT, start=_LONG, end=_LONG, sent=_TEXT)


def runs_as_they_grow(spans: list[tuple[int, str, str]], marker: str) -> list[tuple]:
    """(n, cls, text, start, end, sent) of a paragraph's spans (span_no, text, cls)."""
    if not any(c.startswith(marker) for _, _, c in spans):
        return []
    at, runs = 1, []  # runs: (cls, texts, start, end)
    for _, text, cls in spans:
        if cls.startswith(marker):
            if runs and runs[-1][0] == cls:
                runs[-1][1].append(text)
                runs[-1][3] = at + len(text)
            else:
                runs.append([cls, [text], at, at + len(text)])
        at += len(text) + 1
    sentences = sentences_of_spans(t for _, t, _ in spans)
    ends, last = [e for e, _ in sentences], len(sentences) - 1
    out = []
    for n, (cls, texts, start, end) in enumerate(runs):
        grown = texts[0]
        for text in texts[1:]:
            out.append((n, cls, grown, None, None, None))
            grown += " " + text
        first, to = min(bisect_left(ends, start), last), min(bisect_left(ends, end), last)
        out.append((n, cls, grown, start, end, " ".join(s for _, s in sentences[first:to + 1]) if sentences else None))
    return out


def growth_udf(marker: str):
    """``GROWTH_TYPE`` of a side's cells, parsed once as for ``paragraphs_udf``."""
    def grown(sides: Iterable[list[str | None]]) -> pa.Array:
        rows, ends = [], []
        for cells in sides:
            for para_no, spans in parse_paragraphs(cells or ()):
                rows += [(para_no, *r) for r in runs_as_they_grow(spans, marker)]
            ends.append(len(rows))
        para, n, cls, text, start, end, sent = zip(*rows, strict=True) if rows else ((),) * 7
        return _lists(ends, para_no=(para, _LONG), n=(n, _LONG), cls=(cls, _TEXT), text=(text, _TEXT), start=(start, _LONG),
                      end=(end, _LONG), sent=(sent, _TEXT))
    return _arrow(grown, GROWTH_TYPE, _GROWTH_LIST).asNondeterministic()


def _sentence_lists(sides: Iterable[list[str | None]]) -> pa.Array:
    sents, ends = [], [0]
    for cells in sides:
        for _, spans in parse_paragraphs(cells or ()):
            sents += [s for _, s in sentences_of_spans(t for _, t, _ in spans)]
        ends.append(len(sents))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sents, _TEXT))


#: Every sentence of a side's cells, in (paragraph, sentence) order.
sentences_udf = _arrow(_sentence_lists, T.ArrayType(T.StringType()), pa.list_(_TEXT)).asNondeterministic()


def extract_spans_parsed(sides):
    """(url, side, para_no, span_no, cls, text, len) like
    ``spans.extract_spans`` but from a real parse of nested markup."""
    sp = sides.select("url", "side", F.explode(spans_udf("html")).alias("s"))
    sp = sp.select("url", "side", "s.para_no", "s.span_no", "s.cls", "s.text")
    return sp.where(F.length("text") > 0).withColumn("len", F.length("text").cast("long"))
