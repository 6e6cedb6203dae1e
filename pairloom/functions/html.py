"""Markup expressions for stored pages and annotated cells (flat markup).

Everything is regex over the stored HTML (no parser library): tags are
located with patterns that RE2 can mirror, so the DuckDB oracle uses the
same expressions.  Nested markup of the same tag is out of scope here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import text as tx


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _first(col, pattern: str) -> Column:
    v = F.regexp_extract(_c(col), pattern, 1)
    return F.when(v != "", v)


def page_text(col) -> Column:
    """Visible text of a page."""
    return tx.strip_markup(col)


def html_lang(col) -> Column:
    return _first(col, r'<html[^>]*\blang="([^"]*)"')


def title(col) -> Column:
    return tx.strip_markup(_first(col, r"(?is)<title[^>]*>(.*?)</title>"))


def first_heading(col) -> Column:
    """T4 ``h1``: text of the first h1 element."""
    return tx.strip_markup(_first(col, r"(?is)<h1[^>]*>(.*?)</h1>"))


def hrefs(col) -> Column:
    """All href attribute values in document order."""
    return F.regexp_extract_all(_c(col), F.lit(r'<a\b[^>]*\bhref="([^"]*)"'), 1)


def has_class(col, cls: str) -> Column:
    """P19-style flag: an element carries class ``cls``."""
    return _c(col).rlike(r'class="([^"]* )?' + cls + r'( [^"]*)?"')


def absolute_url(href, base) -> Column:
    """Resolve ``href`` against the page URL ``base`` (absolute, root-relative,
    protocol-relative, fragment/query-only and relative forms)."""
    h, b = _c(href), _c(base)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    no_frag = F.regexp_extract(b, r"^([^#]*)", 1)
    no_query = F.regexp_extract(b, r"^([^?#]*)", 1)
    directory = F.regexp_extract(no_query, r"^(.*/)", 1)
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h.startswith("#"), F.concat(no_frag, h))
        .when(h.startswith("?"), F.concat(no_query, h))
        .otherwise(F.concat(F.when(directory != "", directory).otherwise(F.concat(origin, F.lit("/"))), h))
    )


def cut_at_hr(col) -> Column:
    """Markup before the first literal, case-insensitive ``<hr>``."""
    c = _c(col)
    pos = F.locate("<hr>", F.lower(c))
    return F.when(pos > 0, F.substring(c, F.lit(1), pos - 1)).otherwise(c)


P_BLOCK = r"(?s)<p(?: [^>]*)?>(.*?)</p>"
SPAN = r'<span class="([^"]*)">([^<]*)</span>'


def paragraphs(col) -> Column:
    """T8 paragraphs before the first ``<hr>``: element 0 holds the markup
    outside any ``<p>`` (headings), then one element per ``<p>``."""
    pre = cut_at_hr(col)
    inside = F.regexp_extract_all(pre, F.lit(P_BLOCK), 1)
    outside = F.regexp_replace(pre, P_BLOCK, " ")
    return F.concat(F.array(outside), inside)


def spans(col) -> Column:
    """array<struct<cls, text>> of the flat ``<span class="..">text</span>``
    elements of a markup chunk, in document order."""
    cls = F.regexp_extract_all(_c(col), F.lit(SPAN), 1)
    txt = F.regexp_extract_all(_c(col), F.lit(SPAN), 2)
    return F.arrays_zip(cls.alias("cls"), txt.alias("text"))
