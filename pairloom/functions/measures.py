"""Pair measures over token arrays (all built-in array functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bow_difference(tok_a, tok_b) -> Column:
    """M1: size of the symmetric difference of the distinct tokens."""
    a, b = _c(tok_a), _c(tok_b)
    return (F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))).cast("long")


def word_ratio(tok_plag, tok_src) -> Column:
    """M2: tokens(plagiat) / tokens(source), repeats counted; NULL when the
    source has no token (Java would give NaN or Infinity)."""
    return F.try_divide(F.size(_c(tok_plag)).cast("double"), F.size(_c(tok_src)).cast("double"))


def jaccard(tok_a, tok_b) -> Column:
    """M3: |A n B| / |A u B| over token sets; NULL when both are empty."""
    a, b = _c(tok_a), _c(tok_b)
    return F.try_divide(
        F.size(F.array_intersect(a, b)).cast("double"),
        F.size(F.array_union(a, b)).cast("double"),
    )


def inner_identical(plag, src) -> Column:
    """P10 predicate: either lowercased side contains the other (an empty
    side is contained in anything)."""
    p, s = F.lower(_c(plag)), F.lower(_c(src))
    return F.contains(p, s) | F.contains(s, p)


def byte_flag(col) -> Column:
    """M7: a stored one-byte flag as 0/1, not inverted; NULL stays NULL."""
    c = _c(col)
    return F.when(c.isNotNull(), F.when(F.regexp_replace(F.hex(c), "^0+", "") == "", F.lit(0)).otherwise(F.lit(1)))


def decoded(col) -> Column:
    """Bytes as UTF-8 text; malformed input gives NULL instead of an error."""
    return F.when(F.is_valid_utf8(_c(col).cast("string")), _c(col).cast("string"))


def as_number(col, kind: str = "double") -> Column:
    """Text as a number; text that is none gives NULL."""
    return _c(col).try_cast(kind)


def failures(before, after) -> Column:
    """Aggregate counting the rows a lenient step turned into NULL."""
    return F.count_if(_c(before).isNotNull() & _c(after).isNull())
