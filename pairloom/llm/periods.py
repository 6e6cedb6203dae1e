"""Periodic run detection on tiles of one octave of periods each.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(``LEAST``, 3 * q) that no neighbouring word extends.  Where words
i and i + q are equal, i is a match of q; a run is a longest stretch of at
least max(``LEAST`` - q, 2 * q) matches.

1. Tiles: for the periods of an octave [s, 2 s) (the first takes 1 to 2 s) a
   text is cut into centres of s words.  The matches of a run are long enough
   to hold a whole centre.  A tile is a centre with s words before it and 3 s
   after it, so neighbouring tiles overlap.  Tiles leave their document as
   rows of word numbers, if the hash of the centre comes again at a distance
   of the octave; others cannot hold a run (equal words have equal hashes).
2. Tiles are dealt over all tasks and solved one by one.  The Z-function from
   the centre's start gives the matches to the right for all periods of the
   octave at once; that of the reversed words, those to the left.  A period
   for which the whole centre matches gives an interval fragment, unless the
   words of one period are a repeated shorter one (then that period has the
   same run).
3. Fragments are shuffled by document and period and stitched where they
   overlap; of equal stretches the smallest period stays.

Documents without such a tile are finished where they are read; only the texts
of the others move, once, to meet their runs.  A document is known by its
doc_id and the SHA-256 of its text.

Defined results: null, empty and blank texts have no words and no runs, and
the digests of the empty string; words of a row without doc_id are not
repeated first; rows that share a doc_id are judged each on its own; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import partitions, store

#: The least length of a run, and the words of the smallest centre (LEAST + 1 >= 3 * BASE holds every short period).
LEAST, BASE = 24, 8


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def source_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place, where the contract's rule repeats words of this document; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def document_words(doc_id: int | None, text: str | None, rule=source_words) -> list[bytes]:
    w = words(text)
    at = rule(doc_id, len(w))
    return w if at is None else [w[i] for i in at.tolist()]


def numbered(w: list[bytes]) -> np.ndarray:
    """Word numbers: equal for equal words only."""
    table: dict[bytes, int] = {}
    return np.fromiter((table.setdefault(x, len(table)) for x in w), np.int64, len(w))


def _join(h: np.ndarray, s: int) -> np.ndarray:
    """Hashes of 2 s words from those of s words."""
    out = h[:-s] * np.uint64(0x9E3779B97F4A7C15) + h[s:]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def tiles(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(s, centre start) of the tiles whose centre's hash comes again at a distance of their octave."""
    n = len(codes)
    if n < LEAST:
        return
    h, s = codes.astype(np.uint64) + np.uint64(1), 1
    while s < BASE:
        h, s = _join(h, s), 2 * s
    while len(h) > s and 3 * s <= max(n, LEAST):
        whole = -(-len(h) // s) * s
        at = np.zeros(whole, np.uint64)
        at[:len(h)] = h
        grid = at.reshape(-1, s)  # row j: the hashes at the centre j and its s - 1 followers
        near = (grid[1:] == grid[:-1, :1]).any(axis=1)
        if s == BASE:  # shorter periods, too
            near |= (grid[:-1, 1:] == grid[:-1, :1]).any(axis=1)
            if (grid[-1, 1:] == grid[-1, 0]).any():
                yield s, (len(grid) - 1) * s
        for j in np.flatnonzero(near).tolist():
            yield s, j * s
        if len(h) <= s:
            return
        h, s = _join(h, s), 2 * s


def z_function(x: list[int]) -> list[int]:
    """z[i]: how many elements from i on equal those from 0 on (z[0] = len(x))."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def repeats(z: list[int], q: int) -> bool:
    """Whether the first q elements are a shorter word, repeated."""
    return any(q % p == 0 and z[p] >= q - p for p in range(1, q // 2 + 1))


def solve(block: list[int], centre: int, s: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the matches around a wholly matching centre; places count from the block's start.

    At most s places before the centre and s after it are looked at: where there are more, the neighbouring centre matches, too.
    """
    right = z_function(block[centre:])
    # The words before the centre, backwards, then (after a sign that is no word) all words of the block, backwards.
    back = block[:centre][::-1]
    left = z_function([*back, -1, *block[::-1]]) if back else []
    out = []
    for q in range(1 if s == BASE else s, min(2 * s, len(right) - s + 1)):
        if right[q] >= s and not repeats(right, q):
            before = left[len(back) + 1 + len(block) - centre - q] if back else 0
            out.append((q, centre - min(before, s), centre + min(right[q], 2 * s)))
    return out


def covered(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words (start, length, period) runs hold after their first period."""
    d = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        d[start + period] += 1
        d[start + length] -= 1
    return np.cumsum(d[:n]) > 0


def digest(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


ROWS = "row binary, doc_id long, text string, collapsed string, s int, at int, centre int, block binary"


def _read(documents: DataFrame, rule) -> DataFrame:
    """Rows of documents (``s`` is null; ``collapsed`` for those without tiles, ``text`` for the others) and of their tiles."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    docs = documents.select(F.unhex(F.sha2(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(" "), text), 256)).alias("row"),
                            doc.alias("doc_id"), text.alias("text"))
    columns = [c.split()[0] for c in ROWS.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "s": "Int32", "at": "Int32", "centre": "Int32"})

        for pdf in batches:
            out, size = [], 0
            for row, doc_id, text in zip(pdf["row"], pdf["doc_id"], pdf["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                w = document_words(doc_id, text, rule)
                codes, any_tile = numbered(w), False
                for s, c in tiles(codes):
                    any_tile, low = True, max(0, c - s)
                    block = codes[low:c + 4 * s].astype("<i4").tobytes()
                    out.append((row, None, None, None, s, low, c - low, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield frame(out)
                        out, size = [], 0
                out.append((row, doc_id, text if any_tile else None, None if any_tile else digest(b" ".join(w)), None, None, None, None))
            yield frame(out)

    return store(docs.mapInPandas(rows, ROWS), "period_rows")


def _fragments(tiled: DataFrame) -> DataFrame:
    """(row, period, first, last): stretches of matches seen from one tile."""

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row, s, at, centre, block in zip(pdf["row"], pdf["s"], pdf["at"], pdf["centre"], pdf["block"], strict=True):
                for q, first, last in solve(np.frombuffer(block, "<i4").tolist(), centre, s):
                    out.append((row, q, at + first, at + last))
            yield pd.DataFrame(out, columns=["row", "period", "first", "last"])

    # Dealt in turn and not by key: equal rows have equal keys.
    dealt = tiled.select("row", "s", "at", "centre", "block").repartition(partitions(tiled.sparkSession))
    return dealt.mapInPandas(solved, "row binary, period int, first int, last int")


def stitch(fragments: DataFrame) -> DataFrame:
    """(row, start, length, period): runs, from fragments that overlap where they belong together."""
    # Equal rows of a table give equal fragments; one of each is enough.
    once = fragments.distinct()
    along = Window.partitionBy("row", "period").orderBy("first", "last")  # bounded by one text
    before = F.coalesce(F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    part = F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    whole = (once.withColumn("new", (F.col("first") > before).cast("int")).withColumn("part", part).groupBy("row", "period", "part").agg(F.min("first").alias("start"), F.max("last").alias("last"))
             .select("row", "start", (F.col("last") + F.col("period") - F.col("start")).alias("length"), "period")
             .filter((F.col("length") >= LEAST) & (F.col("length") >= 3 * F.col("period"))))
    return whole.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


FOUND = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
         "collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def find_runs(documents: DataFrame, rule=source_words) -> DataFrame:
    """The digests of every row with its ``runs`` and, where it has any, its ``collapsed`` words.

    ``rule`` says which words a document consists of (``lambda doc_id, n: None``: just its own).
    """
    rows = _read(documents, rule)
    tiled = rows.filter("s is not null")
    runs = stitch(_fragments(tiled)).groupBy("row").agg(F.collect_list(F.struct("start", "period", "length")).alias("found"))
    done = rows.filter("s is null and collapsed is not null")
    open_ = rows.filter("s is null and collapsed is null").select("row", "doc_id", "text")
    both = open_.join(runs, "row", "left").select("doc_id", "text", F.col("found.start").alias("starts"),
                                                  F.col("found.period").alias("periods"), F.col("found.length").alias("lengths"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, *found in zip(pdf["doc_id"], pdf["text"], pdf["starts"], pdf["periods"], pdf["lengths"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                w = document_words(doc_id, text, rule)
                own = sorted(zip(*(x.tolist() for x in found), strict=True)) if found[0] is not None else []
                own = [(start, length, period) for start, period, length in own]
                kept = [x for x, gone in zip(w, covered(own, len(w)).tolist(), strict=True) if not gone]
                best = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in own).encode()
                out.append((doc_id, len(own), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest(listed),
                            digest(b" ".join(kept)), [dict(zip(("start", "length", "period"), r, strict=True)) for r in own],
                            b" ".join(kept).decode("utf-8", "replace") if own else None))
            names = [c.split()[0] for c in FOUND.split(", ")]
            got = pd.DataFrame(out, columns=names)
            yield got.astype(dict.fromkeys(("doc_id", "n_runs", "start", "length", "period", "exponent_milli"), "Int64"))

    none = F.lit(None).cast("long")
    plain = done.select("doc_id", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"), none.alias("period"),
                        none.alias("exponent_milli"), F.lit(digest(b"")).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
                        F.array().cast("array<struct<start:long,length:long,period:long>>").alias("runs"), F.lit(None).cast("string").alias("collapsed"))
    return plain.unionByName(both.mapInPandas(finish, FOUND))


def run_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent, and the digests of all runs and of the words left."""
    return find_runs(documents).drop("runs", "collapsed")
