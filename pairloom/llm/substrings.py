"""Substring dedup with automata of repeated phrases.

A window is ``window`` consecutive words of a document.  A word goes when some
window over it also starts in a document with a smaller doc_id.

1. Every window is represented by the phrase (``PHRASE`` words) in it whose
   hash is least; equal windows have equal phrases.  Phrases held by two
   documents or more are the confirmed recurring ones (one aggregation with
   map-side combine).  A bitmap of fixed size carries them to the tasks.
2. Documents that hold one are dealt into shards by their least recurring
   phrase, so copies meet; a phrase of very many documents is split by
   document.  A shard compiles its phrases into an Aho-Corasick automaton and
   streams its documents through it to locate every occurrence.
3. Windows around located phrases are compared by 128 bits, made of two
   independent 64-bit hashes of every word: first inside the shard (all but
   the first document's are settled there), then the rest across shards by an
   aggregation and a join.

Phrases are located on the words themselves; windows that agree in all 128 bits
are taken as equal.

Documents without a recurring phrase leave in step 2 with all their words.

Defined results: null, empty and wordless texts have no words and keep the
empty string; a text under ``window`` words keeps all; rows that share a
doc_id do not remove each other's words; rows without doc_id neither remove
nor lose words; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Bits, bitmap, hashed_texts, only, replace_rows, store, window_hash

WINDOW, PHRASE = 13, 5
#: Bytes of text that one automaton serves, and log2 of the bitmap of recurring phrases.
SHARD_BYTES, BITS = 4 << 20, 26
#: A phrase in more than this part of the phrase entries is split by document (so at most 1 / HOT phrases are).
HOT = 1e-4


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def hashes(texts: Iterable[str | None], seed: int = 0) -> Iterator[np.ndarray]:
    return hashed_texts(((x or "").encode("utf-8", "replace") for x in texts), seed)


def least_phrases(h: np.ndarray, window: int) -> np.ndarray:
    """The hash of the least phrase of every window."""
    phrase = min(PHRASE, window)
    k, left = window_hash(h, phrase, 3), window - phrase
    span = 1  # k[i] is the least of span phrases from i on
    while span <= left:
        step = min(span, left + 1 - span)
        k = np.minimum(k[:-step], k[step:])
        span += step
    return k


def recurring_phrases(docs: DataFrame, window: int) -> DataFrame:
    """(key, n): phrases that represent windows of at least two documents, and of how many rows."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h in hashes(pdf["text"]):
                out.append(np.unique(least_phrases(h, window)).view(np.int64) if len(h) >= window else np.empty(0, np.int64))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "keys": out})

    rows = docs.filter("doc_id is not null").mapInPandas(keys, "doc_id long, keys array<bigint>")
    return store(rows.select("doc_id", F.explode("keys").alias("key")).groupBy("key")
                 .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n"))
                 .filter("a <> b").select("key", "n"), "sub_phrases")


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words the windows at ``starts`` cover."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + window, -1)
    return np.cumsum(d[:n]) > 0


def finished(w: list[bytes], gone: np.ndarray) -> tuple[int, int, str | None, str]:
    """n_words, n_removed, the kept words joined by one blank (None: all of them) and their SHA-256."""
    lost = int(gone.sum())
    kept = b" ".join(compress(w, (~gone).tolist()) if lost else w)
    return len(w), lost, kept.decode("utf-8", "replace") if lost else None, hashlib.sha256(kept).hexdigest()


def locate(texts: list[list[bytes]], phrases: set[bytes]) -> list[np.ndarray]:
    """Positions (in words) where any of the phrases stands, per text, by one automaton."""
    import ahocorasick

    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        machine.add_word(f" {p.decode('utf-8', 'replace')} ")
    machine.make_automaton()
    out = []
    for w in texts:
        line = f" {b' '.join(w).decode('utf-8', 'replace')} "
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 32)  # blank i stands before word i
        first = np.array([end - size + 1 for end, size in machine.iter(line)], np.int64)
        out.append(np.searchsorted(blanks, first))
    return out


SCREENED = "rid long, doc_id long, shard long, text string, n_words long, digest string"
SETTLED = ("rid long, doc_id long, n_words long, n_removed long, kept string, digest string, starts binary, "
           "h1 array<bigint>, h2 array<bigint>, at array<int>")


def _screen(docs: DataFrame, window: int, recurring: Bits, hot: dict[int, int]) -> DataFrame:
    """Rows with a recurring phrase get a shard; the others are finished here."""
    shared = docs.sparkSession.sparkContext.broadcast((recurring, hot))  # 2^BITS bits, at most 1 / HOT keys

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, parts = shared.value
        for pdf in batches:
            out = []
            for rid, doc, text, h in zip(pdf["rid"], pdf["doc_id"], pdf["text"], hashes(pdf["text"]), strict=True):
                keys = np.unique(least_phrases(h, window)) if len(h) >= window and not pd.isna(doc) else np.empty(0, np.uint64)
                keys = keys[bits.has(keys)].view(np.int64)
                if not len(keys):
                    w = words(text)
                    n, _, _, digest = finished(w, np.zeros(len(w), bool))
                    out.append((rid, doc, rid, None, n, digest))
                else:
                    key = int(keys[0])
                    out.append((rid, doc, key ^ (int(doc) % parts.get(key, 1)), text, None, None))
            got = pd.DataFrame(out, columns=["rid", "doc_id", "shard", "text", "n_words", "digest"])
            yield got.astype({"doc_id": "Int64", "n_words": "Int64"})

    return docs.mapInPandas(rows, SCREENED)


def _settle(rows: list[tuple[int, int, list[bytes], str]], window: int, bits: Bits) -> list[tuple]:
    """One shard (rid, doc_id, words, text): locate phrases, settle windows that an earlier document of the shard has."""
    phrase = min(PHRASE, window)
    own, phrases = [], set()
    texts = [r[3] for r in rows]
    for (_, _, w, _), h, other in zip(rows, hashes(texts), hashes(texts, 1), strict=True):
        k, least = window_hash(h, phrase, 3), least_phrases(h, window)
        own.append((h, other, k, least))
        wanted = np.unique(least)
        for i in np.flatnonzero(np.isin(k, wanted[bits.has(wanted)])):
            phrases.add(b" ".join(w[i:i + phrase]))
    at, doc, h1, h2 = [], [], [], []
    for i, ((h, other, k, least), places) in enumerate(zip(own, locate([r[2] for r in rows], phrases), strict=True)):
        starts = np.flatnonzero(np.isin(least, k[places[places < len(k)]]))
        at.append(starts)
        doc.append(np.full(len(starts), i))
        h1.append(window_hash(h, window, 11)[starts])
        h2.append(window_hash(other, window, 12)[starts])
    at, doc, h1, h2 = map(np.concatenate, (at, doc, h1, h2))
    ids = np.array([r[1] for r in rows], np.int64)
    order = np.lexsort((ids[doc], h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    first = np.empty(len(order), np.int64)  # the smallest doc_id of the shard with the window
    first[order] = ids[doc][order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else 0
    settled = ids[doc] > first
    out = []
    cut = np.searchsorted(doc, np.arange(len(rows) + 1))
    for i, (rid, d, w, _) in enumerate(rows):
        s = slice(cut[i], cut[i + 1])
        gone, left = at[s][settled[s]], ~settled[s]
        if left.any():
            # Should no other shard take more from it, a document that has lost nothing so far is done, too.
            whole = None if len(gone) else finished(w, np.zeros(len(w), bool))[3]
            out.append((rid, d, len(w), None, None, whole, gone.astype("<i4").tobytes(),
                        h1[s][left].view(np.int64), h2[s][left].view(np.int64), at[s][left].astype(np.int32)))
        else:
            out.append((rid, d, *finished(w, covered(gone, len(w), window)), None, None, None, None))
    return out


def _shards(screened: DataFrame, window: int, recurring: Bits) -> DataFrame:
    shared = screened.sparkSession.sparkContext.broadcast(recurring)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        names = ["rid", "doc_id", "n_words", "n_removed", "kept", "digest", "starts", "h1", "h2", "at"]

        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "n_words": "Int64", "n_removed": "Int64"})

        for pdf in batches:
            done = pdf["text"].isna()
            plain = pdf[done]
            yield frame([(r.rid, r.doc_id, r.n_words, 0, None, r.digest, None, None, None, None) for r in plain.itertuples(index=False)])
            for r in pdf[~done].itertuples(index=False):
                held.append((r.rid, int(r.doc_id), words(r.text), r.text))
                size += len(r.text)
                if size >= SHARD_BYTES:
                    yield frame(_settle(held, window, shared.value))
                    held, size = [], 0
        if held:
            yield frame(_settle(held, window, shared.value))

    return store(screened.repartition("shard").sortWithinPartitions("shard", "doc_id").mapInPandas(rows, SETTLED), "sub_settled")


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """rid, doc_id, n_words, n_removed, kept (the words left, joined by one blank; null where
    no word goes) and digest (SHA-256 of the words left) of every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("rid", F.xxhash64("doc_id", "text"))  # tells rows of one doc_id apart; equal rows have equal results
    recurring = recurring_phrases(docs, window)
    total = recurring.agg(F.sum("n")).first()[0] or 0
    most = max(100, int(total * HOT))
    hot = {r["key"]: -(-r["n"] // most) for r in recurring.filter(F.col("n") > most).select("key", "n").collect()}
    bits = bitmap(recurring, "key", BITS)
    settled = _shards(_screen(docs, window, bits, hot), window, bits)
    done = settled.filter("starts is null").select("rid", "doc_id", "n_words", "n_removed", "kept", "digest")
    rest = settled.filter("starts is not null")
    places = rest.select("rid", "doc_id", F.explode(F.arrays_zip("h1", "h2", "at")).alias("w")).select("rid", "doc_id", "w.*")
    first = store(places.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                  .filter("first <> last").drop("last"), "sub_first")
    # Windows of one shard alone don't enter the join.
    met = only(places, "h1", bitmap(first, "h1", BITS))
    gone = store(met.join(first, ["h1", "h2"]).filter("doc_id > first").groupBy("rid", "doc_id").agg(F.collect_set("at").alias("more")),
                 "sub_gone")
    both = rest.select("rid", "doc_id", "n_words", "digest", "starts").join(gone, ["rid", "doc_id"], "left")
    kept = both.filter("digest is not null and more is null").select(
        "rid", "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept"), "digest")
    # Only texts that lose words are read again.
    lost = store(both.filter("digest is null or more is not null").select("rid", "doc_id", "starts", "more")
                 .dropDuplicates(["rid", "doc_id"]), "sub_lost")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                w = words(r.text)
                more = np.asarray(r.more, np.int64) if r.more is not None else np.empty(0, np.int64)
                starts = np.concatenate([np.frombuffer(r.starts, "<i4").astype(np.int64), more])
                out.append((r.rid, r.doc_id, *finished(w, covered(starts, len(w), window))))
            yield pd.DataFrame(out, columns=["rid", "doc_id", "n_words", "n_removed", "kept", "digest"])

    late = only(docs, "doc_id", bitmap(lost, "doc_id")).join(lost, ["rid", "doc_id"]).mapInPandas(
        finish, "rid long, doc_id long, n_words long, n_removed long, kept string, digest string")
    return done.unionByName(kept).unionByName(late)


def substring_digest(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(documents, window).select("doc_id", "n_words", "n_removed", F.col("digest").alias("kept_sha256"))


def cut_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents (all their columns) with repeated passages cut out.

    A text that loses nothing is left as it is; one that loses words becomes its
    kept words, and a row with no word left goes.  Rows whose doc_id is null are
    left as they are; rows that share a doc_id are each cut by their own text.
    """
    cut = store(remove_repeats(documents, window).filter("n_removed > 0 and doc_id is not null").select("rid", "doc_id", "kept"), "sub_cut")

    def change(rows: DataFrame, cut: DataFrame) -> DataFrame:
        # Equal rows have equal results; one of them is joined.
        cut = (cut.dropDuplicates(["rid", "doc_id"])
               .select(F.col("rid").alias("__rid"), F.col("doc_id").alias("__id"), F.col("kept").alias("__kept")))
        doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
        same = (F.xxhash64(doc, text) == F.col("__rid")) & (doc == F.col("__id"))
        both = rows.join(cut, same, "left").filter("__id is null or __kept <> ''")
        return both.withColumn("text", F.when(F.col("__id").isNull(), F.col("text")).otherwise(F.col("__kept"))).select(rows.columns)

    return replace_rows(documents, "doc_id", cut, change)
