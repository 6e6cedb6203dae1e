"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

An item's windows are its runs of ``window`` words (an item of fewer words is
one window).  A window is a set of shingles with a containment threshold of
one, so the prefix that any occurrence must contain is a single shingle: the
window's rarest.  Shingles are ordered by how often documents hold them, the
rarest of each window is joined with the documents' shingles, the positional
bound (its place in the window) and the length bound (the window must fit in
the document) give the one possible start, and the whole sequence of shingles
there is compared with the window's (three words each, hashed to 64 bits and
overlapping, so a differing word would need three collisions at once).

No broadcast is asked for: the planner broadcasts the benchmark's shingle
keys while their stored size is under its threshold and else shuffles.  Only
hashes leave a document's row, and after the first join only those the
benchmark holds, in runs long enough for a window.

Defined results: null, empty or wordless texts have no words and are clean; a
null or wordless item has no window; repeated items with equal text all count;
rows that share a doc_id, or have none, are judged each on its own.  Further columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import store

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a shingle; shorter items use shingles of their own length.
SHINGLE = 3


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def _hash_at(words: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[words[i + j] for j in range(size)])


def _shingles(words: Column, size: int) -> Column:
    """The hash of the shingle at each position."""
    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: _hash_at(words, i, size))).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int = 13, text: str = "text", item: str = "item_id") -> DataFrame:
    """(item_id, window_id, words, len): the windows of every item."""
    w = benchmark.select(F.col(item).cast("string").alias("item_id"), words_of(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (w.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s") + 1, F.lit(window)).alias("words"))
            .select("item_id", F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"), "words",
                    F.size("words").alias("len")))


def window_hits(documents: DataFrame, benchmark: DataFrame, window: int = 13, doc: str = "doc_id",
                text: str = "text", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits, lengths, items): places (rid, start, len, window_id) where windows
    stand, one (rid, doc_id, n_words) row per document row (with its ``keep``
    columns), and the (item_id, window_id) table."""
    items = store(item_windows(benchmark, window).distinct(), "bench_windows")
    sized = (items.select("window_id", "words", "len").dropDuplicates(["window_id"])
             .withColumn("size", F.least("len", F.lit(SHINGLE))))
    sizes = sorted(r["size"] for r in sized.select("size").distinct().collect())  # at most SHINGLE values
    hashed = F.lit(None).cast("array<bigint>")
    for s in sizes:
        hashed = F.when(F.col("size") == s, _shingles(F.col("words"), s)).otherwise(hashed)
    wins = store(sized.select("window_id", "len", "size", hashed.alias("hs")), "bench_hashes")
    keys = store(wins.select(F.explode("hs").alias("k")).distinct(), "bench_shingles")

    # Position 0 carries the row's length; then a section of one hash per word position for each shingle size.
    rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col(doc).cast("long").alias("doc_id"),
                            words_of(F.col(text)).alias("w"), *keep)
    n = F.size("w")
    sections = [F.concat(_shingles(F.col("w"), s), F.array_repeat(F.lit(None).cast("bigint"), F.least(n, F.lit(s - 1))))
                for s in sizes]
    places = (rows.select("rid", "doc_id", *keep, n.alias("n"), F.concat(F.array(F.xxhash64("rid")), *sections).alias("hs"))
              .select("rid", "doc_id", *keep, "n", F.posexplode("hs").alias("at", "h")).filter("h is not null"))
    if keep:
        places = places.withColumns({c: F.when(F.col("at") == 0, F.col(c)) for c in keep})
    found = store(places.join(keys, F.col("h") == F.col("k"), "left").filter("at = 0 or k is not null").drop("k"), "bench_seen")
    lengths = found.filter("at = 0").select("rid", "doc_id", *keep, F.col("n").cast("long").alias("n_words"))
    size = F.element_at(F.array(*[F.lit(s) for s in sizes or [SHINGLE]]), (F.floor((F.col("at") - 1) / F.col("n")) + 1).cast("int"))
    seen = found.filter("at > 0").select("rid", "n", size.alias("size"), ((F.col("at") - 1) % F.col("n")).alias("pos"), "h")

    # Runs of consecutive positions; a window of len words is len - size + 1 shingles in one run.
    in_row = Window.partitionBy("rid", "size").orderBy("pos")
    least = wins.groupBy("size").agg(F.min(F.size("hs")).alias("least"))
    runs = (seen.withColumn("run", F.col("pos") - F.row_number().over(in_row)).groupBy("rid", "n", "size", "run")
            .agg(F.min("pos").alias("p"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "h"))), lambda x: x["h"]).alias("hs"))
            .join(least, "size").filter(F.size("hs") >= F.col("least")))
    side = window - 1
    held = store(runs.select("rid", "n", "size", "p", F.explode(F.transform("hs", lambda h, i: F.struct(
        h.alias("h"), (i + F.col("p")).alias("pos"), F.greatest(i - side, F.lit(0)).alias("first"), i.alias("i"),
        F.slice("hs", F.greatest(i - side, F.lit(0)) + 1, F.lit(2 * side + 1)).alias("ctx")))).alias("x"))
        .select("rid", "n", "size", "p", "x.*"), "bench_runs")

    # Rarity order: a window's prefix is its shingle held by the fewest document places (none: no occurrence).
    df = held.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    prefix = (wins.select("window_id", "len", "size", "hs", F.posexplode("hs").alias("off", "h")).join(df, "h", "left")
              .groupBy("window_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "off")).alias("m"),
                                        F.first("len").alias("len"), F.first("hs").alias("whs"))
              .filter("m.df > 0").select("window_id", "len", "whs", F.col("m.h").alias("h"), F.col("m.off").alias("off")))
    at = F.col("i") - F.col("off")
    start = F.col("pos") - F.col("off")
    hits = (held.join(store(prefix, "bench_prefix"), "h")
            .filter((at >= 0) & (start + F.col("len") <= F.col("n")))  # positional and length bounds
            .filter(F.slice("ctx", at - F.col("first") + 1, F.size("whs")) == F.col("whs"))
            .select("rid", start.alias("start"), "len", "window_id").distinct())
    return store(hits, "bench_hits"), lengths, items.select("item_id", "window_id")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                  doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document (with its ``keep`` columns): n_words, n_hit (words inside any window), n_items,
    items_sha256 (of the sorted, comma-joined item ids) and contaminated
    (n_hit > 0 and share * n_hit >= n_words)."""
    hits, lengths, items = window_hits(documents, benchmark, window, doc, text, keep)
    spans = hits.groupBy("rid", "start").agg(F.max("len").alias("len"))
    before = F.max(F.col("start") + F.col("len")).over(
        Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = (spans.withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
               .groupBy("rid").agg(F.sum(F.greatest(F.col("start") + F.col("len") - F.col("from"), F.lit(0))).alias("n_hit")))
    named = (hits.select("rid", "window_id").distinct().join(items, "window_id").select("rid", "item_id").distinct()
             .groupBy("rid").agg(F.sort_array(F.collect_list("item_id")).alias("ids")))
    return (lengths.join(covered.join(named, "rid"), "rid", "left")
            .select("doc_id", *keep, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The documents (all their columns) that are not contaminated, each row by its own text."""
    # Rows of equal doc_id and text are judged alike, so both hashes of the text (128 bits) name the row.
    key = {"__t1": F.xxhash64("text"), "__t2": F.xxhash64(F.lit(1), "text")}
    bad = (contamination(documents.withColumns(key), benchmark, window, share, keep=tuple(key)).filter("contaminated")
           .select(F.col("doc_id").alias("__bad"), *[F.col(c).alias(f"{c}b") for c in key]).distinct())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__bad"))
    for c, value in key.items():
        same = same & (value == F.col(f"{c}b"))
    return documents.join(bad, same, "left_anti")
