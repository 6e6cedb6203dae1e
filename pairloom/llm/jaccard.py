"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct word shingles (64-bit hashes).  Documents
with equal sets are one class, and only the class with its smallest doc_id
takes part.

1. Similar documents are partitioned into groups: one-permutation minhashes of
   the set, in bands; a class goes to the smallest class it shares most bands
   with, and is compared exactly with that class and with the classes there
   that found no link themselves; linked classes form a group.
2. The token-group matrix: an entry (token, group) for every token in the
   prefix of a member, tokens ordered by rarity (a counting sketch over all
   documents).  Two sets as similar as asked for share a prefix token, so a
   query meets every group that can hold a partner; groups whose sizes, or
   whose places of the token, cannot match are left out.
3. The groups met are joined with their queries.  A task builds a group's
   token union, bounds the query's overlap with it, opens the group only if
   the bound reaches the threshold, and compares with the members exactly.

Links inside a group add nothing to its component, so a group of copies is
never expanded into pairs; a query stops at its first link into a group.
Groups and queries of any number are split into blocks of bounded size.  What
is broadcast has a fixed size: the sketch and the bitmaps of ids.

A shingle is known by 64 bits made from 64-bit hashes of its words; equal sets
by 128 bits of theirs.  Links are decided on these hashes; the words are not
compared again.

Defined results: null, empty and wordless texts have an empty set and link
with nothing; a text of fewer words than a shingle is one shingle; rows that
share a doc_id are judged each on its own (rows of equal doc_id and text are
one); a row without doc_id takes part, and its component is null; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import TEXT_ROWS, add_up, bitmap, hashed_texts, merged_blocks, mix, only, replace_rows, store, union_min, window_hash
from pairloom.session import batches_of

BANDS, ROWS = 16, 4
#: log2 of the sketch's counters, and of the counters in a block of it.
SKETCH, SKETCH_BLOCK = 23, 18
#: Members of a block of a group, and queries of one task for a block.
MEMBERS, QUERIES = 256, 2000


def shingles(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``size`` words; A-Z in lower case."""
    for h in hashed_texts((x or "").encode("utf-8", "replace").lower() for x in texts):
        if not len(h):
            yield np.empty(0, np.uint64)
        else:
            yield np.unique(window_hash(h, size, 1)) if len(h) >= size else window_hash(h, len(h), 1 + len(h))


def bands(s: np.ndarray) -> np.ndarray:
    """Band keys of a sorted set: minima of equal ranges of the hash space, empty ranges borrow from the next."""
    bins = BANDS * ROWS
    width = np.uint64((1 << 64) // bins)
    owner = (s // width).astype(np.int64)
    used, first = np.unique(owner, return_index=True)
    at = np.searchsorted(used, np.arange(bins)) % len(used)
    gap = (used[at] - np.arange(bins)) % bins
    low = mix(s[first[at]] + gap.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key ^ low[:, j])
    return key


def needed(n: int, percent: int) -> int:
    """The least overlap of a set of n with any set as similar as asked for."""
    return -(-percent * n // 100)


def row_key(doc: Column, text: Column) -> Column:
    """Tells rows apart; rows of equal doc_id and text are one."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc.cast("long").cast("string"), F.lit("")), F.lit(" "), F.coalesce(text.cast("string"), F.lit("")))))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """kind 0: key, doc_id, n, digest and band keys of a row; kind 1: blocks of the task's token counts."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        counts = np.zeros(1 << SKETCH, np.uint16)
        for pdf in batches:
            n, d1, d2, keys = [], [], [], []
            for s in shingles(pdf["text"], size):
                n.append(len(s))
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                d1.append(digest[0])
                d2.append(digest[1])
                keys.append(bands(s).view(np.int64) if len(s) else None)
                at = (s >> np.uint64(64 - SKETCH)).astype(np.int64)  # distinct tokens may share a counter
                counts[at] += counts[at] < 0xFFFF
            yield pd.DataFrame({"kind": 0, "row": pdf["row"], "doc_id": pdf["doc_id"].astype("Int64"), "n": n, "d1": d1, "d2": d2, "bands": keys,
                                "block": None, "data": None})
        # Block by block: a task holds its counters once, not again as rows.
        for block, data in enumerate(counts.reshape(-1, 1 << SKETCH_BLOCK)):
            yield pd.DataFrame({"kind": 1, "row": None, "doc_id": None, "n": 0, "d1": 0, "d2": 0, "bands": None, "block": [block],
                                "data": [data.tobytes()]})

    return store(docs.mapInPandas(rows, "kind int, row binary, doc_id long, n long, d1 long, d2 long, bands array<bigint>, block int, data binary"),
                 "jaccard_rows")


def prefixes(docs: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """row, n and the prefix tokens of every set that can have an unequal partner."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # 2^SKETCH counters

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for pdf in batches:
            out = []
            for row, s in zip(pdf["row"], shingles(pdf["text"], size), strict=True):
                n = len(s)
                if n and (needed(n, percent) < n or n * 100 >= percent * (n + 1)):
                    order = np.lexsort((s, counts[(s >> np.uint64(64 - SKETCH)).astype(np.int64)]))
                    out.append((row, n, s[order[:n - needed(n, percent) + 1]].view(np.int64)))
            yield pd.DataFrame(out, columns=["row", "n", "tokens"])

    return docs.select("row", "text").mapInPandas(rows, "row binary, n long, tokens array<bigint>")


def open_groups(docs: DataFrame, classes: DataFrame, members: DataFrame, queries: DataFrame, size: int, percent: int,
                grow: bool = False) -> DataFrame:
    """Edges (a, b): the first member b of group g linked with query a, for (cid, g) members and queries.

    With ``grow`` a query without a link becomes a member for the queries after
    it, up to MEMBERS of them: a way to form groups, not to find all links.
    """
    parts = lambda of, name: F.ceil(F.sum(of) / name)
    splits = (members.select("g", F.lit(1).alias("m"), F.lit(0).alias("q")).union(queries.select("g", F.lit(0), F.lit(1)))
              .groupBy("g").agg(parts("m", MEMBERS).alias("mb"), parts("q", QUERIES).alias("qb")))
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    m = members.join(splits, "g").select("cid", "g", F.lit(0).alias("kind"), own("mb").alias("mb"), upto("qb").alias("qb"))
    q = queries.join(splits, "g").select("cid", "g", F.lit(1).alias("kind"), upto("mb").alias("mb"), own("qb").alias("qb"))
    roles = store(m.union(q).join(classes.select("cid", F.col("first.row").alias("row")), "cid").withColumn("at", F.xxhash64("row")),
                  "jaccard_roles")
    # Equal rows are one; the shuffle by row serves the join, too.
    texts = only(docs.withColumn("at", F.xxhash64("row")), "at", bitmap(roles, "at")).select("row", "text").dropDuplicates(["row"])
    rows = texts.join(roles, "row")

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, union = None, [], None
        for pdf in batches:
            out = []
            for r, s in zip(pdf.itertuples(index=False), shingles(pdf["text"], size), strict=True):
                if (r.g, r.mb, r.qb) != block:
                    block, held, union = (r.g, r.mb, r.qb), [], None
                if r.kind == 0:
                    held.append((r.cid, s))
                    continue
                if union is None and not grow:  # all members of the block come before its queries
                    union = np.unique(np.concatenate([x for _, x in held])) if len(held) > 1 else held[0][1] if held else s[:0]
                if not grow and (not len(union) or common(s, union) < needed(len(s), percent)):
                    continue
                for cid, x in held:
                    if cid != r.cid and min(len(s), len(x)) * 100 >= percent * max(len(s), len(x)):
                        both = common(s, x)
                        if 100 * both >= percent * (len(s) + len(x) - both):
                            out.append((r.cid, cid))
                            break
                else:
                    if grow and len(held) < MEMBERS:
                        held.append((r.cid, s))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return store(rows.select("cid", "text", "g", "kind", "mb", "qb").repartition("g", "mb", "qb")
                 .sortWithinPartitions("g", "mb", "qb", "kind", "cid").mapInPandas(opened, "a long, b long"), "jaccard_edges", TEXT_ROWS)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def judge(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """row, doc_id, n and, for sets that aren't empty, ``first`` (nameless, doc_id, row): the first row of the group (those without doc_id last)."""
    docs = _texts(documents)
    with batches_of(documents.sparkSession, TEXT_ROWS):
        rows = signatures(docs, size)
    base = rows.filter("kind = 0").select("row", "doc_id", "n", "d1", "d2")
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    classes = (rows.filter("kind = 0 and n > 0").groupBy("d1", "d2")
               .agg(F.min(key).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    # Numbered once, as they are written, in the order of their first rows: copies come after the document they were made from.
    classes = classes.repartitionByRange("first").sortWithinPartitions("first").withColumn("cid", F.monotonically_increasing_id())
    classes = store(classes, "jaccard_classes")

    # 1. Groups of similar classes.
    banded = classes.select("cid", "n", F.explode("bands").alias("key"))
    centre = (banded.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("c"), F.max("cid").alias("most"))
              .filter("most <> c.cid").select("key", F.col("c.cid").alias("g"), F.col("c.n").alias("gn")))
    fits = F.least("n", "gn") * 100 >= F.greatest("n", "gn") * percent
    stars = (banded.join(centre, "key").filter((F.col("cid") != F.col("g")) & fits)
             .groupBy("cid", "g").agg(F.count(F.lit(1)).alias("k"))
             .groupBy("cid").agg(F.max(F.struct("k", (-F.col("g")).alias("o"))).alias("m"))
             .select("cid", (-F.col("m.o")).alias("g")))
    stars = store(stars, "jaccard_stars")
    centres = stars.select(F.col("g").alias("cid"), "g").distinct()
    edges = open_groups(docs, classes, centres, stars, size, percent, grow=True)
    found = store(union_min(edges), "jaccard_groups")

    # 2. The token-group matrix over prefixes in order of rarity.
    sketch = np.zeros((1 << (SKETCH - SKETCH_BLOCK), 1 << SKETCH_BLOCK), np.uint16)
    for at, data in merged_blocks(rows.filter("kind = 1"), add_up, "u2"):
        sketch[at] = data
    groups = (classes.select("cid", F.col("first.row").alias("row")).join(found, F.col("cid") == F.col("node"), "left")
              .select("cid", "row", F.coalesce("component", "cid").alias("g")))
    groups = store(groups, "jaccard_member")
    tokens = store(prefixes(docs, size, percent, sketch.reshape(-1)).join(groups, "row").dropDuplicates(["row"]), "jaccard_prefixes", TEXT_ROWS)
    entries = tokens.select("cid", "g", "n", F.posexplode("tokens").alias("at", "token"))
    several = store(entries.groupBy("token").agg(F.min("g").alias("a"), F.max("g").alias("b")).filter("a <> b").select("token"),
                    "jaccard_tokens")
    met = store(only(entries, "token", bitmap(several, "token", 26)).join(several, "token"), "jaccard_entries")
    # Positional bound: at the first common token of a linked pair, places i and j, both n - i and n' - j are at least
    # the overlap asked for, percent / (100 + percent) of n + n'.  ``room`` is what that leaves for the partner's size.
    room = (100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")
    matrix = met.groupBy("token", "g").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(room).alias("most"))
    queries = (met.select("token", "cid", F.col("g").alias("own"), "n", room.alias("room")).join(matrix, "token")
               .filter((F.col("g") < F.col("own")) & (F.col("room") >= percent * F.col("low")) & (F.col("most") >= percent * F.col("n"))
                       & (F.col("high") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("low") * percent))
               .select("cid", "g").distinct())
    queries = store(queries, "jaccard_queries")

    # 3. Open the groups met.
    members = groups.join(queries.select("g").distinct(), "g", "left_semi").select("cid", "g")
    more = open_groups(docs, classes, members, queries, size, percent)
    final = union_min(edges.union(more))
    labelled = (classes.select("d1", "d2", "cid", "first").join(final, F.col("cid") == F.col("node"), "left")
                .select("d1", "d2", "first", F.coalesce("component", "cid").alias("component")))
    labelled = store(labelled, "jaccard_labelled")
    heads = labelled.groupBy("component").agg(F.min("first").alias("head"))
    each = labelled.join(heads, "component").select("d1", "d2", F.col("head").alias("first"))
    return base.join(each, ["d1", "d2"], "left").select("row", "doc_id", "n", F.when(F.col("n") > 0, F.col("first")).alias("first"))


def jaccard_components(documents: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable over links of Jaccard >= percent / 100)."""
    return judge(documents, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id")).alias("component_id"))


def drop_near_duplicates(documents: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The documents (all their columns) without the rows that aren't the first of their group.

    Judged by row, whatever the doc_id: of rows of equal doc_id and text one
    stays; rows without words all stay.
    """
    judged = judge(documents, size, percent).filter("first is not null")
    rows = judged.groupBy("row").agg(F.count(F.lit(1)).alias("copies"), F.first(F.col("row") == F.col("first.row")).alias("stays"))
    # Rows that go, and rows of which one copy stays.
    gone = store(rows.filter("not stays or copies > 1").select(F.col("row").alias("__row"), "stays", F.xxhash64("row").alias("__at")), "jaccard_gone")

    def change(rows: DataFrame, gone: DataFrame) -> DataFrame:
        none = rows.join(gone, "__row", "left_anti")
        return none.unionByName(rows.join(gone.filter("stays").select("__row"), "__row", "left_semi").dropDuplicates(["__row"]))

    keyed = documents.withColumn("__row", row_key(F.col("doc_id"), F.col("text"))).withColumn("__at", F.xxhash64("__row"))
    return replace_rows(keyed, "__at", gone, change).select(*documents.columns)
