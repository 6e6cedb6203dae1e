"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import batches_of, checkpoint_dir


#: Folders of tables stored inside ``passing_tables``, and whether it is active.
_PASSING: list[str] = []
_SCOPE = [False]


#: Rows of a batch where rows hold whole texts, and where they hold blocks of a table; characters of text worked on at once.
TEXT_ROWS, BLOCK_ROWS, SLICE = 1000, 16, 1 << 20


def slices(pdf: pd.DataFrame, column: str = "text", most: int = SLICE) -> Iterator[pd.DataFrame]:
    """A batch in pieces of about ``most`` characters of ``column``, a row at least: what is made of texts is held for a piece only."""
    if pdf.empty:
        return
    size = np.cumsum([len(x or "") for x in pdf[column]], dtype=np.int64)
    at = np.flatnonzero(np.diff(size // most, prepend=-1)).tolist()
    for i, j in zip(at, [*at[1:], len(pdf)], strict=True):
        yield pdf.iloc[i:j]


def store(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back; Python is given batches of at most ``rows`` rows.

    The lineage is cut at files that every executor sees, so a lost executor
    costs a re-read and never a recomputation of the stages before.  The
    folder is the one that ``spark.checkpoint.dir`` names.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    with batches_of(spark, rows):
        df.write.parquet(path)
    if _SCOPE[0]:
        _PASSING.append(path)
    # Spark deletes the shuffle files of a plan when the driver has collected it as garbage; do that now that they are not needed.
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored in here live until the next such block, which deletes them first.

    For chains whose every link is written before the next begins; tables
    stored outside (by queries that are still lazy) are never touched.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while _PASSING:
        path = spark._jvm.org.apache.hadoop.fs.Path(_PASSING.pop())
        path.getFileSystem(conf).delete(path, True)
    _SCOPE[0] = True
    try:
        yield
    finally:
        _SCOPE[0] = False


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def union_min(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components of an edge table: (node, component).

    ``component`` is the smallest node reachable.  Alternating large-star and
    small-star rounds (Kiveris et al., 2014): each round is two aggregations
    by node with map-side combine, and the table is written after each, so no
    node's neighbourhood is ever gathered.  Nodes without an edge to another
    node are absent; null ends are ignored.
    """
    e = (edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
         .filter("u is not null and v is not null and u <> v").distinct())
    e = store(e, "edges")
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = store(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = store(large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("s"))
            .select(F.col("s.x").alias("u"), F.col("s.y").alias("v")).filter("u <> v").distinct(), "small")
        # A star forest is reached when the round changed nothing.
        if small.count() == e.count() and not has_rows(small.join(e, ["u", "v"], "left_anti")):
            break
        e = small
    roots = small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return small.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


class Bits:
    """A bitmap of fixed size over 64-bit keys (no false negatives).

    Sent to tasks instead of a key list whose size nothing bounds: a key that
    is not in the bitmap is certainly not in the list, the rest is settled by
    a join afterwards.
    """

    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        self.words = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(1 << (bits - 3), np.uint8)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = self._at(keys)
        return (self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def add(self, keys: np.ndarray) -> None:
        at = self._at(keys)
        np.bitwise_or.at(self.words, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))


def add_up(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of uint16 counters that stop at their largest value."""
    return np.minimum(a.astype(np.uint32) + b, 0xFFFF).astype(np.uint16)


def merged_blocks(df: DataFrame, merge: Callable, dtype: str) -> Iterator[tuple[int, np.ndarray]]:
    """Merge (block int, data binary) rows, the rows of a block in one streaming task.

    A task holds one array for each of its blocks and a batch of few rows,
    whatever the number of rows.
    """
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for pdf in batches:
            for block, data in zip(pdf["block"], pdf["data"], strict=True):
                got = np.frombuffer(data, dtype)
                held[block] = merge(held[block], got) if block in held else got
        yield pd.DataFrame({"block": list(held), "data": [x.tobytes() for x in held.values()]})

    schema = "block int, data binary"
    with batches_of(df.sparkSession, BLOCK_ROWS):
        merged = df.select("block", "data").repartition(16, "block").mapInPandas(fold, schema).collect()  # a row a block: fixed size
    for r in merged:
        yield r["block"], np.frombuffer(r["data"], dtype)


def bitmap(df: DataFrame, column: str, bits: int = 24) -> Bits:
    """The ``Bits`` of a long column, built in the tasks; the driver receives 2^bits bits."""
    block = min(bits, 18)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Bits(bits)
        for pdf in batches:
            own.add(pdf[column].to_numpy(np.int64).view(np.uint64))
        blocks = own.words.reshape(-1, 1 << (block - 3))
        used = np.flatnonzero(blocks.any(axis=1))
        yield pd.DataFrame({"block": used.astype(np.int32), "data": [blocks[i].tobytes() for i in used]})

    parts = df.select(column).filter(F.col(column).isNotNull()).mapInPandas(local, "block int, data binary")
    words = np.zeros((1 << (bits - block), 1 << (block - 3)), np.uint8)
    for at, data in merged_blocks(parts, np.bitwise_or, "u1"):
        words[at] = data
    return Bits(bits, words.tobytes())


def _held(df: DataFrame, column: str, keys: Bits) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(keys)

    @F.pandas_udf("boolean")
    def held(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.has(x.to_numpy(np.int64).view(np.uint64)))

    return held(F.coalesce(F.col(column).cast("long"), F.lit(0)))


def only(df: DataFrame, column: str, keys: Bits) -> DataFrame:
    """Rows whose long ``column`` may be in ``keys`` (all that are, few others); the rest of the row stays in the JVM."""
    return df.filter(F.col(column).isNotNull()).filter(_held(df, column, keys))


def replace_rows(df: DataFrame, column: str, changes: DataFrame, change) -> DataFrame:
    """``df`` with ``change(rows, changes)`` in place of the rows whose ``column`` is in ``changes``.

    Only rows that the bitmap of the changed ids lets through meet the join in
    ``change``; the others, and rows without id, pass by without a shuffle.
    """
    held = F.col(column).isNotNull() & _held(df, column, bitmap(changes, column))
    return df.filter(~held).unionByName(change(df.filter(held), changes))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64 (fixed values), on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IN_WORD = (~np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))).astype(np.int8)
#: The first k bytes of a little-endian lane.
_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words are hashed one by one.
_LONG_WORD = 256


def _scramble(x: np.ndarray) -> np.ndarray:
    """``mix`` in place."""
    y = x >> np.uint64(30)
    x ^= y
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=y)
    x ^= y
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=y)
    x ^= y
    return x


@lru_cache(maxsize=8)
def _salt(seed: int) -> np.uint64:
    return mix(np.array([seed + 0x51ED27], np.uint64))[0] | np.uint64(1)


def _hashed_words(data: bytes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start, and their hashes."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    _IN_WORD.take(b, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.empty(0, np.uint64)
    size, salt = end - start, _salt(seed)
    lanes = np.ndarray(len(b) + 1, "<u8", data + bytes(8), strides=(1,))  # the eight bytes from every place on
    h = lanes[start]
    h &= _LANE[np.minimum(size, 8)]
    h ^= size.astype(np.uint64) * salt
    h = _scramble(h)
    at, done = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while len(at):
        rest = size[at] - done
        lane = lanes[start[at] + done]
        lane &= _LANE[np.minimum(rest, 8)]
        lane ^= h[at] * salt
        h[at] = _scramble(lane)
        at, done = at[rest > 8], done + 8
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        import xxhash

        h[i] = np.frombuffer(xxhash.xxh3_128_digest(data[start[i]:end[i]]), "<u8")[seed & 1]
    return start, h


def word_hashes(data: bytes, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the words of a text (cut at ASCII blanks); seeds 0 and 1 give independent ones.

    The words' lanes of eight bytes are mixed in one after the other, for all
    words at once; words over 256 bytes take a half of xxhash's 128 bits.
    Nothing is kept between texts.
    """
    return _hashed_words(data, seed)[1]


def hashed_texts(texts: Iterable[bytes], seed: int = 0) -> Iterator[np.ndarray]:
    """``word_hashes`` of each text; short texts are hashed many at a time."""
    held, size = [], 0

    def together() -> Iterator[np.ndarray]:
        start, h = _hashed_words(b"\n".join(held), seed)
        ends = np.cumsum([len(x) + 1 for x in held])
        yield from np.split(h, np.searchsorted(start, ends[:-1]))

    for x in texts:
        held.append(x)
        size += len(x)
        if size >= 1 << 17:
            yield from together()
            held, size = [], 0
    if held:
        yield from together()


@lru_cache(maxsize=64)
def _factors(size: int, seed: int) -> tuple:
    return tuple(mix(np.arange(size, dtype=np.uint64) + np.uint64(1 + seed * 1000)) | np.uint64(1))


def window_hash(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes (order counts)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, f in enumerate(_factors(size, seed)):
        out += h[j:j + n] * f
    return mix(out)
