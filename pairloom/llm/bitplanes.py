"""Token-id output as bit- or byte-plane shuffled chunks.

Documents are range-partitioned and sorted by doc_id; each partition becomes a
shard, a stream of ids cut into blocks of fixed size.  A block is transposed
into planes (byte planes: all low bytes, then all high bytes; bit planes: one
per bit), every plane is compressed with zstandard, and a chunk row keeps them
with the documents that start in it.  The chunk index (shard, chunk, ids,
bytes, first id in the whole stream) is a table of its own.  Chunks live in
Parquet files, written by Spark's committer into any store Spark can write, so a lost executor leaves no half shard behind.

A reader streams a shard's chunks in order and holds one block at a time.

Defined results: null and empty texts are documents of the end id alone; a
null doc_id sorts first; repeated doc_ids follow one another, each a document
of its own; an empty table gives no shard; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import store
from pairloom.llm.tokens import default_path, encoder

#: Ids in a block.
BLOCK = 1 << 16
CHUNK = "shard int, chunk int, n_ids int, planes array<binary>, doc_ids array<bigint>, doc_at array<int>"


def split_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """Planes of a block of uint16 ids, each compressed."""
    import zstandard

    raw = ids.astype("<u2").view(np.uint8).reshape(-1, 2)
    if kind == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        planes = [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(16)]
    else:
        planes = [np.ascontiguousarray(raw[:, i]).tobytes() for i in range(2)]
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(p) for p in planes]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block from its planes (2: bytes, 16: bits)."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    got = [np.frombuffer(unpack.decompress(bytes(p)), np.uint8) for p in planes]
    if len(got) == 16:
        bits = np.stack([np.unpackbits(g, bitorder="little")[:n] for g in got], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    else:
        raw = np.stack(got, axis=1)
    return np.ascontiguousarray(raw).view("<u2").reshape(-1)[:n]


def write_tokens(documents: DataFrame, end: int = 2, path: str | None = None, block: int = BLOCK,
                 kind: str = "byte") -> tuple[DataFrame, DataFrame]:
    """Write the shards; returns (chunks, index), both stored."""
    path = path or default_path()

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, stop = encoder(path), np.array([end], "<u2").tobytes()
        shard, chunk, buf, docs, at = TaskContext.get().partitionId(), 0, bytearray(), [], []

        def row(data: bytes) -> dict:
            ids = np.frombuffer(data, "<u2")
            return {"shard": shard, "chunk": chunk, "n_ids": len(ids), "planes": split_planes(ids, kind),
                    "doc_ids": docs, "doc_at": at}

        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                docs.append(None if pd.isna(doc) else int(doc))
                at.append(len(buf) // 2)
                buf += enc.encode(text) + stop
                while len(buf) >= 2 * block:
                    rows.append(row(bytes(buf[:2 * block])))
                    del buf[:2 * block]
                    chunk, docs, at = chunk + 1, [], []
            if rows:
                yield pd.DataFrame(rows)
        if buf or docs:
            yield pd.DataFrame([row(bytes(buf))])

    chunks = store(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInPandas(shards, CHUNK), "planes")
    sizes = chunks.select("shard", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"),
                          F.aggregate("planes", F.lit(0), lambda a, p: a + F.length(p)).alias("n_bytes"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(before, F.lit(0)).alias("s"))
    inner = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    index = store(sizes.withColumn("inner", F.coalesce(inner, F.lit(0))).join(starts, "shard")
                  .select("shard", "chunk", "n_ids", "n_docs", "n_bytes", (F.col("s") + F.col("inner")).alias("start")), "plane_index")
    return chunks, index


def read_documents(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, shard, pos, doc = [], None, 0, None  # doc: [id, start in shard, ids, crc]

        def closed() -> None:
            if doc is not None:
                out.append((shard, *doc))

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.shard != shard:
                    closed()
                    shard, pos, doc = r.shard, 0, None
                ids = join_planes(list(r.planes), r.n_ids).astype("<u4")
                cuts = [*map(int, r.doc_at), len(ids)]
                if doc is not None and cuts[0]:
                    doc[2], doc[3] = doc[2] + cuts[0], zlib.crc32(ids[:cuts[0]].tobytes(), doc[3])
                for i, d in enumerate(r.doc_ids):
                    closed()
                    part = ids[cuts[i]:cuts[i + 1]]
                    doc = [d, pos + cuts[i], len(part), zlib.crc32(part.tobytes())]
                pos += len(ids)
            if out:
                yield pd.DataFrame(out, columns=["shard", "doc_id", "at", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
                out = []
        closed()
        if out:
            yield pd.DataFrame(out, columns=["shard", "doc_id", "at", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    got = (chunks.repartition("shard").sortWithinPartitions("shard", "chunk")
           .mapInPandas(documents, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long"))
    first = index.filter("chunk = 0").select("shard", "start")
    return got.join(first, "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
