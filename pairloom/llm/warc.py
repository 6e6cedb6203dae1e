"""Content-addressed WARC archive.

Two tables make an archive.  ``payloads`` holds every distinct payload once,
addressed by its SHA-256 (and checked: one address must have one length and
one SHA-1); ``headers`` holds the exact WARC header block of every record and
the address of its payload.  A record is its header block, its payload and
the closing blank lines, joined back by address.  Copies are reduced before
the shuffle (one payload per address leaves a task).  Reading rebuilds every
record and parses its bytes; for that join an address of many records lends
its payload to ``copies`` slots, and each record belongs to one of them, so a
page that a third of all rows repeat is rebuilt by many tasks.

Of the records with equal payloads the one with the smallest page_id is the
``response``, the others are ``revisit`` records that refer to it; payloads
under ``least`` bytes are all ``response``.

Defined results: a null html is an empty payload; a null url is written as an
empty target; rows without page_id sort after all others and, where no row of
the payload has one, are all responses; a row repeated with the same page_id
and payload is a response as often as it stands; an empty table gives empty
tables; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import store

#: The capture date written into every record (a parameter, so that archives are reproducible).
DATE = "2024-01-01T00:00:00Z"
#: Records of one address that are rebuilt from one copy of its payload.
SHARE = 500
#: What closes a record, and ends its header block.
CLOSE = b"\r\n\r\n"
_LAST = (1 << 63) - 1


def base32_of_hex(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def header_block(kind: str, page: int | None, url: str | None, length: int, sha1: str, refers: int | None, date: str) -> bytes:
    """The header block of one record, in WARC 1.1 syntax."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
             f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parse_header(block: bytes) -> dict[str, str]:
    rows = block.decode().split("\r\n")
    if rows[0] != "WARC/1.1":
        raise ValueError("not a WARC header block")
    return dict(r.split(": ", 1) for r in rows[1:] if r)


def write_archive(pages: DataFrame, least: int = 0, date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """Write (headers, payloads); both are stored tables."""
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    keyed = keyed.withColumns({"address": F.sha2("payload", 256), "sha1": F.sha1("payload"), "n": F.length("payload").cast("long")})
    order = F.coalesce("page_id", F.lit(_LAST))
    payloads = keyed.groupBy("address").agg(
        F.min("page_id").alias("first_id"), F.min_by("payload", order).alias("payload"),
        F.min("n").alias("n"), F.max("n").alias("n2"), F.min("sha1").alias("sha1"), F.max("sha1").alias("sha2"),
        F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("copies"))
    same = F.assert_true((F.col("n") == F.col("n2")) & (F.col("sha1") == F.col("sha2")), "two payloads with one SHA-256")
    payloads = store(payloads.filter(same.isNull()).drop("n2", "sha2"), "warc_payloads")
    at = keyed.select("page_id", "url", "address", "sha1", "n").join(payloads.select("address", "first_id", "copies"), "address")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, str] = {}
        turn = 0
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                turn += 1
                page = None if pd.isna(r.page_id) else int(r.page_id)
                first = None if pd.isna(r.first_id) else int(r.first_id)
                kind = "response" if r.n < least or page == first else "revisit"
                if len(known) > 100_000:
                    known.clear()
                sha1 = known.get(r.sha1) or known.setdefault(r.sha1, base32_of_hex(r.sha1))
                out.append((r.address, turn % int(r.copies), header_block(kind, page, r.url, int(r.n), sha1, first, date)))
            yield pd.DataFrame(out, columns=["address", "slot", "header"])

    # Ids as text: pandas has no long with nulls by default.
    narrow = at.select(F.col("page_id").cast("string"), "url", "address", "sha1", "n", F.col("first_id").cast("string"), "copies")
    headers = store(narrow.mapInPandas(blocks, "address string, slot int, header binary"), "warc_headers")
    return headers, payloads.select("address", "payload", "copies")


def reconstruct(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """The original records: header block, payload, two line ends.

    A payloads table without ``copies`` lends each payload to one slot.
    """
    copies = F.col("copies") if "copies" in payloads.columns else F.lit(1)
    lent = payloads.select("address", "payload", F.explode(F.sequence(F.lit(0), copies - 1)).alias("slot"))
    return headers.join(lent, ["address", "slot"]).select("address", F.concat("header", "payload", F.lit(CLOSE)).alias("record"))


def parse_record(address: str, record: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of one record; raises where its parts disagree."""
    at = record.index(CLOSE) + len(CLOSE)
    h = parse_header(record[:at])
    n = int(h["Content-Length"])
    body = record[at:at + n]
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    if hashlib.sha256(body).hexdigest() != address:
        raise ValueError(f"payload {address} does not match its address")
    if record[at + n:] != CLOSE or h["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError("a header does not match its payload")
    page, refers = (h.get(k, "")[len("<urn:page:"):-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return int(page) if page else None, n, digest, h["WARC-Type"], int(refers) if refers else None


def read_records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, parsed from the bytes of every rebuilt record."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [parse_record(a, r) for a, r in zip(pdf["address"], pdf["record"], strict=True)]
            yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})

    return reconstruct(headers, payloads).mapInPandas(
        parse, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
