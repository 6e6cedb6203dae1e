"""WARC archive and quotation linking."""

import base64
import hashlib
import random

import pytest

from pairloom.llm import chat, warc


def b32(x):
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def test_archive_reads_back(spark):
    rows = [(5, "http://a/", "héllo"), (2, "u2", "héllo"), (9, None, "héllo"), (3, "u3", None), (4, "u4", ""), (7, "a\r\nb", "x" * 100_000),
            (None, "n", "héllo"), (None, "n", "only"), (8, "r", "twice"), (8, "r", "twice")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, address string")
    headers, payloads = warc.write_archive(df)
    assert payloads.count() == len({(r[2] or "") for r in rows})
    got = sorted([tuple(r) for r in warc.read_records(headers, payloads).collect()], key=str)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same else None
        kind = "response" if page == first else "revisit"
        want.append((page, len(body), b32(body), kind, first if kind == "revisit" else None))
    assert got == sorted(want, key=str)
    records = [bytes(r["record"]) for r in warc.reconstruct(headers, payloads).collect()]
    assert len(records) == len(rows) and sum("héllo\r\n\r\n".encode() in r for r in records) == 4
    big = next(r for r in records if b"x" * 1000 in r)
    assert big.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>") and b"a%0D%0Ab" in big


def test_archive_options_and_empty_table(spark):
    schema = "page_id long, url string, html string"
    assert warc.read_records(*warc.write_archive(spark.createDataFrame([], schema))).count() == 0
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "longer"), (4, "d", "longer")], schema)
    got = {r["page_id"]: r["record_type"] for r in warc.read_records(*warc.write_archive(df, least=3)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_a_damaged_payload_is_found(spark):
    headers, payloads = warc.write_archive(spark.createDataFrame([(1, "a", "body")], "page_id long, url string, html string"))
    bad = payloads.selectExpr("address", "cast('b0dy' as binary) as payload")
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_records(headers, bad).collect()


def test_a_payload_of_many_records_is_rebuilt_from_several_copies(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARE", 4)
    rows = [(i, f"u{i}", "hot" if i % 3 else "") for i in range(60)] + [(60, "u", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    headers, payloads = warc.write_archive(df)
    assert {bytes(r["payload"]): r["copies"] for r in payloads.collect()} == {b"hot": 10, b"": 5, b"other": 1}
    assert headers.filter("length(header) > 0").select("address", "slot").distinct().count() > 3
    got = {r["page_id"]: tuple(r)[1:] for r in warc.read_records(headers, payloads).collect()}
    first = {"hot": 1, "": 0, "other": 60}
    assert got == {i: (len(h), b32(h.encode()), "response" if i == first[h] else "revisit", None if i == first[h] else first[h])
                   for i, _, h in rows}


def test_a_record_whose_parts_disagree_is_refused():
    body = b"body"
    address = hashlib.sha256(body).hexdigest()
    block = warc.header_block("response", 3, "u", 4, b32(body), None, warc.DATE)
    assert warc.parse_record(address, block + body + warc.CLOSE) == (3, 4, b32(body), "response", None)
    for bad in (block + body, block + body + b"!" + warc.CLOSE,
                warc.header_block("response", 3, "u", 4, b32(b"else"), None, warc.DATE) + body + warc.CLOSE):
        with pytest.raises(ValueError, match="a header does not match its payload"):
            warc.parse_record(address, bad)


def test_parse_levels():
    text = "Hi.\n\nOn Monday, Ann wrote:\n> One  line\n> more\n>\n> Second\n>> Deep\n\nMy answer\nhere"
    assert chat.parse(text) == [(0, "Hi."), (1, "One  line\nmore"), (1, "Second"), (2, "Deep"), (0, "My answer\nhere")]
    assert chat.parse(None) == [] and chat.parse("> > a")[0] == (2, "a")


def brute(rows):
    """Latest earlier turn whose own paragraphs hold the shallowest quoted paragraph."""
    out = []
    for conv, turn, role, text in rows:
        got = chat.parse(text)
        best, linked = None, 0
        for level, p in got:
            if level:
                h = chat.normalised(p)
                seen = [t for c, t, _, x in rows if c == conv and t < turn and any(lv == 0 and chat.normalised(q) == h for lv, q in chat.parse(x))]
                if seen:
                    linked += 1
                    best = min(best or (9, 0), (level, -max(seen)))
        before = [t for c, t, _, _ in rows if c == conv and t < turn]
        reply = -best[1] if best else max(before, default=None)
        out.append((conv, turn, "\n\n".join(p for lv, p in got if lv == 0), sum(lv > 0 for lv, _ in got), linked, reply))
    return sorted(out, key=str)


def test_links_against_brute_force(spark):
    rows = [(1, 0, "user", "Question one?\n\nQuestion two?"), (1, 1, "assistant", "Answer A"), (1, 2, "user", "> question  ONE?\nNo, I meant this"),
            (1, 3, "assistant", "Ann wrote\n> No, I meant this\n>> question one?\n\nOk"), (1, 4, "user", "> unknown\nwhat"), (1, 5, "user", "Answer A"),
            (1, 6, "user", "> answer a\nagain"), (2, 0, "user", "> Answer A\nother conversation"), (2, 1, "assistant", None),
            (3, 0, "user", ""), (3, 1, "user", "> \n>"), (3, 2, "user", ">> only deep\n> "), (4, 5, "u", "only deep"), (4, 6, "u", ">> only deep")]
    for block in range(60):
        rows.append((9, block, "user", "same" if block % 3 else "> same\nyes"))
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int").repartition(4)
    got = chat.link_quotations(df).collect()
    assert sorted([(r["conv_id"], r["turn"], r["text"], r["n_quotes"], r["n_linked"], r["reply_to"]) for r in got], key=str) == brute(rows)
    for conv in {r["conv_id"] for r in got}:
        mine = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(1, len(mine) + 1))
        place = {r["turn"]: r["position"] for r in mine}
        assert all(r["reply_to"] is None or place[r["reply_to"]] < r["position"] for r in mine)


def depth_first(parents):
    """Positions in depth-first order: parents[i] is the message that message i answers."""
    kids = {}
    for i, p in enumerate(parents):
        kids.setdefault(p, []).append(i)
    out, todo = [], [0]
    while todo:
        i = todo.pop()
        out.append(i)
        todo += reversed(kids.get(i, []))
    return out


def test_threads_stand_together(spark):
    rows = [(1, 0, "a", "A"), (1, 1, "b", "B"), (1, 2, "c", "> A\nre A"), (1, 3, "d", "> B\nre B"), (1, 4, "e", "> re A\nre re A"),
            (2, 0, "a", "x"), (2, 1, "b", "y"), (2, 2, "c", "> y\nz")]
    got = {(r["conv_id"], r["turn"]): r for r in chat.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    # A is answered by B (no quote: the one before) and by "re A"; each answer's own answers follow it.
    assert [got[1, t]["position"] for t in range(5)] == [1, 2, 4, 3, 5]
    assert [got[1, t]["reply_to_position"] for t in range(5)] == [None, 1, 1, 2, 4]
    assert [got[2, t]["position"] for t in range(3)] == [1, 2, 3] and [got[2, t]["reply_to_position"] for t in range(3)] == [None, 1, 2]


def test_reply_order_against_depth_first_walk(spark):
    rng = random.Random(9)
    rows, want = [], {}
    shapes = [lambda i: rng.randrange(i), lambda i: i - 1 if rng.random() < 0.8 else rng.randrange(i), lambda i: 0, lambda i: i - 1,
              lambda i: max(0, i - 2)]
    for conv in range(20):
        parents = [None] + [shapes[conv % 5](i) for i in range(1, rng.choice([1, 2, 3, 40, 150]))]
        rows += [(str(conv), i + 1, None if p is None else p + 1) for i, p in enumerate(parents)]
        if any(p != i - 1 for i, p in enumerate(parents) if i):
            want |= {(str(conv), i + 1): k + 1 for k, i in enumerate(depth_first(parents))}
    df = spark.createDataFrame(rows, "conv string, position long, parent long").repartition(5)
    assert {(r["conv"], r["position"]): r["place"] for r in chat.reply_order(df).collect()} == want


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.link_quotations(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, 1, "a", "x"), (None, 2, None, "> x"), (5, None, "a", "y"), (5, 0, "a", "z"), (6, 1, "a", "t"), (6, 1, "a", "t")], schema)
    got = sorted([(r["conv_id"], r["turn"], r["position"], r["n_linked"], r["reply_to"]) for r in chat.link_quotations(df).collect()], key=str)
    assert got == sorted([(None, 1, 1, 0, None), (None, 2, 2, 1, 1), (5, None, 1, 0, None), (5, 0, 2, 0, None), (6, 1, 1, 0, None), (6, 1, 2, 0, 1)], key=str)
