"""Token output round trips and packings."""

import random
import zlib

import numpy as np
import pytest

from pairloom.llm import bitplanes, packing
from pairloom.llm.tokens import Encoder, default_path

ODD = ["", "a<|endoftext|>b <|startoftext|>", "don't  can'T x\x0by", "İstanbul Σίσυφος ΣΑΣ", "éa ̈b", "日本 語a1２٣", "\x1c\x85 a\x00b",
       "’s 'S it'll", "ſ ŉ Ǆ ß ẞ", "x­b ​ ﻿", "Å K ²³¼ ½a", "÷×ñÑ_-—…", "a.b,,c...d ., 1.2", "Of%%% athe*** e.%%%", "x" * 5000, "ab " * 9000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_cached_ids_are_the_library_ids(library, texts):
    e = Encoder(default_path())
    for text in [*ODD, *[t for _, t in texts[:250]]]:
        assert np.frombuffer(e.encode(text), "<u2").tolist() == library(text)


def test_other_vocabularies_go_through_the_library(texts):
    from tokenizers import Tokenizer

    other = default_path("byte_bpe_50k.json")
    enc, lib = Encoder(other), Tokenizer.from_file(other)
    assert not enc.fast and Encoder(default_path()).fast
    for _, t in [*texts[:50], (0, "Plain text, with  two blanks."), (0, None)]:
        assert np.frombuffer(enc.encode(t), "<u2").tolist() == lib.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 16, n).astype(np.uint16)
    planes = bitplanes.split_planes(ids, kind)
    assert len(planes) == {"byte": 2, "bit": 16}[kind]
    assert (bitplanes.join_planes(planes, n) == ids).all()


@pytest.mark.parametrize("block,kind", [(64, "bit"), (1 << 16, "byte")])
def test_token_files_round_trip(spark, library, block, kind):
    rows = [(i * 3 % 37, t) for i, t in enumerate([*ODD, None, "x y z", "x y z"])]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, shard int, chunk int").repartition(3)
    chunks, index = bitplanes.write_tokens(df, end=2, block=block, kind=kind)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in bitplanes.read_documents(chunks, index).collect()}
    at, want = 0, {}
    for doc, text in sorted(rows):
        ids = np.array([*library(text), 2], "<u4")
        want[doc] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want
    sizes = [r["n_ids"] for r in chunks.select("n_ids").collect()]
    assert max(sizes) <= block and sum(sizes) == at
    assert sorted((r["start"] for r in index.collect()))[0] == 0


def test_token_files_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert bitplanes.read_documents(*bitplanes.write_tokens(spark.createDataFrame([], schema))).count() == 0
    df = spark.createDataFrame([(None, None), (4, "a"), (4, "a")], schema)
    got = [tuple(r)[:3] for r in bitplanes.read_documents(*bitplanes.write_tokens(df)).orderBy("start").collect()]
    assert got == [(None, 0, 1), (4, 1, 2), (4, 3, 2)]


def check_plan(hist, plan, capacity):
    left = dict(hist)
    for filling, many in plan:
        assert sum(filling) <= capacity
        for s in filling:
            left[s] -= many
    assert all(n == 0 for n in left.values())


def test_plans_are_whole_and_near_the_bound():
    rng = random.Random(2)
    for capacity, most, n in ((100, 100, 300), (100, 60, 2000), (4096, 4096, 5000), (10, 3, 50)):
        hist = {}
        for _ in range(n):
            s = rng.randrange(1, most + 1)
            hist[s] = hist.get(s, 0) + rng.choice([1, 1, 5])
        plan = packing.bin_completion(hist, capacity)
        check_plan(hist, plan, capacity)
        check_plan(hist, packing.best_fit(dict(hist), capacity), capacity)
        used = sum(m for _, m in plan)
        assert used <= sum(m for _, m in packing.best_fit(dict(hist), capacity))
        total = sum(s * m for s, m in hist.items())
        big = sum(m for s, m in hist.items() if 2 * s > capacity)
        assert used <= 1.02 * max(-(-total // capacity), big) + 1


def test_completion_finds_the_exact_filling_best_fit_misses():
    # Best fit takes 60 and wastes 10; 40 + 30 fills the room.
    assert packing.completion([30, 40, 60], {30: 1, 40: 1, 60: 1}, 70) == (40, 30)
    assert sum(m for _, m in packing.bin_completion({30: 2, 40: 2, 60: 1}, 100)) == 2


def test_pack_places_every_piece(spark, library):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "ab " * 4095, "ab " * 4096, "ab " * 5000])] + [(None, "x"), (3, "x"), (3, "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int")
    got = packing.pack(df, end=1).collect()
    want = []
    for doc, text in rows:
        ids = np.array([*library(text), 1], "<u4")
        want += [(doc, k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack(df.limit(0)).count() == 0


def test_plans_branch_over_fillings():
    """Fillings without waste that leave no way for the rest are taken back."""
    hist = {128: 60, 640: 120, 1536: 120, 1792: 60, 1920: 60}
    plan = packing.bin_completion(hist, 4096)
    check_plan(hist, plan, 4096)
    assert sum(m for _, m in plan) == 120 == packing.least_bins(hist, 4096)


def test_small_plans_are_the_smallest():
    def fewest(left, rooms, most):
        if not left:
            return len(rooms)
        best = most
        for r in sorted({*[r for r in rooms if r >= left[0]], 20}):
            rest = list(rooms)
            if r in rest:
                rest.remove(r)
            if len(rest) < best:
                best = min(best, fewest(left[1:], [*rest, r - left[0]], best))
        return best

    rng = random.Random(8)
    for _ in range(60):
        pieces = sorted((rng.randrange(3, 14) for _ in range(9)), reverse=True)
        hist = {s: pieces.count(s) for s in pieces}
        plan = packing.bin_completion(hist, 20)
        check_plan(hist, plan, 20)
        least = fewest(pieces, [], 10)
        assert packing.least_bins(hist, 20) <= least == sum(m for _, m in plan)
