"""Best-fit packing of documents into sequences by bin completion.

A packing depends only on how many pieces have each length, and lengths run
from 1 to the capacity.  So one pass tokenises the texts and writes a narrow
row per piece; its histogram (at most ``capacity`` rows) goes to the driver;
bin completion turns it into patterns with multiplicities; and every piece
finds its place from (length, rank among pieces of that length).  Ranks are a
counter inside each task plus an offset per (task, length), so no length's
pieces ever meet in one task.

Bin completion (Korf, 2002, after Martello and Toth): a sequence is built
around the largest piece left.  A first plan takes the filling of least waste
(branch and bound, larger pieces first, from the best-fit filling on) as often
as the counts allow, so the plan grows with the number of distinct lengths and
not with the corpus.  Best-fit decreasing gives another.  While the better of
the two is over the bound (``least_bins``), ``branch`` searches on: over the
undominated fillings of each largest length, least waste first (a filling is
dominated when one piece, or two, can be replaced by one larger piece that
still fits, or one more fits), and over how often each is used, with
backtracking on the histogram.  It looks for a plan at the bound first, then
1, 3, 7, ... sequences over it, until one is found, nothing is left to try or
``BRANCHES`` nodes are spent.

Defined results: null and empty texts are one piece of the end id; a null
doc_id is kept; repeated rows are packed each on its own; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import store
from pairloom.llm.tokens import default_path, encoder

CAPACITY = 4096
#: Branch-and-bound nodes per filling; beyond them the incumbent stands.
NODES = 3000
#: Nodes of the search over whole plans; beyond them the best plan found stands.
BRANCHES = 400_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

Pattern = tuple[tuple[int, ...], int]


def pieces(documents: DataFrame, end: int = 1, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One stored row per piece; ``nth`` counts pieces of its length in its task ``part``."""
    path = path or default_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, stop, part = encoder(path), np.array([end], "<u2").tobytes(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.frombuffer(enc.encode(text) + stop, "<u2").astype("<u4")
                for k, s in enumerate(range(0, len(ids), capacity)):
                    p = ids[s:s + capacity]
                    out.append((doc, k, s, len(p), zlib.crc32(p.tobytes()), part, seen[len(p)]))
                    seen[len(p)] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]).astype({"doc_id": "Int64"})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return store(docs.mapInPandas(cut, PIECE), "pieces")


def best_fit(count: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram, as patterns with multiplicities."""
    open_bins: dict[int, list[list]] = {}  # room left -> [filling, how many]
    rooms: list[int] = []
    done: list[Pattern] = []

    def put(room: int, filling: tuple[int, ...], many: int) -> None:
        if room == 0:
            done.append((filling, many))
            return
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append([filling, many])

    for size in sorted(count, reverse=True):
        left = count[size]
        while left:
            at = bisect_right(rooms, size - 1)
            if at == len(rooms):
                fit = capacity // size
                full, rest = divmod(left, fit)
                if full:
                    put(capacity - fit * size, (size,) * fit, full)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[at]
            filling, many = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            fit = min(room // size, left)
            use = min(many, left // fit)
            put(room - fit * size, filling + (size,) * fit, use)
            if many > use:
                put(room, filling, many - use)
            left -= use * fit
    return done + [(f, n) for group in open_bins.values() for f, n in group]


def completion(sizes: list[int], count: dict[int, int], room: int, nodes: int = NODES) -> tuple[int, ...]:
    """The filling of least waste for ``room`` from ``sizes`` (ascending, with counts)."""
    best: tuple[int, ...] = ()
    waste, budget = room, nodes
    below = list(accumulate((s * count[s] for s in sizes), initial=0))  # ids in pieces under each size

    def fill(r: int, top: int, chosen: tuple[int, ...]) -> None:
        """Try pieces of index under ``top``, each size once with its number of uses, most first."""
        nonlocal best, waste, budget
        if r < waste:
            best, waste = chosen, r  # the first leaf is the best-fit filling
        at = min(top, bisect_right(sizes, r))
        while at > 0 and waste and budget > 0 and r - below[at] < waste:
            at -= 1
            size = sizes[at]
            for k in range(min(count[size], r // size), 0, -1):
                budget -= 1
                fill(r - k * size, at, chosen + (size,) * k)
                if not waste or budget <= 0:
                    break

    fill(room, len(sizes), ())
    return best


def greedy(hist: dict[int, int], incumbent: list[Pattern], capacity: int, nodes: int) -> list[Pattern]:
    """The filling of least waste for the largest length, as often as it goes, and so on; or the incumbent if that is no worse."""
    count = dict(hist)
    limit = sum(n for _, n in incumbent)
    total = sum(s * n for s, n in count.items())
    slack = (limit - 1) * capacity - total  # waste allowed to beat the incumbent
    plan: list[Pattern] = []
    sizes = sorted(count)
    while sizes:
        big = sizes[-1]
        count[big] -= 1
        if not count[big]:
            sizes.pop()
        filling = (big, *completion(sizes, count, capacity - big, nodes))
        count[big] += 1
        if not sizes or sizes[-1] != big:
            sizes.append(big)
        need: dict[int, int] = {}
        for s in filling:
            need[s] = need.get(s, 0) + 1
        many = min(count[s] // k for s, k in need.items())
        for s, k in need.items():
            count[s] -= k * many
            if not count[s]:
                del count[s]
                sizes.remove(s)
        plan.append((filling, many))
        slack -= (capacity - sum(filling)) * many
        if slack < 0 and sizes:  # cannot beat the incumbent any more
            return incumbent
    return plan if sum(n for _, n in plan) < limit else incumbent


def least_bins(count: dict[int, int], capacity: int) -> int:
    """A lower bound: ids over capacity, and pieces over half the capacity with what doesn't fit beside them (Martello and Toth)."""
    size = np.array(sorted(count), np.int64)
    n = np.array([count[s] for s in size.tolist()], np.int64)
    pieces_to, ids_to = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    half = np.searchsorted(size, capacity // 2, "right")  # from here on no two fit together
    best = -(-int(ids_to[-1]) // capacity)
    for i in range(half + 1):  # pieces under index i are left out
        least = int(size[i]) if i < half else capacity // 2 + 1
        alone = np.searchsorted(size, capacity - least, "right")  # from here on none of the others fits beside
        large = int(pieces_to[-1] - pieces_to[half])
        room = int(pieces_to[max(alone, half)] - pieces_to[half]) * capacity - int(ids_to[max(alone, half)] - ids_to[half])
        best = max(best, large + max(0, -(-(int(ids_to[half] - ids_to[i]) - room) // capacity)) if i < half else large)
    return best


def dominated(filling: tuple[int, ...], sizes: list[int], count: dict[int, int], room: int) -> bool:
    """Whether a piece that is left can replace none, one or two pieces of ``filling`` (not its first) and still fit."""
    used: dict[int, int] = {}
    for s in filling:
        used[s] = used.get(s, 0) + 1
    rest = filling[1:]
    some = {0} | set(rest) | {a + b for i, a in enumerate(rest) for b in rest[i + 1:]}
    one = set(rest)
    for total in some:
        # A piece of the size of one that goes changes nothing; of two that go, it does.
        at = bisect_right(sizes, total) if total in one or not total else bisect_right(sizes, total - 1)
        while at < len(sizes) and sizes[at] <= total + room:
            if count[sizes[at]] > used.get(sizes[at], 0):
                return True
            at += 1
    return False


def fillings(count: dict[int, int], capacity: int, slack: int, nodes: int) -> tuple[list[tuple[int, ...]], int]:
    """The undominated fillings around the largest length that waste at most ``slack``, least waste first, and the nodes spent."""
    sizes = sorted(count)
    big, found, spent = sizes[-1], [], 0
    below = list(accumulate((s * count[s] for s in sizes), initial=0))

    def fill(r: int, top: int, chosen: tuple[int, ...]) -> None:
        nonlocal spent
        if r <= slack and not dominated(chosen, sizes, count, r):
            found.append((r, len(found), chosen))
        at = min(top, bisect_right(sizes, r))
        while at > 0 and spent < nodes and r - below[at] <= slack:
            at -= 1
            size = sizes[at]
            for k in range(min(count[size] - (size == big), r // size), 0, -1):
                spent += 1
                fill(r - k * size, at, chosen + (size,) * k)
                if spent >= nodes:
                    break

    fill(capacity - big, len(sizes), (big,))
    return [f for _, _, f in sorted(found)], spent + 1 + len(sizes) // 8  # what sorting the lengths costs


def branch(hist: dict[int, int], target: int, capacity: int, nodes: int, budget: int, whole: bool) -> list[Pattern] | None:
    """A plan of at most ``target`` sequences, or None where ``budget`` nodes give none; ``whole``: fillings are used as often as they go."""
    count, slack = dict(hist), target * capacity - sum(s * n for s, n in hist.items())
    rng = random.Random(0)
    mark = {s: rng.getrandbits(64) for s in hist}
    state, tried = 0, set()  # what has been taken, as a sum of marks, and the states searched from
    path: list[tuple[tuple[int, ...], int]] = []

    def take(filling: tuple[int, ...], many: int) -> None:
        nonlocal state
        for s in filling:
            state += mark[s] * many
            left = count.get(s, 0) - many
            if left:
                count[s] = left
            else:
                del count[s]

    def choices() -> Iterator[tuple[tuple[int, ...], int]]:
        nonlocal budget
        options, spent = fillings(count, capacity, slack, min(nodes, budget))
        budget -= spent
        for f in options:
            waste = capacity - sum(f)
            many = min(count[s] // f.count(s) for s in set(f))
            many = min(many, slack // waste) if waste else many
            while many > 0:
                yield f, many
                many = 0 if whole else many // 2

    stack = [choices()]
    while stack and budget > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                filling, many = path.pop()
                take(filling, -many)
                slack += (capacity - sum(filling)) * many
            continue
        budget -= 1
        filling, many = step
        waste = (capacity - sum(filling)) * many
        if waste > slack:
            continue
        path.append(step)
        take(filling, many)
        slack -= waste
        if not count:  # no more waste than target sequences have: at most so many
            return path
        seen = (state, slack) in tried
        tried.add((state, slack))
        stack.append(iter(()) if seen else choices())
    return None


def bin_completion(hist: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, budget: int = BRANCHES) -> list[Pattern]:
    """Patterns (lengths in a sequence, how many such sequences) for the histogram."""
    count = {s: n for s, n in hist.items() if n}
    if not count:
        return []
    plan = greedy(count, best_fit(dict(count), capacity), capacity, nodes)
    used, bound = sum(n for _, n in plan), least_bins(count, capacity)
    targets = [t for k in range(64) if (t := bound + (1 << k) - 1) < used]  # the bound, then ever less tight
    for t in targets:
        for whole in (True, False):
            if better := branch(count, t, capacity, nodes, budget // (2 * len(targets)), whole):
                return better
    return plan


def slots(plan: list[Pattern]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length << 44 | first rank), sequence of that rank and offset of each slot."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for filling, many in plan:
        at = 0
        for s in filling:
            r = rank.get(s, 0)
            rows.append(((s << 44) | r, base, at))
            rank[s] = r + many
            at += s
        base += many
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2]


def pack(documents: DataFrame, end: int = 1, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    rows = pieces(documents, end, capacity, path)
    per = store(rows.groupBy("part", "length").agg(F.max("nth").alias("last")), "piece_counts")
    hist = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()}
    # At most ``capacity`` lengths, and few patterns a length: its size does not follow the corpus.
    plan = documents.sparkSession.sparkContext.broadcast(slots(bin_completion(hist, capacity)))
    before = F.sum(F.col("last") + 1).over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = rows.join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, base, at = plan.value
        for pdf in batches:
            key = (pdf["length"].to_numpy(np.int64) << 44) | pdf["rank"].to_numpy(np.int64)
            i = np.searchsorted(keys, key, "right") - 1
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            pdf["sequence_id"], pdf["offset"] = base[i] + key - keys[i], at[i]
            yield pdf.drop(columns="rank")

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
