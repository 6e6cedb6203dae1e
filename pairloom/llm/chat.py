"""Chat formatting by quotation linking.

A message's lines are parsed into quote levels (leading ``>`` signs, blanks
between them allowed).  Neighbouring lines of one level form a paragraph;
level 0 is the message's own text, without the attribution line that
introduces a quotation.  Paragraphs are normalised (lower case, runs of blanks
as one) and hashed.  A quoted paragraph is joined by (conversation, hash) to
the latest earlier message whose own text has it; the link of the shallowest
level, then of the latest message, is the message replied to; a message
without a link replies to the one before it.  Conversations come out without
quotes, one row a message, numbered depth-first along the replies: a message
follows the one it answers, every thread stands together, and the answers to
one message stand in their order of turns.

A conversation may be of any size, so it is never gathered: earlier messages
are found by running maxima over range-partitioned blocks, and threads are
numbered by pointer jumping.  Stretches in which every message answers the one
before it and has no other answer are taken as one node; only conversations
that branch take part in the jumping.

Defined results: rows without conv_id form one conversation; a null turn sorts
first; a null text is empty; rows that agree in (conv_id, turn) are ordered by
role and text and don't quote each other; empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import store
from pairloom.operators.skew import ordered_prefix

_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
#: The line before a quotation, such as "On Monday, Ann wrote:".
_ATTRIBUTION = re.compile(r"(?:on|am|le|el)\b.*(?:wrote|schrieb|écrit|escribió)\s*:\s*", re.I)


def parse(text: str | None) -> list[tuple[int, str]]:
    """(level, paragraph) in order; blank lines and changes of level end a paragraph."""
    out: list[tuple[int, str]] = []
    level, lines = -1, []

    def close(following: int) -> None:
        own = list(lines)
        if level == 0 and following > 0 and own and _ATTRIBUTION.fullmatch(own[-1].strip()):
            own.pop()
        if own:
            out.append((level, "\n".join(own)))
        lines.clear()

    for line in (text or "").split("\n"):
        m = _QUOTE.fullmatch(line)
        at, rest = (m[1].count(">"), m[2]) if m else (0, line)
        if at != level or not rest.strip():
            close(at)
        level = at
        if rest.strip():
            lines.append(rest)
    close(0)
    return out


def normalised(paragraph: str) -> str:
    return " ".join(paragraph.lower().split())


def _hash(paragraph: str) -> str:
    return hashlib.md5(normalised(paragraph).encode("utf-8", "replace")).hexdigest()


def _parsed(conversations: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(t) for t in pdf["text"]]
            pdf["body"] = ["\n\n".join(p for lv, p in g if lv == 0) for g in got]
            pdf["own"] = [sorted({_hash(p) for lv, p in g if lv == 0}) for g in got]
            pdf["quotes"] = [[{"level": lv, "h": _hash(p)} for lv, p in g if lv > 0] for g in got]
            yield pdf.drop(columns="text")

    c = conversations.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn_text"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"))
    got = c.mapInPandas(rows, "conv string, turn_text string, role string, body string, own array<string>, "
                              "quotes array<struct<level:int,h:string>>")
    return got.withColumn("turn", F.col("turn_text").cast("long")).drop("turn_text")


def running_max(df: DataFrame, groups: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The largest ``value`` among earlier rows of the group, block by block.

    Rows are range-partitioned by (group, order), so a hot group is cut into
    blocks; a table of one row per (group, block) carries maxima across them.
    """
    blocked = store(df.repartitionByRange(*groups, *order).withColumn("__b", F.spark_partition_id()), "blocks")
    inner = Window.partitionBy(*groups, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = (blocked.groupBy(*groups, "__b").agg(F.max(value).alias("m")).withColumn("__m", F.max("m").over(over)).drop("m"))
    return (blocked.withColumn("__i", F.max(value).over(inner)).join(before, [*groups, "__b"])
            .withColumn(out, F.greatest("__i", "__m")).drop("__i", "__m", "__b"))


def _next_in(groups: list[str], df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """``df`` with the ``value`` of the following row of its group (null for the last) and its ``rank``."""
    ranked = store(ordered_prefix(df, groups, [F.col(order)], {"rank": F.lit(1)}, totals=False), "ranked")
    following = ranked.select(*groups, (F.col("rank") - 1).alias("rank"), F.col(value).alias(out))
    return ranked.join(following, [*groups, "rank"], "left")


def reply_order(messages: DataFrame) -> DataFrame:
    """conv, position and ``place``, the number in depth-first order, of conversations that branch.

    ``messages``: conv, position (1, 2, ... by turn) and parent, an earlier
    position (null for the first).  Conversations in which every message
    answers the one before it are in order already and give no rows.
    """
    m = messages.select("conv", "position", "parent")
    branching = store(m.filter("parent is not null and position <> parent + 1").select("conv", "parent").distinct(), "branching")
    convs = branching.select("conv").distinct()
    mine = store(m.join(convs, "conv", "left_semi"), "branched_messages")
    heads = mine.join(branching, ["conv", "parent"], "left_semi").unionByName(mine.filter("parent is null"))
    sizes = mine.groupBy("conv").agg(F.max("position").alias("size"))
    # A stretch ends before the next head; a head's parent is always the last message of its stretch.
    stretches = (_next_in(["conv"], heads.select("conv", F.col("position").alias("start"), "parent"), "start", "start", "after")
                 .join(sizes, "conv").withColumn("end", F.coalesce(F.col("after") - 1, F.col("size"))).drop("rank", "after", "size"))
    stretches = store(stretches, "stretches")
    kids = stretches.filter("parent is not null").join(
        stretches.select("conv", F.col("end").alias("parent"), F.col("start").alias("above")), ["conv", "parent"])
    kids = store(_next_in(["conv", "above"], kids.select("conv", "above", "start"), "start", "start", "sibling"), "siblings")
    first = kids.filter("rank = 1").select("conv", F.col("above").alias("start"), F.col("start").alias("first"))
    tree = (stretches.select("conv", "start", (F.col("end") - F.col("start") + 1).cast("long").alias("n"))
            .join(first, ["conv", "start"], "left").join(kids.select("conv", "start", "above", "sibling"), ["conv", "start"], "left"))
    # The tour enters a stretch (even node, its length) and leaves it (odd node, nothing).
    enter, leave = F.col("start") * 2, F.col("start") * 2 + 1
    steps = F.array(
        F.struct(enter.alias("node"), F.coalesce(F.col("first") * 2, leave).alias("next"), F.col("n").alias("left")),
        F.struct(leave.alias("node"), F.coalesce(F.col("sibling") * 2, F.col("above") * 2 + 1).alias("next"), F.lit(0).cast("long").alias("left")))
    tour = store(tree.select("conv", F.explode(steps).alias("s")).select("conv", "s.node", "s.next", "s.left"), "tour")
    while not tour.filter("next is not null").isEmpty():  # twice as far each round: log2(stretches) rounds
        ahead = tour.select("conv", F.col("node").alias("next"), F.col("next").alias("next2"), F.col("left").alias("more"))
        tour = store(tour.join(ahead, ["conv", "next"], "left").select(
            "conv", "node", F.col("next2").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")), "tour")
    # What a stretch has before it is what the whole has and the tour from here on doesn't.
    begin = (tour.filter("node % 2 = 0").join(sizes, "conv")
             .select("conv", F.expr("node div 2").alias("start"), (F.col("size") - F.col("left")).alias("before")))
    events = mine.select("conv", "position").join(
        begin.select("conv", F.col("start").alias("position"), F.struct("start", "before").alias("own")), ["conv", "position"], "left")
    placed = running_max(events, ["conv"], ["position"], "own", "last").withColumn("s", F.coalesce("own", "last"))
    return placed.select("conv", "position", (F.col("s.before") + F.col("position") - F.col("s.start") + 1).alias("place"))


def link_quotations(conversations: DataFrame) -> DataFrame:
    """conv_id, position (depth-first along the replies), turn, role, text
    (without quotes), n_quotes, n_linked, reply_to (turn of the message
    answered, null for none) and reply_to_position (its position)."""
    ranked = ordered_prefix(_parsed(conversations).withColumn("key", F.md5(F.concat_ws("\x1f", "role", "body"))),
                            ["conv"], [F.col("turn"), F.col("key")], {"position": F.lit(1)}, totals=False)
    msgs = store(ranked.withColumn("position", F.col("position").cast("long")), "chat_messages").withColumn("conv", F.coalesce("conv", F.lit("")))
    at = "struct<position:bigint,turn:bigint>"
    quotes = msgs.filter(F.size("quotes") > 0).select("conv", "position", "turn", F.explode("quotes").alias("q")).select(
        "conv", "position", "turn", F.col("q.h").alias("h"), F.col("q.level").alias("level"), F.lit(None).cast(at).alias("held"))
    quotes = store(quotes, "chat_quotes")
    # Only paragraphs that someone quotes take part.
    wanted = quotes.select("conv", "h").distinct()
    own = (msgs.select("conv", "turn", "position", F.explode("own").alias("h")).join(wanted, ["conv", "h"], "left_semi")
           .groupBy("conv", "h", "turn").agg(F.min("position").alias("position")))
    events = quotes.unionByName(own.withColumns({"held": F.struct("position", "turn").cast(at), "level": F.lit(None).cast("int")}))
    # Among equal turns quotes come first: a message answers earlier turns only.
    events = events.withColumn("kind", F.when(F.col("level").isNull(), 1).otherwise(0))
    found = running_max(events, ["conv", "h"], ["turn", "kind"], "held", "original").filter("kind = 0 and original is not null")
    links = found.groupBy("conv", "position").agg(F.count(F.lit(1)).alias("n_linked"), F.min(F.struct(
        "level", (-F.col("original.position")).alias("back"), F.col("original.turn").alias("turn"))).alias("b"))
    before = msgs.select("conv", (F.col("position") + 1).alias("position"), F.col("turn").alias("prev"))
    parent = F.when(F.col("b").isNotNull(), -F.col("b.back")).when(F.col("position") > 1, F.col("position") - 1)
    linked = store(msgs.join(links, ["conv", "position"], "left").join(before, ["conv", "position"], "left").select(
        "conv", "position", "turn", "role", "body", F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), parent.alias("parent"),
        F.when(F.col("b").isNotNull(), F.col("b.turn")).otherwise(F.col("prev")).alias("reply_to")), "chat_links")
    places = store(reply_order(linked), "chat_places")
    above = places.select("conv", F.col("position").alias("parent"), F.col("place").alias("above"))
    out = linked.join(places, ["conv", "position"], "left").join(above, ["conv", "parent"], "left")
    return out.select(
        F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), F.coalesce("place", "position").cast("long").alias("position"),
        "turn", "role", F.col("body").alias("text"), "n_quotes", "n_linked", "reply_to",
        F.coalesce("above", "parent").cast("long").alias("reply_to_position"))
