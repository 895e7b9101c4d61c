"""Conversations from quoted messages, with DataFrame functions only.

A line that starts with ``>`` signs is quoted; the number of signs is its level. Consecutive lines of one level are a
passage. Passages, whole messages and the lines of messages are compared by hashes of their normalised text (lower case, white
space squashed); a passage that is only a part of a message is looked for by its longest line and then compared with that
message. A message answers the one that its last passage of level one comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import let
from ..session import stage
from .common import prefix_sums

_MARK = r"^[ \t]*(>[> \t]*)"
BLOCK_TURNS = 4096      # turns whose messages are looked through together


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines_of(text: Column) -> Column:
    """Array of (level, line without its signs) of a text."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, _MARK, 1), r"[^>]", "")).alias("level"),
        F.regexp_replace(line, _MARK, "").alias("line")))


def body_of(text: Column) -> Column:
    """The text without its quoted lines, trimmed."""
    own = F.filter(lines_of(text), lambda x: x.level == 0)
    return F.regexp_replace(F.array_join(F.transform(own, lambda x: x.line), "\n"), r"^\s+|\s+$", "")


def passages_of(text: Column) -> Column:
    """Array of (level, text) of the quoted passages, in order: consecutive quoted lines of one level.

    Each passage is cut out of the list of lines once, so the work grows with the text, however long a passage is.
    """
    def cut(lines: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == 1) | (
            F.element_at(lines, i).level != F.element_at(lines, F.greatest(i - 1, F.lit(1))).level))
        return let(F.concat(first, F.array(F.size(lines) + 1)), lambda at: F.transform(
            F.sequence(F.lit(1), F.size(at) - 1), lambda k: F.struct(
                F.element_at(lines, F.element_at(at, k)).level.alias("level"),
                F.array_join(F.transform(F.slice(lines, F.element_at(at, k), F.element_at(at, k + 1) - F.element_at(at, k)),
                                         lambda x: x.line), "\n").alias("text"))))

    return F.filter(let(lines_of(text), cut), lambda p: (p.level > 0) & (normalised(p.text) != ""))


def own_lines(text: Column) -> Column:
    """The normalised lines of a text that hold a word, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(text, "\n"), normalised), lambda line: line != ""))


def _longest(lines: Column) -> Column:
    """The longest of the lines, of several the first."""
    return F.array_max(F.transform(lines, lambda line, i: F.struct(F.length(line).alias("n"), (-i).alias("i"), line.alias("line"))))["line"]


def latest_before(said: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked(conv_id, hash, turn, …)`` with ``found``: the greatest earlier turn of the conversation in ``said`` with that hash.

    A running maximum over both together, inside blocks of turns and then over the blocks, so a hash that is said and asked
    for without end in one conversation makes neither pairs nor one large group.
    """
    key, more = ["conv_id", "hash", "_block"], [c for c in asked.columns if c not in ("conv_id", "hash", "turn")]
    both = said.select("conv_id", "hash", "turn", F.lit(1).alias("_said"), *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in more]).unionByName(
        asked.select("conv_id", "hash", "turn", F.lit(0).alias("_said"), *more)).withColumn("_block", F.floor(F.col("turn") / BLOCK_TURNS))
    told = F.max(F.when(F.col("_said") == 1, F.col("turn")))
    blocks = both.groupBy(*key).agg(told.alias("_last"))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(*key, F.max("_last").over(earlier).alias("_before"))
    inside = Window.partitionBy(*key).orderBy("turn", "_said").rowsBetween(Window.unboundedPreceding, -1)   # of one turn, asked first
    return (both.withColumn("_inside", told.over(inside)).where("_said = 0").join(before, key)
            .withColumn("found", F.coalesce("_inside", "_before")).drop("_block", "_said", "_inside", "_before"))


def thread(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", rounds: int = 64) -> DataFrame:
    """Per message: conv_id, turn, role, body (without quotes), depth, n_passages, n_linked, parent_conv, parent_turn,
    root_turn, reply_depth, place.

    A passage is linked to the latest earlier message of its own conversation with that body; else to the latest there that
    holds the passage's longest line, if the passage stands in that message; else to the first message of all others (by
    conv_id, turn) with that body; else to the first one of them with that line, if it holds the passage. The parent is where the last
    linked passage of level one comes from, if that is in the same conversation. A message without parent is a root;
    ``place`` counts each conversation's messages by root and turn, which is reply order, since a parent stands before
    its replies.

    Null texts are empty. Messages with a null conv_id or turn are returned as roots and are linked to by none. Repeated rows
    give a row each, and so do rows that share conv_id and turn. Other columns are not read. An empty table gives an
    empty result. Links are joins on hashes. A body that many messages share is one row (the first) outside its
    conversations; nothing is gathered by conversation.
    """
    m = stage(messages.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
        F.col(text_col).alias("text")).select(
            "conv_id", "turn", "role", body_of(F.col("text")).alias("body"), passages_of(F.col("text")).alias("passages"),
            F.xxhash64("conv_id", "turn", "role", "text").alias("mid")), "messages")
    placed = m.where("conv_id IS NOT NULL AND turn IS NOT NULL AND trim(body) <> ''").select("conv_id", "turn", "body")
    whole = F.array(normalised(F.col("body")))
    lines = own_lines(F.col("body"))
    units = stage(placed.select("conv_id", "turn", F.explode(F.concat(
        F.transform(whole, lambda t: F.sha2(F.concat(F.lit("all "), t), 256)),
        F.transform(lines, lambda t: F.sha2(F.concat(F.lit("line "), t), 256)))).alias("hash")).distinct(), "units")
    quoted = stage(m.where(F.size("passages") > 0).select("mid", "conv_id", "turn", "passages").dropDuplicates(["mid"])
                   .select("mid", "conv_id", "turn", F.posexplode("passages").alias("n", "p"))
                   .select("mid", "conv_id", "turn", "n", F.col("p.level").alias("level"), normalised(F.col("p.text")).alias("said"),
                           _longest(own_lines(F.col("p.text"))).alias("line")), "passages")
    # Two lookups of each passage, in its own conversation and elsewhere: 0 by the whole body, 1 by a line.
    asked = quoted.select("mid", "n", "conv_id", "turn", F.posexplode(F.array(
        F.sha2(F.concat(F.lit("all "), "said"), 256), F.sha2(F.concat(F.lit("line "), "line"), 256))).alias("way", "hash"))
    inside = latest_before(units, asked.where("conv_id IS NOT NULL AND turn IS NOT NULL")).where("found IS NOT NULL").select(
        "mid", "n", "way", F.col("conv_id").alias("to_conv"), F.col("found").alias("to_turn"))
    first = units.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("out"))
    outside = asked.join(first, "hash").where(~F.col("out.conv_id").eqNullSafe(F.col("conv_id"))).select(
        "mid", "n", (F.col("way") + 2).alias("way"), F.col("out.conv_id").alias("to_conv"), F.col("out.turn").alias("to_turn"))
    # Four ways at most for each passage; those by a line count if the passage stands in the message they lead to.
    ways = stage(inside.unionByName(outside), "ways")
    bodies = placed.select(F.col("conv_id").alias("to_conv"), F.col("turn").alias("to_turn"), normalised(F.col("body")).alias("told"))
    held = (ways.where("way % 2 = 1").join(ways.where("way = 0").select("mid", "n"), ["mid", "n"], "left_anti")
            .join(quoted.select("mid", "n", "said"), ["mid", "n"]).join(bodies, ["to_conv", "to_turn"])
            .where(F.col("told").contains(F.col("said"))).select("mid", "n", "way", "to_conv", "to_turn"))
    links = (ways.where("way % 2 = 0").unionByName(held).groupBy("mid", "n")
             .agg(F.min(F.struct("way", "to_conv", "to_turn")).alias("to")).select("mid", "n", "to.to_conv", "to.to_turn"))
    linked = quoted.select("mid", "n", "level").join(links, ["mid", "n"], "left")
    last = F.max(F.when((F.col("level") == 1) & F.col("to_turn").isNotNull(), F.struct("n", "to_conv", "to_turn")))
    per_message = linked.groupBy("mid").agg(F.max("level").cast("long").alias("depth"), F.count("*").alias("n_passages"),
                                            F.count("to_turn").alias("n_linked"), last.alias("parent"))
    told = stage(m.select("mid", "conv_id", "turn", "role", "body").join(per_message, "mid", "left").select(
        "mid", "conv_id", "turn", "role", "body", F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("parent.to_conv").alias("parent_conv"), F.col("parent.to_turn").alias("parent_turn")), "linked")

    # Roots by pointer doubling: after k rounds each message knows its ancestor 2 ** k steps up. Those that have reached
    # their root leave the rounds, so a long conversation doesn't make the short ones go round with it.
    active = stage(told.where("parent_conv = conv_id").groupBy("conv_id", "turn").agg(
        F.max("parent_turn").alias("up")).withColumn("hops", F.lit(1)), "steps")
    done = active.limit(0)
    for _ in range(rounds):
        above = done.union(active).select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"),
                                          F.col("hops").alias("more"))
        longer = stage(active.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.coalesce("next", "up").alias("up"),
            (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("next").isNotNull().alias("moved")), "steps")
        done = done.union(longer.where("NOT moved").drop("moved"))
        active = longer.where("moved").drop("moved")
        if active.isEmpty():
            break
    else:
        raise RuntimeError(f"a conversation is longer than 2 ** {rounds} turns")
    roots = done.select("conv_id", "turn", F.col("up").alias("root"), "hops")
    found = (told.join(roots, ["conv_id", "turn"], "left")
             .withColumn("root_turn", F.coalesce("root", "turn")).withColumn("_one", F.lit(1).cast("long"))
             .withColumn("_conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
             .withColumn("_block", F.coalesce(F.floor(F.col("root_turn") / BLOCK_TURNS), F.lit(-1 << 62))))
    ordered = prefix_sums(found, "_conv", "_block", [F.asc_nulls_first("root_turn"), F.asc_nulls_first("turn"), "mid"], "_one", "_before")
    return ordered.select("conv_id", "turn", "role", "body", "depth", "n_passages", "n_linked", "parent_conv", "parent_turn", "root_turn",
                          F.coalesce("hops", F.lit(0)).cast("long").alias("reply_depth"), (F.col("_before") + 1).alias("place"))


def with_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` as mail would show them: each quotes the message before it, and that one's quote of the one before.

    A message of an odd turn quotes only the last line of each. The given conversations hold no quotes, so queries and
    tests quote them this way.
    """
    before = Window.partitionBy("conv_id").orderBy("turn")

    def marked(text: Column, sign: str) -> Column:
        part = F.when(F.col("turn") % 2 == 1, F.element_at(F.split(F.rtrim(text), r"\r\n|\r|\n"), -1)).otherwise(text)
        return F.when(text.isNotNull(), F.regexp_replace(F.concat(F.lit("\n"), part), r"\r\n|\r|\n", f"\n{sign} "))

    one, two = F.lag("text", 1).over(before), F.lag("text", 2).over(before)
    return messages.select("conv_id", "turn", "role", F.concat(
        F.coalesce(marked(two, ">>"), F.lit("")), F.coalesce(marked(one, ">"), F.lit("")), F.lit("\n\n"),
        F.coalesce("text", F.lit(""))).alias("text"))
