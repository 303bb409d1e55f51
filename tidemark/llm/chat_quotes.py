"""Operator 4: quotation linking of conversations, in DataFrame functions only.

Method. A message's lines carry a quote level, their leading ``>`` marks. Lines of one level in a row are a passage; it is
normalised (lower case, letters and digits only, one space between words; a whole message of neither, as it stands) and hashed. A passage
of any level is joined with the earliest message of its conversation whose own words (level 0) hold it as a line, a paragraph or the
whole message; one below LEAST_CHARS only as the whole message. Of the messages before it that a message quotes so at the least level
that links to any, it answers the latest; those of deeper levels are returned beside it. Root and depth of each message come from pointer doubling over the answers, one
join of unique keys a round. The result orders a conversation's messages by root, depth and turn, so that each
follows what it answers, with quotes taken out of the text.

Scale. Originals are reduced to the earliest message of each (conversation, hash) with partial aggregation before the join, so a
passage that very many messages hold is one row, and a conversation of any size is never gathered into a row or task.

Cases. A null text is empty and quotes nothing. Quotes that match no earlier message link nothing and are still taken out. Null
conversation or turn: the message is its own root, at position null. Repeated (conversation, turn) rows are each returned; links
go to the turn. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.folds import let
from tidemark.llm.shared import Scratch

#: Shortest normalised passage (characters) that links to a part of a message; a shorter one links to a whole message only, so
#: that "ok" or "thanks" as one line of many don't.
LEAST_CHARS = 12
#: Answers (four numbers each) up to which they are broadcast to each other.
BROADCAST_ROWS = 200_000
_QUOTE = r"^(?:[ \t]*>)+[ \t]?"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    """(level, line without its marks) of each line."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")
    return F.transform(lines, lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, _QUOTE, 0), "[^>]", "")).alias("level"), F.regexp_replace(x, _QUOTE, "").alias("line")))


def _passages(lines: Column) -> Column:
    """(level, text) of runs of lines of one level."""

    def of(x: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: (i == 1) | (F.get(x, i - 1)["level"] != F.get(x, i - 2)["level"]))
        upto = lambda o, k: F.coalesce(F.get(o, k + 1), F.size(x) + 1)
        text = lambda o, i, k: F.array_join(F.transform(F.slice(x, i, upto(o, k) - i), lambda y: y["line"]), "\n")
        return let(opens, lambda o: F.transform(o, lambda i, k: F.struct(F.get(x, i - 1)["level"].alias("level"), text(o, i, k).alias("text"))))

    return let(lines, of)


def _hashes(parts: Column, wholes: Column) -> Column:
    """Hashes of ``parts`` that are long enough to link, and of ``wholes`` of any length."""
    long_enough = F.filter(F.transform(parts, normalised), lambda x: F.length(x) >= LEAST_CHARS)
    as_is = F.transform(wholes, lambda x: F.when(normalised(x) == "", F.trim(x)).otherwise(normalised(x)))
    texts = F.concat(long_enough, F.filter(as_is, lambda x: F.length(x) > 0))
    return F.transform(F.array_distinct(texts), lambda x: F.sha2(x, 256))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own (text without quotes), own_hashes, quoted (level, hash), n_quotes."""
    quotes = F.col("text").rlike("(?m)^[ \\t]*>")
    lined = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("lines", F.when(quotes, _lines(F.col("text")))).withColumn("passages", F.when(quotes, _passages(F.col("lines"))))
    own = F.when(F.col("passages").isNull(), F.col("text")).otherwise(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n"))
    own_hashes = _hashes(F.concat(F.split("own", "\n"), F.split("own", "\n\\s*\n")), F.array("own"))
    of_passage = lambda p: F.transform(_hashes(F.split(p["text"], "\n"), F.array(p["text"])), lambda h: F.struct(p["level"].alias("level"), h.alias("hash")))
    quoted = F.filter("passages", lambda p: p["level"] > 0)
    return lined.withColumn("own", F.trim(own)).select(
        "conv_id", "turn", "role", "own", own_hashes.alias("own_hashes"), F.when(F.size(quoted) > 0, F.array_distinct(F.flatten(F.transform(quoted, of_passage)))).alias("quoted"),
        F.coalesce(F.size(quoted), F.lit(0)).cast("long").alias("n_quotes"),
    )


def link_quotes(messages: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) to conv_id, turn, role, text (without quotes), n_quotes, quoted_turns (level and turn of all
    that it quotes), reply_to (turn or null), root (turn), depth and position (from 0, within the conversation)."""
    spark = messages.sparkSession
    scratch = Scratch(spark, "quotes")
    rows = scratch.keep(parsed(messages), "parsed")
    placed = rows.where("conv_id is not null and turn is not null")
    quoted = placed.where("quoted is not null").select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.level", "q.hash").distinct()
    wanted = quoted.select("conv_id", "hash").distinct()
    held = placed.select("conv_id", "turn", F.explode("own_hashes").alias("hash")).join(wanted, ["conv_id", "hash"], "left_semi").groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))
    met = quoted.join(held, ["conv_id", "hash"]).where("first < turn").groupBy("conv_id", "turn", "level", "first").count()
    nearest = F.max(F.struct((-F.col("level")).alias("above"), F.col("first").alias("to")))
    turns = F.array_sort(F.collect_list(F.struct("level", F.col("first").alias("turn"))))  # as many as the message quotes
    answers = scratch.keep(met.groupBy("conv_id", "turn").agg(nearest.alias("n"), turns.alias("quoted_turns")).select("conv_id", "turn", F.col("n.to").alias("to"), "quoted_turns"), "answers")
    # Pointer doubling: every message that answers knows an ancestor and how far up it is. Many may share an ancestor; the other side is unique,
    # and small ones are broadcast by a count of their rows.
    now = answers.select("conv_id", "turn", F.col("to").alias("root"), F.lit(1).cast("long").alias("depth"))
    hint = F.broadcast if answers.count() <= BROADCAST_ROWS else lambda df: df
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("root2"), F.col("depth").alias("depth2"))
        joined = now.join(hint(up), ["conv_id", "root"], "left")
        before, now = now, scratch.keep(joined.select("conv_id", "turn", F.coalesce("root2", "root").alias("root"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"), F.col("root2").isNotNull().alias("moved")), "pointers")
        scratch.drop(before)
        if now.where("moved").isEmpty():
            break
    now = now.drop("moved")
    linked = rows.join(answers, ["conv_id", "turn"], "left").join(now, ["conv_id", "turn"], "left")
    none = F.array().cast("array<struct<level int, turn bigint>>")
    out = linked.select("conv_id", "turn", "role", F.col("own").alias("text"), "n_quotes", F.coalesce(F.col("quoted_turns").cast("array<struct<level int, turn bigint>>"), none).alias("quoted_turns"), F.col("to").alias("reply_to"), F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    return _with_positions(out, scratch)


def _with_positions(out: DataFrame, scratch: Scratch) -> DataFrame:
    """Positions by (root, depth, turn) within each conversation, without one task per conversation: rows are range-sorted, counted
    by partition and conversation, and numbered from the counts before."""
    keys = ["conv_id", "root", "depth", "turn"]
    cut = scratch.keep(out.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()), "sorted")
    from pyspark.sql import Window

    counts = cut.groupBy("conv_id", "part").count()
    before = counts.select("conv_id", "part", (F.sum("count").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("count")).alias("before"))
    here = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*keys[1:], "role", "text")) - 1
    numbered = cut.withColumn("here", here).join(before, ["conv_id", "part"], "left")
    return numbered.withColumn("position", (F.col("here") + F.col("before")).cast("long")).drop("here", "before", "part")
