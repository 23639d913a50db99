"""Operator 9: chat formatting with Spark expressions alone.

The turns of a conversation are collected as structs, sorted, and cut where the role changes into
blocks of adjacent same-role turns; blocks become text segments, and the formatted string is their
concatenation. A segment is marked ``loss`` when it is an assistant's text.

    <s> ROLE [INST] TEXT [/INST] TEXT </s>      (one block; [/INST] parts merged turns)

A control string inside a role or text gets an odd number of backslashes before it (k become
2k + 1), while a real mark always follows a space or the end of a block, so the format can be read
back exactly.

Defined results: null text and null role read as empty; turns sort by turn, then role, then text,
nulls first; repeated rows stay repeated turns; null conversation ids form one conversation; an
empty table gives no rows. One conversation is one output row, so it must fit in a row; nothing
larger is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, NEXT, CLOSE = "<s> ", " [INST] ", " [/INST] ", " </s>"
CONTROL = "(</?s>|\\[/?INST\\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "(?<!\\\\)(\\\\*+)" + CONTROL, "$1$1\\\\$2")


def unescape(text: Column) -> Column:
    """Of 2k + 1 backslashes before a control string k are left."""
    return F.regexp_replace(text, "(?<!\\\\)(\\\\*)\\1\\\\" + CONTROL, "$1$2")


def sorted_turns(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    empty = F.lit("")
    return (turns.select(conv.alias("conv_id"), F.struct(
        turn.alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def format_chats(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """(conv_id, formatted, segments): ``segments`` is array of (text, loss); their texts joined are
    ``formatted``, and the loss mask covers the segments marked so."""
    held = sorted_turns(turns, conv, turn, role, text)
    role_at = lambda i: F.get("turns", i)["role"]
    starts = F.filter(F.sequence(F.lit(0), F.size("turns") - 1),
                      lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    held = held.withColumn("starts", starts)
    end = lambda j: F.coalesce(F.get("starts", j + 1), F.size("turns"))
    blocks = F.transform("starts", lambda s, j: F.struct(
        role_at(s).alias("role"),
        F.transform(F.slice("turns", s + 1, end(j) - s), lambda t: escape(t["text"])).alias("texts")))
    held = held.withColumn("blocks", blocks)
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def segments(b: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(b["role"]), F.lit(HEAD))
        body = F.flatten(F.transform(b["texts"], lambda x, i: F.array(
            part(F.when(i == 0, head).otherwise(F.lit(NEXT)), F.lit(False)), part(x, b["role"] == LOSS_ROLE))))
        return F.concat(body, F.array(part(F.lit(CLOSE), F.lit(False))))

    held = held.select("conv_id", F.flatten(F.transform("blocks", segments)).alias("segments"))
    return held.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array of (role, text) from the formatted string alone."""
    quoted = lambda mark: mark.replace("[", "\\[").replace("]", "\\]")
    blocks = F.split(formatted, CLOSE)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)          # nothing follows the last mark

    def turns(b: Column) -> Column:
        halves = F.split(F.substr(b, F.lit(len(OPEN) + 1)), quoted(HEAD))
        return F.transform(F.split(halves[1], quoted(NEXT)),
                           lambda x: F.struct(unescape(halves[0]).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
