"""Chat formatting: every assistant turn becomes an example whose only trainable part is that reply.

A turn is written as ``### <role>: <text> </turn>`` and a line end. Inside roles and texts a
backslash, ``#``, ``<`` and, in roles, ``:`` are escaped by a backslash and a letter, so no
control string can come from a text, and what was written can be read back.

An example is the conversation up to its reply. It holds its whole context by definition, so a
conversation has to fit into a row; the examples of one are cut from one formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
ASSISTANT = "assistant"
_TEXT = {"#": r"\h", "<": r"\l"}
_ROLE = {**_TEXT, ":": r"\c"}


def escaped(text: Column, signs: dict[str, str]) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for sign, code in signs.items():
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column, signs: dict[str, str]) -> Column:
    """The text that ``escaped`` was given: what stands between escaped backslashes, with its signs."""

    def part(value: Column) -> Column:
        for sign, code in signs.items():
            value = F.replace(value, F.lit(code), F.lit(sign))
        return value

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): conv_id, text and examples.

    ``examples`` is an array with an element for each turn of role assistant, in order: its
    number among the turns (from 0), the end of the example's text, and the begin and end of
    the reply in it, in characters. Turns go by turn, equal ones by role and text; repeated
    rows are turns of their own; a null turn comes first. A null role or text is empty. Rows
    without conv_id are one conversation. Very long texts are whole. An empty table gives no
    rows; other columns are left out. The work grows with the turns, not with their square.
    """
    empty = F.lit("")
    rows = turns.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    role, text = escaped(F.col("role"), _ROLE), escaped(F.col("text"), _TEXT)
    # Where a turn ends is a running sum over rows, so no array is gone through for every turn.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = F.concat(F.lit(HEAD), role, F.lit(MIDDLE), text, F.lit(TAIL))
    rows = rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("place"),
        (F.col("role") == ASSISTANT).alias("reply"),
        whole.alias("whole"),
        F.length(text).alias("size"),
        F.sum(F.length(whole)).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("end"),
    )
    close = F.col("end") - len(TAIL)
    example = F.struct(
        F.col("place").alias("turn"), "end", (close - F.col("size")).alias("loss_start"), close.alias("loss_end")
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "whole"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("reply"), example))).alias("examples"),
    )
    return grouped.select("conv_id", F.array_join("pieces.whole", "").alias("text"), "examples")


def expanded(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), target_turn, text, loss_start and loss_end.

    Only the characters from loss_start up to loss_end are trainable: that reply. All turns
    before it are context. A conversation without an assistant has no example.
    """
    # From a plain posexplode the optimizer would infer a filter, which goes below and has the array made twice.
    rows = conversations.select("conv_id", "text", F.posexplode_outer("examples").alias("example", "e"))
    return rows.select(
        "conv_id", "example", F.col("e.turn").alias("target_turn"), F.substring("text", F.lit(1), F.col("e.end")).alias("text"), "e.loss_start", "e.loss_end"
    ).filter(F.col("example").isNotNull())


def read_turns(text: Column) -> Column:
    """Array of (role, text) that a formatted conversation, or an example, was made of."""
    parts = F.filter(F.split(text, TAIL, -1), lambda p: F.startswith(p, F.lit(HEAD)))

    def turn(p: Column) -> Column:
        at = F.locate(MIDDLE, p)
        role = F.substring(p, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)
        return F.struct(
            unescaped(role, _ROLE).alias("role"), unescaped(F.substring(p, at + len(MIDDLE), F.length(p)), _TEXT).alias("text")
        )

    return F.transform(parts, turn)


def read_reply(example: DataFrame) -> Column:
    """The trainable text of an example's row."""
    size = example["loss_end"] - example["loss_start"]
    return unescaped(F.substring(example["text"], example["loss_start"] + 1, size), _TEXT)


def read_back(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations and their examples say: conv_id, turns, replies and formatted_chars.

    A conversation without an example has null replies. Each conversation is gone through once.
    """
    rows = conversations.select("conv_id", "text", F.posexplode_outer("examples").alias("example", "e"))
    first = F.coalesce("example", F.lit(0)) == 0
    example = rows.select(
        "conv_id",
        "example",
        F.substring("text", F.lit(1), F.col("e.end")).alias("text"),
        "e.loss_start",
        "e.loss_end",
        F.when(first, read_turns(F.col("text"))).alias("turns"),
        F.when(first, F.length("text")).cast("long").alias("chars"),
    )
    reply = F.when(F.col("example").isNotNull(), F.struct("example", read_reply(example).alias("text")))
    found = example.groupBy("conv_id").agg(
        F.first("turns", ignorenulls=True).alias("turns"),
        F.array_sort(F.collect_list(reply)).alias("replies"),
        F.max("chars").alias("formatted_chars"),
    )
    replies = F.when(F.size("replies") > 0, F.col("replies.text"))
    return found.select("conv_id", "turns", replies.alias("replies"), "formatted_chars")
