"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: ``message`` opens a turn with a role and a text, ``delta`` appends to
it, ``edit`` replaces its text and ``regenerate`` clears it for the deltas that follow. Folding a turn's
events in their sequence gives the final message; the messages of a conversation in the order of their turns
are rendered with a template whose control strings cannot occur inside texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's control strings.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Characters of a streamed delta.
DELTA_CHARS = 200


def escape(text: Column) -> Column:
    """Put one backslash more between ``<`` and ``|``, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: str) -> str:
    """What :func:`escape` was given."""
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final message of every turn.

    ``events(conv_id, turn, seq, kind, role, text)``. Only a turn's own events are gathered, sorted by seq
    and, among equals, kind, role and text. The role is that of the last message event that names one; NULL
    text counts as empty, an unknown or NULL kind as message, and deltas before any message append to the
    empty text. Turns of NULL conversations form one conversation.
    """
    step = F.struct("seq", F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    log = F.sort_array(F.collect_list(step))
    whole = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i)))  # nothing before it counts
    rest = F.slice("log", F.coalesce(whole, F.lit(0)) + 1, F.size("log"))
    text = F.array_join(F.transform(rest, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"])), "")
    named = F.filter("log", lambda e: e["role"].isNotNull() & ~e["kind"].isin("delta", "edit", "regenerate"))
    folded = events.groupBy("conv_id", "turn").agg(log.alias("log"))
    return folded.select("conv_id", "turn", F.get(named, F.size(named) - 1)["role"].alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, end>>, n_turns): each conversation in the template.

    Messages with equal turn are ordered by role and text. The loss mask holds code point positions of the
    assistant texts in ``formatted``; everything else of the template is outside. A NULL role counts as
    empty; roles are escaped like texts and may hold line breaks. A conversation is one row, as a document is.
    """
    role = F.replace(F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;"))
    body = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    pieces = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    length = F.char_length("head") + F.char_length("body") + len(CLOSE) + 1
    before = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select("conv_id", "role", F.row_number().over(order).alias("rank"), (before + F.char_length("head")).alias("start"),
                           F.char_length("body").alias("length"), F.concat("head", "body", F.lit(CLOSE + "\n")).alias("piece"))
    turns = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("rank", "role", "start", "length", "piece"))).alias("turns"))
    spoken = F.filter("turns", lambda t: t["role"] == "assistant")
    return turns.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(spoken, lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["length"]).alias("end"))).alias("loss"),
        F.size("turns").cast("long").alias("n_turns"))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE + "\n")[:-1]:
        role, _, text = part.removeprefix(OPEN).partition("\n")
        turns.append((unescape(role.replace("&#10;", "\n").replace("&amp;", "&")), unescape(text)))
    return turns


def as_events(conversations: DataFrame, chars: int = DELTA_CHARS) -> DataFrame:
    """The log that a chat service would have kept of finished ``conversations(conv_id, turn, role, text)``.

    Assistant texts were streamed: an empty message, then deltas of ``chars`` characters. Other texts are one
    message. Rows that repeat a turn stay messages of their own: ``turn`` becomes (turn, number within it).
    """
    number = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    conversations = conversations.select("conv_id", F.struct("turn", number.alias("part")).alias("turn"), "role", "text")
    text = F.coalesce("text", F.lit(""))
    streamed = F.coalesce(F.col("role") == "assistant", F.lit(False))
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(text) - 1, F.lit(0)), F.lit(chars))
    deltas = F.transform(starts, lambda s: F.struct((s + 1).alias("seq"), F.lit("delta").alias("kind"),
                                                   F.lit(None).cast("string").alias("role"), F.substring(text, s + 1, F.lit(chars)).alias("text")))
    first = F.struct(F.lit(0).alias("seq"), F.lit("message").alias("kind"), F.col("role").alias("role"),
                     F.when(streamed, "").otherwise(text).alias("text"))
    steps = F.when(streamed, F.concat(F.array(first), deltas)).otherwise(F.array(first))
    return conversations.select("conv_id", "turn", F.explode(steps).alias("e")).select("conv_id", "turn", "e.*")
