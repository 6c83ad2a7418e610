"""Chat formatting by event-sourced reconstruction.  DataFrame functions only.

A log holds events (conv_id, seq, message, kind, role, text).  It is partitioned by
conversation, sorted by sequence and folded:

- ``open`` starts a message, ``delta`` adds its text to the message's end;
- ``edit`` puts its text in the place of what the message held so far;
- ``regenerate`` starts the message over with its text (often none, and deltas follow);
  messages opened between the message and this event answered what is gone, and go.

Events of a message are folded first, in many tasks, then messages of a conversation,
which ends as one row.  Final messages are rendered as

    <turn ROLE>\nTEXT\n</turn>\n

In texts a backslash stands before each backslash and before ``<turn`` and ``</turn``;
in roles before ``<``, ``>`` and line breaks too.  So neither holds a control string,
and dropping the backslashes gives them back.  The loss mask is a list of spans of code
points that cover the assistant's (escaped) texts.

Edges: a null text is empty and a null role is the empty role; null ids, sequences and
messages are values like others, first in order; an unknown kind counts as ``delta``;
events that agree in all columns are one event told twice; events of one sequence number
are taken in order open, edit, regenerate, delta, then by text; a message without an
``open`` opens with its first event; columns of other names are ignored; an empty log
gives no rows.  A conversation has to fit a row, as its rendering does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("open", "edit", "regenerate", "delta")
HEAD, HEAD_END, TAIL = "<turn ", ">\n", "\n</turn>\n"
#: A finished text is written to a log in deltas of so many code points.
PIECE = 1_000


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<turn"), F.lit("\\<turn")), F.lit("</turn"), F.lit("\\</turn"))


def escaped_role(role: Column) -> Column:
    for mark in ("\\", "<", ">", "\n"):
        role = F.replace(role, F.lit(mark), F.lit("\\" + mark))
    return role


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def as_log(rows: DataFrame) -> DataFrame:
    """The events of finished messages (conv_id, turn, role, text): each one opened, then streamed.

    Rows of one turn are messages of their own, in order of role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    numbered = rows.select("conv_id", "role", pieces.alias("pieces"), F.row_number().over(order).cast("long").alias("message"))
    events = F.concat(F.array(F.lit("")), "pieces")
    return numbered.select("conv_id", "message", "role", F.posexplode(events).alias("at", "text")).select(
        "conv_id",
        F.struct("message", F.col("at").cast("long").alias("at")).alias("seq"),
        "message",
        F.when(F.col("at") == 0, "open").otherwise("delta").alias("kind"),
        "role",
        "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, seq (of its first event), role, text of the messages that are left at the end of the log."""
    kind = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.coalesce("kind", F.lit("delta"))), F.lit(0))
    kind = F.when(kind == 0, len(KINDS)).otherwise(kind).cast("int")
    told = F.struct("seq", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role")
    grouped = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_set(told)).alias("e"))
    start = F.greatest(F.lit(1), F.array_max(F.transform("e", lambda e, i: F.when(e["kind"] < len(KINDS), i + 1))))
    regenerated = F.array_max(F.transform(F.filter("e", lambda e: e["kind"] == KINDS.index("regenerate") + 1), lambda e: F.struct(e["seq"])))
    roles = F.filter(F.transform("e", lambda e: e["role"]), lambda r: r.isNotNull())
    messages = grouped.select(
        "conv_id",
        "message",
        F.col("e")[0]["seq"].alias("seq"),
        F.coalesce(F.try_element_at(roles, F.lit(1)), F.lit("")).alias("role"),
        F.array_join(F.transform(F.slice("e", start, F.size("e")), lambda e: e["text"]), "").alias("text"),
        regenerated.alias("regenerated"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("seq", "message").rowsBetween(Window.unboundedPreceding, -1)
    gone = F.max("regenerated").over(earlier) > F.struct("seq")
    return messages.withColumn("gone", F.coalesce(gone, F.lit(False))).where(~F.col("gone")).drop("gone", "regenerated")


def render(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss (array of start and end in code points): one row per conversation."""
    head = F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit(HEAD_END))
    order = Window.partitionBy("conv_id").orderBy("seq", "message")
    size = F.char_length("head") + F.char_length("body") + len(TAIL)
    parts = messages.select("conv_id", "seq", "message", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    placed = parts.withColumns({"place": F.row_number().over(order), "end": F.sum(size.cast("long")).over(order) - len(TAIL)})
    span = F.when(F.col("role") == learned, F.struct((F.col("end") - F.char_length("body")).alias("start"), "end"))
    part = F.struct("place", F.concat("head", "body", F.lit(TAIL)).alias("text"), span.alias("span"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (array of role and text), learned (texts under the mask, in order), from the rendering alone."""
    pieces = F.split("formatted", TAIL, -1)
    head = lambda p: F.substring_index(p, HEAD_END, 1)
    turn = lambda p: F.struct(
        unescaped(F.substr(head(p), F.lit(len(HEAD) + 1))).alias("role"),
        unescaped(F.substr(p, F.char_length(head(p)) + len(HEAD_END) + 1)).alias("text"),
    )
    # Four bytes a code point, so that a span is found without counting from the text's start.
    wide = rendered.withColumns({"pieces": pieces, "wide": F.encode("formatted", "UTF-32")})
    under = F.transform("loss", lambda s: unescaped(F.decode(F.substr("wide", (4 * s["start"] + 1).cast("int"), (4 * (s["end"] - s["start"])).cast("int")), "UTF-32")))
    return wide.select("conv_id", "formatted", F.transform(F.slice("pieces", 1, F.size("pieces") - 1), turn).alias("turns"), under.alias("learned"))
