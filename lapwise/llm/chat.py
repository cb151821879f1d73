"""Chat formatting from event logs: fold streamed deltas, edits and regenerations into messages, then render.

All of it is DataFrame expressions. Events are folded per message before messages are gathered per conversation,
so that only final texts are brought together; a conversation is one row of the result and has to fit in one.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per message, joined by line breaks. Control strings inside
roles and texts are broken up by a backslash after their first character, and backslashes are doubled, which
``unescape`` undoes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

#: Marks of this template and of others that a tokenizer might act on.
CONTROL = (
    START, SEPARATOR, END,
    "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)

#: What an event does to its message: add text, put text in place of all before, or start the answer anew.
DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, doubled)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_events(rows: DataFrame) -> DataFrame:
    """The event log of finished rows (conv_id, turn, role, text): how each of them, a message, came to be.

    By the hash of the row, a message is streamed as two deltas; or the whole text and a false start are thrown away
    by a regeneration, whose text a delta completes; or a first half is replaced by an edit. Equal rows are messages
    of their own. ``seq`` is the turn and the number of the event.
    """
    half = F.expr("CAST(char_length(text) / 2 AS INT)")
    first, second = F.expr("left(text, half)"), F.expr("substring(text, half + 1)")
    events = lambda *steps: F.array(*[F.struct(F.lit(kind).alias("kind"), text.alias("text")) for kind, text in steps])
    streamed = events((DELTA, first), (DELTA, second))
    regenerated = events((DELTA, F.col("text")), (DELTA, first), (REGENERATE, first), (DELTA, second))
    edited = events((DELTA, first), (EDIT, F.col("text")))
    course = F.pmod(F.xxhash64("conv_id", "turn", "role", "text"), F.lit(3))
    steps = F.when(course == 0, streamed).when(course == 1, regenerated).otherwise(edited)
    numbered = rows.select("conv_id", "turn", "role", "text", half.alias("half"), F.monotonically_increasing_id().alias("message"))
    exploded = numbered.select("conv_id", "turn", "role", "message", F.posexplode(steps).alias("step", "event"))
    return exploded.select("conv_id", "message", F.struct("turn", "step").alias("seq"), "event.kind", "role", "event.text")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text, seq) of a log (conv_id, message, seq, kind, role, text).

    Within a message, events apply by ``seq``: ``delta`` adds its text, ``edit`` replaces all before it,
    ``regenerate`` drops all before it and starts with its own text; other kinds count as deltas. The role is the
    one named first. A null text adds nothing, a null role is empty. Events that tie on ``seq`` apply by kind, role
    and text. Rows without conversation or message form one of their own, under null. ``seq`` of the result is the
    message's first.
    """
    message = Window.partitionBy("conv_id", "message")
    resets = F.col("kind").isin(EDIT, REGENERATE)
    at = F.struct("seq", "kind", "role", "text")
    kept = (
        events.select("conv_id", "message", "seq", F.coalesce("kind", F.lit(DELTA)).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("reset", F.max(F.when(resets, at)).over(message))
        .withColumn("text", F.when(F.col("reset").isNull() | (at >= F.col("reset")), F.col("text")))
    )
    return (
        kept.groupBy("conv_id", "message")
        .agg(
            F.min("seq").alias("seq"),
            F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).getField("role").alias("role"),
            F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("seq", "kind", "role", "text")))).alias("parts"),
        )
        .select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.array_join("parts.text", "").alias("text"), "seq")
    )


def render(messages: DataFrame, learned_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``formatted`` and its loss mask, from messages (conv_id, message, role, text, seq).

    Messages stand in order of seq, then role, text and message. ``loss`` has one entry per message, in order: ``start`` and
    ``length`` in characters of the part to learn from, counted from the message's start mark, or 0 and 0.
    """
    body = F.struct(
        "seq",
        F.col("role").alias("by_role"),
        F.col("text").alias("by_text"),
        "message",
        F.col("role").isin(*learned_roles).alias("learn"),
    )
    gathered = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(body)).alias("m"))
    opening = lambda m: F.concat(F.lit(START), escape(m.by_role), F.lit(SEPARATOR))
    turn = lambda m: F.concat(opening(m), escape(m.by_text), F.lit(END))
    zero = F.lit(0).cast("int")
    span = lambda m: F.struct(
        F.when(m.learn, F.char_length(opening(m))).otherwise(zero).alias("start"),
        F.when(m.learn, F.char_length(escape(m.by_text))).otherwise(zero).alias("length"),
    )
    return gathered.select("conv_id", F.array_join(F.transform("m", turn), "\n").alias("formatted"), F.transform("m", span).alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role and text) and ``learned`` (texts under the loss mask) read from ``formatted``."""
    # A start mark can not occur inside a message, so each piece is one message without its start mark.
    pieces = F.filter(F.split("formatted", _literal(START), -1), lambda p, i: i > 0)
    marked = rendered.withColumn("_pieces", pieces)

    def turn(piece):
        role = F.substring_index(piece, SEPARATOR, 1)
        text = F.substring_index(F.substring_index(piece, SEPARATOR, -1), END, 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    def under_mask(piece, span):
        # ``substr`` counts from 1, and the piece lacks the start mark.
        return F.when(span["length"] > 0, unescape(piece.substr(span["start"] - len(START) + 1, span["length"]))).otherwise("")

    return marked.select(
        *rendered.columns,
        F.transform("_pieces", turn).alias("turns"),
        F.array_join(F.zip_with("_pieces", "loss", under_mask), "").alias("learned"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, turns, learned) per conversation of an event log; see ``fold_messages``.

    An empty log gives an empty result, and columns beyond those named are ignored.
    """
    return read_back(render(fold_messages(events)))


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c != "_" else c for c in text)
