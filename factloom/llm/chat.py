"""Chat formatting by event-sourced reconstruction, DataFrame functions only.

A log holds events (conversation, sequence number, kind, message, role, text): ``message`` opens a message, ``delta``
appends to it, ``edit`` and ``regenerate`` replace what it holds so far. Per message, in sequence order, the last event
that resets it and the deltas after it are its final text; messages stand in the order of their first events.

The template marks a turn as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. In roles and texts a backslash is
doubled and one is put behind the first character of every control string (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``), so no text can open or close a turn; a newline in a role is written as backslash, n. ``parse`` undoes it.

Nulls: a null text or role is empty; a null conversation id is one conversation; events of no known kind count as
``message``; null sequence numbers come first; at one number a delta stands behind whatever resets its message, other ties
go by role and text. Repeated message rows are turns of their own. A text of any length is one value; a conversation's
text is one value of the result, so it is one row in memory; deltas are joined per message first. Other columns are not
read. An empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = r"(<)(?=\||/?s>)|(\[)(?=/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")), CONTROLS, r"$0\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def fold(events: DataFrame, conv: str = "conv_id", seq: str = "seq", kind: str = "kind", message: str = "message", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn_order, role, text): the final messages of each log."""
    e = events.select(F.col(conv).alias("conv_id"), F.col(seq).alias("seq"), F.col(message).alias("message"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), (F.coalesce(F.col(kind), F.lit("message")) == "delta").alias("delta"))
    # Per message: the last reset, then the deltas behind it. Both are aggregates that combine before the shuffle.
    order = F.struct("seq", (F.col("delta")).alias("d"), F.col("role").alias("r"), F.col("text").alias("t"))
    m = e.groupBy("conv_id", "message").agg(F.min("seq").alias("turn_order"), F.max(F.when(~F.col("delta"), order)).alias("reset"), F.min_by("role", order).alias("first_role"), F.array_sort(F.collect_list(F.when(F.col("delta"), order))).alias("deltas"))
    # At one sequence number deltas stand behind the reset; a null number stands before all others.
    behind = lambda x: F.when(F.col("reset.seq").isNull(), F.lit(True)).when(x.seq.isNull(), F.lit(False)).otherwise(x.seq >= F.col("reset.seq"))
    later = F.filter("deltas", lambda x: F.col("reset").isNull() | behind(x))
    body = F.concat(F.coalesce(F.col("reset.t"), F.lit("")), F.array_join(F.transform(later, lambda x: x.t), ""))
    return m.select("conv_id", "turn_order", "message", F.coalesce("reset.r", "first_role").alias("role"), body.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): one row per conversation; mask holds (start, end) of assistant texts in code points."""
    piece = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE + "\n"))
    head = F.length(F.lit(OPEN)) + F.length(F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))) + 1
    turns = messages.select("conv_id", "turn_order", "message", piece.alias("piece"), F.length(piece).cast("long").alias("size"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("loss"), head.cast("long").alias("head"), F.length(escape(F.col("text"))).cast("long").alias("body"))
    w = Window.partitionBy("conv_id").orderBy("turn_order", "message").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum("size").over(w), F.lit(0).cast("long")))
    span = F.struct((F.col("at") + F.col("head")).alias("start"), (F.col("at") + F.col("head") + F.col("body")).alias("end"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("turns"), F.array_sort(F.collect_list(F.when(F.col("loss"), span))).alias("mask"))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t.piece), "").alias("formatted"), "mask")


def parse(formatted: Column) -> Column:
    """Turns (role, text) read back from a rendered conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    role = lambda p: F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)
    return F.transform(parts, lambda p: F.struct(unescape(_newlines(role(p))).alias("role"), unescape(F.substr(p, F.lit(len(OPEN)) + F.length(role(p)) + 2)).alias("text")))


def _newlines(role: Column) -> Column:
    # A backslash and n is a newline unless that backslash is itself doubled.
    return F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")


def masked(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(formatted, (m.start + 1).cast("int"), (m.end - m.start).cast("int")))), "")


def numbered(rows: DataFrame) -> DataFrame:
    """A table of turns as a log: every row opens a message of its own."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.row_number().over(w).alias("message"), "role", "text")
