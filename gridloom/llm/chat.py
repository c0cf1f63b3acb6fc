"""Chat formatting: rebuild conversations from an event log, render them, and read them back. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is OPEN role CLOSE text END.
OPEN, CLOSE, END = "<|", "|>", "</s>"
#: Characters of control strings, here and in other common templates, and what stands for them inside roles and texts.
ESCAPES = (("~", "~0"), ("<", "~1"), (">", "~2"), ("[", "~3"), ("]", "~4"))
#: Kinds of event. All but deltas set the text of their turn anew; a regeneration also drops what followed the turn.
DELTA, MESSAGE, EDIT, REGENERATE = "delta", "message", "edit", "regenerate"


def escape(c: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), ESCAPES[::-1], c)


def reconstruct(events: DataFrame) -> DataFrame:
    """Folds ``conv_id, seq, turn, kind, role, text`` events into final messages ``conv_id, turn, role, text``.

    Events apply in order of ``seq`` (ties: by text). A message, edit or regeneration replaces what its turn holds, a
    delta appends. A regeneration also drops every event of later turns that came before it. Null text is empty, a null
    kind is a message, a null role or turn keeps out of the way: the role is the last one given (else empty), the null
    turn comes first. Null conversation ids form one conversation. No events, no messages. A conversation is folded in one
    task, sorted and spilled by Spark, and its rendered text is one string: a conversation is bounded by what a row holds.
    """
    e = events.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("at"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-(2**62))).alias("seq"),
        F.coalesce("kind", F.lit(MESSAGE)).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = Window.partitionBy("conv_id", "at")
    earlier = Window.partitionBy("conv_id").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    order = F.struct("seq", "text")
    e = e.withColumns(
        {
            "reset": F.max(F.when(F.col("kind") != DELTA, order)).over(turn),
            "by": F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).over(turn),
            "dropped": F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).over(earlier),
        }
    )
    live = e.filter((F.col("reset").isNull() | (order >= F.col("reset"))) & (F.col("dropped").isNull() | (F.col("seq") > F.col("dropped"))))
    parts = F.sort_array(F.collect_list(F.struct("seq", "text")))
    folded = live.groupBy("conv_id", "at").agg(parts.alias("parts"), F.max("by").alias("by"))
    return folded.select(
        "conv_id",
        F.when(F.col("at") != -(2**62), F.col("at")).alias("turn"),
        F.coalesce("by.role", F.lit("")).alias("role"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row a conversation: ``conv_id, formatted, loss_mask``; the mask lists [start, end) in code points of the
    escaped texts of the role that is learned from, in order. Turns are taken in order of turn (null first), role, text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    m = messages.select("conv_id", F.row_number().over(order).alias("i"), escape(F.coalesce("role", F.lit(""))).alias("r"), escape(F.coalesce("text", F.lit(""))).alias("t"))
    m = m.withColumn("piece", F.concat(F.lit(OPEN), "r", F.lit(CLOSE), "t", F.lit(END)))
    end = F.sum(F.length("piece")).over(Window.partitionBy("conv_id").orderBy("i")) - len(END)
    span = F.when(F.col("r") == learn_from, F.struct((end - F.length("t")).alias("start"), end.alias("end")))
    got = m.withColumn("span", span).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", "piece", "span"))).alias("p"))
    spans = F.transform("p", lambda x: x["span"])
    return got.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), F.filter(spans, lambda s: s.isNotNull()).alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of ``role, text``, unescaped."""
    pieces = F.split(formatted, END)
    at = lambda p: F.locate(CLOSE, p)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        turns,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(len(OPEN) + 1), at(p) - len(OPEN) - 1)).alias("role"),
            unescape(F.substr(p, at(p) + len(CLOSE))).alias("text"),
        ),
    )


def events_of(rows: DataFrame) -> DataFrame:
    """Each row of ``conv_id, turn, role, text`` as the message event of a turn of its own, in order of turn, role, text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("turn"), F.lit(0).alias("seq"), F.lit(MESSAGE).alias("kind"), "role", "text")
