"""Chat formatting from an event log: fold deltas, edits and regenerations, then render.

Events are (conv_id, turn, seq, kind, role, text). kind 'open' starts a message, 'delta' appends,
'regenerate' discards what was streamed so far, 'edit' replaces it by its text. Events are dealt by
conversation and turn, sorted by sequence, and folded without Python: what follows the last reset
is concatenated. Messages are then dealt by conversation and rendered.

The template is <|im_start|>role\\ntext<|im_end|>\\n. In texts a backslash becomes \\0 and <| becomes
<\\1|, so no mark can occur in a text; roles are percent-escaped. Both are undone exactly.

Defined results: null text is empty, a null role is the empty role; events with a null conv_id form
one conversation; events that tie in seq are ordered by kind and text; a turn without text events
is an empty message; a conversation is as long as its messages: it is one value of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillweave.llm.shared import need, text_of

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\1|"), F.lit("<|")), F.lit("\\0"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def events_of(turns: DataFrame, piece: int = 400) -> DataFrame:
    """An event log that folds to the given rows: each is opened, then streamed in pieces.

    Every seventh turn first streams a draft that a regeneration discards; every eleventh is
    completed by an edit. Rows that share conv_id and turn get turns of their own, by role and text.
    """
    need(turns, "conv_id", "turn", "role", "text")
    w = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text")).withColumn("part", F.row_number().over(w))
    step = F.expr(f"sequence(0, greatest(char_length(text) - 1, 0), {piece})")
    pieces = F.transform(step, lambda i: F.struct(F.lit("delta").alias("kind"), F.substring(F.col("text"), i + 1, F.lit(piece)).alias("text")))
    one = lambda kind, text: F.array(F.struct(F.lit(kind).alias("kind"), text.alias("text")))
    draft = F.concat(one("delta", F.substring("text", 1, 20)), one("regenerate", F.lit("")))
    log = F.concat(
        one("open", F.lit("")),
        F.when(F.expr("turn % 7 = 3"), draft).otherwise(F.expr("array()").cast("array<struct<kind:string,text:string>>")),
        F.when(F.expr("turn % 11 = 5"), F.concat(one("delta", F.substring("text", 1, 30)), one("edit", F.col("text")))).otherwise(pieces),
    )
    spread = rows.select("conv_id", "turn", "part", "role", F.posexplode(log).alias("seq", "event"))
    return spread.select("conv_id", "turn", "part", "seq", "event.kind", "role", "event.text")


def fold(events: DataFrame) -> DataFrame:
    """One message per (conv_id, turn, part): conv_id, turn, part, role, text."""
    need(events, "conv_id", "turn", "part", "seq", "kind", "role", "text")
    logs = events.groupBy("conv_id", "turn", "part").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", text_of().alias("text")))).alias("log"),
        F.max_by("role", F.when(F.col("kind") == "open", F.col("seq"))).alias("role"),
    )
    last = F.array_max(F.transform(F.filter("log", lambda e: e["kind"].isin("edit", "regenerate")), lambda e: e["seq"]))
    live = F.filter("log", lambda e: (e["seq"] >= F.coalesce(F.col("last"), e["seq"])) & e["kind"].isin("delta", "edit"))
    return logs.withColumn("last", last).select(
        "conv_id", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask: spans (start, len) in UTF-8 bytes of the assistant's texts."""
    need(messages, "conv_id", "turn", "part", "role", "text")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    said = messages.select("conv_id", "turn", "part", "role", head.alias("head"), body.alias("body")).withColumn("whole", F.concat("head", "body", F.lit(END + "\n")))
    order = W.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(W.unboundedPreceding, -1)
    placed = said.withColumn("at", F.coalesce(F.sum(F.octet_length("whole").cast("long")).over(order), F.lit(0)))
    span = F.struct((F.col("at") + F.octet_length("head")).alias("start"), F.octet_length("body").cast("long").alias("len"))
    turns = F.struct("turn", "part", F.col("whole").alias("text"), F.when(F.col("role") == "assistant", span).alias("span"))
    lists = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turns)).alias("t"))
    return lists.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["text"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss (texts under the mask), parsed from the rendered form."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1_000_000_000)
    turn = lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring_index(F.substring(p, F.instr(p, "\n") + 1, F.length(p)), END, 1)).alias("text"),
    )
    raw = F.col("formatted").cast("binary")
    under = lambda s: unescape(F.substring(raw, s["start"].cast("int") + 1, s["len"].cast("int")).cast("string"))
    return formatted.select("conv_id", F.transform(parts, turn).alias("turns"), F.transform("loss_mask", under).alias("loss"), F.char_length("formatted").alias("chars"))
