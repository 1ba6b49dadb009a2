"""Chat formatting from an event log, with a reversible template and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
RESETS = ("message", "edit", "regenerate")  # these begin a new version of their turn
CUTS = ("edit", "regenerate")  # these also drop later turns that were written before


def escape(text: Column) -> Column:
    """Put one more ``!`` into every ``<|``, ``<!|``, ``<!!|`` and so on; no ``<|`` is left."""
    return F.regexp_replace(text, r"<(!*)\|", r"<!$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<!(!*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    """A role fits on the template's first line: ``~`` and line ends are written as ~0 and ~1."""
    return escape(F.replace(F.replace(role, F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))


def fold(events: DataFrame, conv: str = "conv_id", seq: str = "seq") -> DataFrame:
    """Final messages (conv, turn, role, text) of a log (conv, seq, event, turn, role, text).

    ``message``, ``edit`` and ``regenerate`` begin a turn's text anew, a ``delta`` adds to it. An edit or a
    regeneration also drops later turns that were begun before it. The role is that of the last beginning. Events are
    taken by ``seq``, ties by event, role and text. Deltas without a beginning form a turn by themselves, with the first role. Null
    texts are empty. Turns are folded by conversation and turn, so one long conversation spreads over its turns.
    """
    body = F.struct(F.col(seq).alias("seq"), F.col("event"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = events.select(F.col(conv).alias("conv"), F.col("turn"), body.alias("e"))
    turn = Window.partitionBy("conv", "turn")
    begun = F.max(F.when(F.col("e.event").isin(*RESETS), F.col("e"))).over(turn)
    rows = rows.withColumn("begun", begun).where(F.col("begun").isNull() | (F.col("e") >= F.col("begun")))
    turns = rows.groupBy("conv", "turn").agg(
        F.array_sort(F.collect_list("e")).alias("all"),
        F.max(F.when(F.col("e.event").isin(*CUTS), F.col("e.seq"))).alias("cut"),
        F.first("begun").alias("begun"),
    )
    first = F.coalesce("begun.seq", F.col("all")[0]["seq"])
    text = F.array_join(F.transform("all", lambda e: e["text"]), "")
    turns = turns.select("conv", "turn", "cut", first.alias("first"), F.coalesce("begun.role", F.col("all")[0]["role"]).alias("role"), text.alias("text"))
    before = Window.partitionBy("conv").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("limit", F.max("cut").over(before)).where("limit is null or first > limit")
    return turns.select(F.col("conv").alias(conv), "turn", "role", "text")


def render(messages: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Rows (conv, formatted, mask): the text of each conversation and where the model learns from it.

    ``mask`` is an array of (turn, start, end): place of the message, code points of the text, end exclusive. It covers
    the bodies of assistant messages. Messages are taken by turn, ties by role and text; null roles and texts are empty.
    """
    rows = messages.select(
        F.col(conv).alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"))
    rows = rows.select("conv", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
    whole = F.length("head") + F.length("body") + len(END) + 1
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.select(
        "conv", (F.row_number().over(order) - 1).alias("n"), "role", F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        (F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - len(END) - 1).alias("end"), F.length("body").alias("size"))
    span = F.struct(F.col("n").alias("turn"), (F.col("end") - F.col("size")).alias("start"), F.col("end"))
    done = rows.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == LEARNED, span))).alias("mask"))
    return done.select(F.col("conv").alias(conv), F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "mask")


def parse(formatted: Column) -> Column:
    """Messages (role, text, head: code points before the body in its part, part) read back from a formatted text."""
    parts = F.filter(F.split(formatted, START.replace("|", r"\|"), -1), lambda p: p != "")

    def message(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        head = F.length(role) + 1
        body = F.substring(p, head + 1, F.length(p) - head - len(END) - 1)
        return F.struct(_role_in(role).alias("role"), unescape(body).alias("text"), head.alias("head"), p.alias("part"))

    return F.transform(parts, message)


def learned(messages: Column, mask: Column) -> Column:
    """The texts under the mask, read from the parts that ``parse`` gives, unescaped."""
    def one(s: Column) -> Column:
        m = messages[s["turn"]]
        return unescape(F.substring(m["part"], m["head"] + 1, (s["end"] - s["start"]).cast("int")))

    return F.transform(mask, one)
