"""Chat formatting: conversations rebuilt from an event log, then rendered.

Events (conv_id, seq, op, msg, role, text) are folded message by message:
``message`` opens a message (or sets it anew), ``delta`` appends, ``edit``
replaces, ``delete`` empties and removes, ``regenerate`` empties the message and
voids every message opened between it and the regeneration. The fold works on
blocks of events, so that neither a hot conversation nor a hot message goes
through one task whole. DataFrame and SQL operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleeper.llm.common import keep

#: Events or messages of one conversation that are handled in one piece.
BLOCK = 4096
START, END = "<|im_start|>", "<|im_end|>"
# A message ends with END and a line feed; its role ends with the first line feed.
TAIL = END + "\n"
_NEWLINE = "␤"


def escape(c: F.Column) -> F.Column:
    """A text in which no control string can begin: ``\\`` doubled, ``<|`` as ``<\\|``."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: F.Column) -> F.Column:
    """The text that :func:`escape` was given: an escaped character stands for itself."""
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def escape_role(c: F.Column) -> F.Column:
    """As :func:`escape`, and a line feed as ``\\`` and a sign of its own: a role is one line."""
    return F.replace(escape(c), F.lit("\n"), F.lit("\\" + _NEWLINE))


def unescape_role(c: F.Column) -> F.Column:
    newline = F.regexp_replace(c, rf"\G((?:[^\\]++|\\[^{_NEWLINE}])*+)\\{_NEWLINE}", "$1\n")
    return F.regexp_replace(newline, r"(?s)\\(.)", "$1")


def events_of(rows: DataFrame) -> DataFrame:
    """A finished log (conv_id, turn, role, text) as events: each row opens a message of its own.

    A null turn comes before all others; rows of the same turn follow role and a hash of the text.
    """
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2 ** 62))).alias("seq"), F.lit("message").alias("op"),
        F.monotonically_increasing_id().cast("string").alias("msg"), F.col("role"), F.col("text"))


def fold(events: DataFrame) -> DataFrame:
    """The final messages: (conv_id, pos, msg, role, text), ``pos`` being the event that opened each.

    Null op counts as ``message``, null text as empty, null seq as before all others;
    events without a message id are dropped, as are deltas, edits and the like for a
    message that no event opens. Of events with the same seq for one message, ``op``
    and then ``text`` decide the order, and equal events (a redelivery) count once.
    A conversation whose id is null is a conversation like any other. Very long texts and
    long runs of deltas are joined whole, message by message.
    """
    e = events.where(F.col("msg").isNotNull()).select(
        "conv_id", F.col("msg").cast("string").alias("msg"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-(2 ** 62))).alias("seq"),
        F.coalesce("op", F.lit("message")).alias("op"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    step = F.struct("seq", "op", "text", "role")
    opened = F.col("op") == "message"

    # each block of a message's events: what it adds, and whether it forgets what came before
    def add(acc, x):
        fresh = x["op"] != "delta"
        return F.struct(
            (acc["fresh"] | fresh).alias("fresh"),
            F.when(x["op"].isin("delete", "regenerate"), F.lit("")).when(fresh, x["text"])
            .otherwise(F.concat(acc["text"], x["text"])).alias("text"),
            F.when(fresh, x["op"] == "delete").otherwise(acc["gone"]).alias("gone"))

    start = F.struct(F.lit(False).alias("fresh"), F.lit("").alias("text"), F.lit(False).alias("gone"))
    blocks = e.groupBy("conv_id", "msg", F.floor(F.col("seq") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_set(step)).alias("steps"),
        F.min(F.when(opened, F.struct("seq", "role"))).alias("first"),
        F.max(F.when(F.col("op") == "regenerate", F.col("seq"))).alias("again"))
    blocks = blocks.select("conv_id", "msg", "block", "first", "again",
                           F.aggregate("steps", start, add).alias("part"))

    def join(acc, x):
        return F.struct(
            (acc["fresh"] | x["part"]["fresh"]).alias("fresh"),
            F.when(x["part"]["fresh"], x["part"]["text"])
            .otherwise(F.concat(acc["text"], x["part"]["text"])).alias("text"),
            F.when(x["part"]["fresh"], x["part"]["gone"]).otherwise(acc["gone"]).alias("gone"))

    messages = blocks.groupBy("conv_id", "msg").agg(
        F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"),
        F.min("first").alias("first"), F.max("again").alias("again")).where(F.col("first").isNotNull())
    messages = messages.select(
        "conv_id", "msg", F.col("first.seq").alias("pos"), F.col("first.role").alias("role"), "again",
        F.aggregate("parts", start, join).alias("m"))
    messages = messages.select("conv_id", "msg", "pos", "role", "again", F.col("m.text").alias("text"),
                               F.col("m.gone").alias("gone"))
    messages = keep(messages, "messages")
    # a message is void if one before it was regenerated after it was opened
    last = running(messages, "again", F.max)
    return beside(messages, last).where(
        ~F.col("gone") & (F.col("before").isNull() | (F.col("before") <= F.col("pos")))
    ).select("conv_id", "pos", "msg", "role", "text")


def beside(messages: DataFrame, last: DataFrame) -> DataFrame:
    """``messages`` with what :func:`running` found for each."""
    last = last.select(F.col("conv_id").alias("_c"), F.col("msg").alias("_m"), "before")
    return messages.join(last, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("msg") == F.col("_m"))).drop("_c", "_m")


def running(messages: DataFrame, value: str, agg) -> DataFrame:
    """(conv_id, msg, before): ``agg`` of ``value`` over the earlier messages of each conversation.

    In two levels: inside blocks of the order, and over one row per block.
    """
    order = [F.col("pos"), F.col("role"), F.xxhash64("text"), F.col("msg")]
    m = messages.select("conv_id", "msg", "pos", "role", "text", value,
                        F.floor(F.col("pos") / BLOCK).alias("block"))
    inner = Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = m.groupBy("conv_id", "block").agg(agg(value).alias("v")).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), agg("v").over(outer).alias("carry"))
    own = m.select("conv_id", "block", "msg", agg(value).over(inner).alias("own"))
    both = own.join(carried, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    whole = F.greatest("own", "carry") if agg is F.max else F.coalesce("own", F.lit(0)) + F.coalesce("carry", F.lit(0))
    return both.select("conv_id", "msg", whole.alias("before"))


def render(messages: DataFrame) -> DataFrame:
    """One row per message in the order of the conversation: its formatted text, where that
    starts in the conversation's, and the loss mask inside it (code points from, length;
    length 0 unless an assistant speaks)."""
    lines = messages.select(
        "conv_id", "pos", "msg", "role", "text",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"))
    lines = lines.select(
        "conv_id", "pos", "msg", "role", "text", F.concat("head", "body", F.lit(TAIL)).alias("formatted"),
        F.length("head").cast("long").alias("loss_from"),
        F.when(F.col("role") == "assistant", F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        (F.length("head") + F.length("body") + F.lit(len(TAIL))).cast("long").alias("chars"))
    lines = keep(lines, "chat_lines")
    place = running(lines, "chars", F.sum)
    return beside(lines, place).select(
        "conv_id", "pos", "msg", F.col("before").cast("long").alias("start"),
        "formatted", "loss_from", "loss_chars")


def parse(rendered: DataFrame) -> DataFrame:
    """Back from the formatted messages: role, text, and the text under the loss mask."""
    whole = F.col("formatted")
    inner = F.expr(f"substring(formatted, {len(START) + 1}, length(formatted) - {len(START) + len(TAIL)})")
    cut = F.expr("instr(inner, '\n')")
    return rendered.withColumn("inner", inner).withColumn("cut", cut).select(
        "conv_id", "start", F.length(whole).cast("long").alias("chars"),
        unescape_role(F.expr("substring(inner, 1, cut - 1)")).alias("role"),
        unescape(F.expr("substring(inner, cut + 1)")).alias("text"),
        unescape(F.expr("substring(formatted, cast(loss_from + 1 as int), cast(loss_chars as int))")).alias("loss"))


def write(messages: DataFrame, name: str = "chat") -> DataFrame:
    """Render ``messages``, write them by conversation and place, and read the files back.

    A conversation may go over several files; no message does.
    """
    return keep(render(messages).repartitionByRange("conv_id", "start").sortWithinPartitions("conv_id", "start"), name)
