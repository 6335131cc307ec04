"""Chat formatting: fold event logs into final conversations and render them with a loss mask.

A conversation is rebuilt from its events, sorted by sequence number:

* ``message`` sets the text of a turn;
* ``delta`` appends a streamed piece to the turn's current text;
* ``edit`` replaces a turn's text and withdraws what later turns said before it;
* ``regenerate`` starts a turn's text anew (pieces streamed afterwards make it up).

The template writes each turn as ``### role:\\n text </turn>\\n``. Inside texts and roles a
backslash is put before every control character sequence, so neither ``##`` nor
``</turn>`` can occur in an escaped text; dropping the backslashes restores it exactly.

Only DataFrame functions run here. A conversation's final string is one value, so its
turns meet in one task by definition; its events are cut down to one row per turn
first, and conversations spread over tasks by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, AFTER_ROLE, END = "### ", ":\n", "\n</turn>\n"
KINDS = ("message", "delta", "edit", "regenerate")

#: What gets a backslash: backslashes, a # after another #, the slash of </turn>.
_ESCAPED = r"\\|(?<=#)#|(?<=<)/(?=turn>)"
#: Roles also escape colon and line break.
_ESCAPED_ROLE = _ESCAPED + r"|:|\n"


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, _ESCAPED_ROLE if role else _ESCAPED, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final turns (conv_id, turn, role, text) of events (conv_id, seq, kind, turn, role, text).

    Null texts count as empty, null roles as the empty role, unknown and null kinds as
    ``message``. Events of one turn with equal seq apply in the order of (kind, role,
    text). A null turn sorts before all others.
    """
    e = events.select("conv_id", "seq", "turn", F.coalesce("role", F.lit("")).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"),
                      F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(F.lit("message")).alias("kind"))
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first())
    edit = F.when(F.col("kind") == "edit", F.col("seq"))
    # What an edit withdraws: events of later turns with a smaller sequence number.
    cut = e.groupBy("conv_id", "turn").agg(F.max(edit).alias("_edit"))
    cut = cut.withColumn("_cut", F.max("_edit").over(by_turn.rowsBetween(Window.unboundedPreceding, -1)))
    e = e.alias("e").join(cut.alias("c"), F.expr("e.conv_id <=> c.conv_id AND e.turn <=> c.turn"))
    e = e.select("e.*", "c._cut").where(F.col("_cut").isNull() | F.col("seq").isNull() | (F.col("seq") > F.col("_cut")))
    steps = e.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("s"))
    # Pieces since the last event that sets or restarts the turn.
    resets = F.filter(F.transform("s", lambda x, i: F.when(x["kind"] != "delta", i)), lambda i: i.isNotNull())
    first = F.coalesce(F.array_max(resets), F.lit(0))
    live = F.slice(F.col("s"), first + 1, F.size("s"))
    return steps.select("conv_id", "turn", F.element_at("s", -1)["role"].alias("role"),
                        F.concat_ws("", F.transform(live, lambda x: x["text"])).alias("text"))


def render(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans.

    ``turns``: conv_id, turn, role, text; rows of one turn keep the order of (role,
    text). ``loss_spans`` are (start, end) code-point offsets of the escaped texts of ``loss_role``.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("head", F.concat(F.lit(HEAD), escape(F.col("role"), role=True), F.lit(AFTER_ROLE))).withColumn(
        "body", escape(F.col("text")))
    rows = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "head", "body"))).alias("ts"))
    formatted = F.concat_ws("", F.transform("ts", lambda x: F.concat(x["head"], x["body"], F.lit(END))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["head"])
        b = a + F.length(x["body"])
        own = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + F.lit(len(END))).alias("at"),
                        F.when(x["role"] == loss_role, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return rows.select("conv_id", F.size("ts").cast("long").alias("n_turns"), formatted.alias("formatted"),
                       F.aggregate("ts", start, step)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds to rendered rows what their strings hold: turns (array of role, text) and loss_text."""
    parts = F.split(F.col("formatted"), END, -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(p: Column) -> Column:
        # An escaped role holds no colon followed by a line break.
        named = F.substr(F.substring_index(p, AFTER_ROLE, 1), F.lit(len(HEAD) + 1))
        skip = F.length(named) + F.lit(len(HEAD) + len(AFTER_ROLE) + 1)
        return F.struct(unescape(named).alias("role"), unescape(F.substr(p, skip)).alias("text"))

    spans = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", F.transform(parts, turn)).withColumn("loss_text", F.concat_ws("", spans))


def format_events(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Fold, render and read back an event log; empty logs give no rows."""
    return read_back(render(fold_events(events), loss_role))
