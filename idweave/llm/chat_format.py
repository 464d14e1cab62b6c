"""Conversations as training windows of bounded length.

Method: budgeted windows. Prefix sums of turn tokens put each turn into the span of its position; a
window is the system turn, a limited history repeated from before, and the turns of one span. Only
assistant texts are targets, and those that are repeated are masked.

Layout of a turn: ``### role: text </turn>\\n``. Inside roles and texts ``\\`` becomes ``\\\\``,
``###`` becomes ``\\s`` and ``</turn>`` becomes ``\\e`` (in roles also ``:`` becomes ``\\c``), which
can be undone.

Sums are made in two steps, first over runs of ``RUN`` turn numbers, so that a conversation with a third
of all rows is no single group: what is gathered is one window at a time. A window holds no more tokens
than ``budget``, except where a turn alone has more: turns are never cut.

Null text and null role count as empty, null turns come first, ties are put in order by role and text, repeated
rows are repeated turns. Rows of the null conversation are one conversation. An empty table gives no window. Other
columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RUN = 1024
ESCAPES = {"\\": "\\", "s": "###", "e": "</turn>", "c": ":"}
TURN_END = " </turn>\n"
TURN = re.compile(r"### (.*?): (.*?) </turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


@dataclass(frozen=True)
class Budget:
    """Tokens of a window: ``window`` in all, of them at most ``history`` repeated ones."""

    window: int = 2048
    history: int = 256


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("###"), F.lit("\\s"))
    return F.replace(out, F.lit("</turn>"), F.lit("\\e"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPES[m[1]], text)


def word_tokens(text: Column) -> Column:
    """Default measure of a turn: its words and two for its frame."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 2


def windows(df: DataFrame, budget: Budget = Budget(), tokens=word_tokens, run: int = RUN) -> DataFrame:
    """``conv_id, window, text, n_tokens, n_turns`` and ``turns``: for each turn of the window in
    order its ``turn``, ``repeated`` (seen in an earlier window), and ``start``, ``end``: the code points of
    its text within the window, under the loss where ``loss`` is true."""
    turns = df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    turns = turns.withColumn("tokens", tokens(F.col("body"))).withColumn("run", F.floor(F.col("turn") / run))
    order = [F.asc_nulls_first("turn"), "role", "body"]
    # Totals of runs, then of turns within their run: position and first token of each turn.
    sums = turns.groupBy("conv_id", "run").agg(
        F.sum("tokens").alias("sum_tokens"),
        F.count(F.lit(1)).alias("sum_turns"),
        F.min(F.when(F.col("role") == "system", F.struct("turn", "body", "tokens"))).alias("system"),
    )
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("run")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("_conv"),
        F.col("run").alias("_run"),
        F.coalesce(F.sum("sum_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("sum_turns").over(before), F.lit(0)).alias("turns_before"),
        F.min("system").over(Window.partitionBy("conv_id")).alias("system"),
    )
    within = Window.partitionBy("conv_id", "run").orderBy(*order)
    placed = turns.withColumns(
        {
            "_n": F.row_number().over(within),
            "_sum": F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)),
        }
    ).join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("run").eqNullSafe(F.col("_run")), "left")
    placed = placed.withColumns(
        {
            "position": F.col("turns_before") + F.col("_n") - 1,
            "last": F.col("tokens_before") + F.col("_sum"),
            "room": F.greatest(F.lit(1), F.lit(budget.window - budget.history) - F.coalesce("system.tokens", F.lit(0))),
        }
    )
    # A span takes the turns that end within one half of the room, so that with the turn that reaches
    # in from before it stays within the room (a turn longer than that half is the exception).
    placed = placed.withColumn("half", F.greatest(F.lit(1), F.floor(F.col("room") / 2)))
    placed = placed.withColumn("window", F.floor((F.col("last") - 1) / F.col("half")))
    edge = (F.col("window") + 1) * F.col("half")
    uses = F.array(
        F.struct(F.col("window").alias("window"), F.lit(False).alias("repeated")),
        F.when(edge - F.col("last") + F.col("tokens") <= budget.history, F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("repeated"))),
    )
    used = placed.select(
        "conv_id",
        "position",
        "turn",
        "role",
        "body",
        "tokens",
        "system",
        F.explode(F.filter(uses, lambda u: u.isNotNull())).alias("use"),
    ).select("*", "use.window", "use.repeated").drop("use")
    grouped = used.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("position", "turn", "role", "body", "tokens", "repeated"))).alias("turns"),
        F.first("system").alias("system"),
    )
    # A window of repeated turns only comes after the last span.
    grouped = grouped.where(F.exists("turns", lambda t: ~t["repeated"]))
    system = F.struct(
        F.lit(-1).cast("long").alias("position"),
        F.col("system.turn").alias("turn"),
        F.lit("system").alias("role"),
        F.col("system.body").alias("body"),
        F.col("system.tokens").alias("tokens"),
        F.lit(True).alias("repeated"),
    )
    has_system = F.exists("turns", lambda t: (t["role"] == "system") & t["turn"].eqNullSafe(F.col("system.turn")))
    grouped = grouped.withColumn(
        "turns",
        F.when(F.col("system").isNull() | has_system, F.col("turns")).otherwise(F.concat(F.array(system), F.col("turns"))),
    )

    def framed(t: Column) -> Column:
        head = F.concat(F.lit("### "), F.replace(escape(t["role"]), F.lit(":"), F.lit("\\c")), F.lit(": "))
        body = escape(t["body"])
        return F.struct(
            t["turn"].alias("turn"),
            t["repeated"].alias("repeated"),
            ((t["role"] == "assistant") & ~t["repeated"]).alias("loss"),
            F.length(head).alias("head"),
            F.length(body).alias("size"),
            t["tokens"].alias("tokens"),
            F.concat(head, body, F.lit(TURN_END)).alias("text"),
        )

    made = grouped.select("conv_id", "window", F.transform("turns", framed).alias("made"))
    # Where each text begins: a fold over the lengths of the turns before.
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<turn:bigint,repeated:boolean,loss:boolean,start:int,end:int>>)").alias("out"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + t["head"]
        placed = F.struct(t["turn"], t["repeated"], t["loss"], start.alias("start"), (start + t["size"]).alias("end"))
        return F.struct((state["at"] + t["head"] + t["size"] + len(TURN_END)).alias("at"), F.concat(state["out"], F.array(placed)).alias("out"))

    return made.select(
        "conv_id",
        "window",
        F.array_join(F.transform("made", lambda t: t["text"]), "").alias("text"),
        F.aggregate(F.transform("made", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens"),
        F.size("made").cast("long").alias("n_turns"),
        F.aggregate("made", zero, add, lambda s: s["out"]).alias("turns"),
    )


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Role, text (both unescaped) and where the text stands, of each turn of a window."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in TURN.finditer(text)]
