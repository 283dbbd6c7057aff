"""Chat formatting into budgeted windows, with a loss mask, in DataFrame functions only.

A turn is written as ``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts
get a backslash after their first character, and a backslash is doubled, so the template can
be read back exactly. Prefix sums of turn tokens cut a conversation into spans of whole
turns; a window is the system turn, a few turns of history, and the span. Loss lies on the
span's own assistant texts, so every assistant text is trained on once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template. The escape covers these strings and those of the same family.
TURN_OPEN, ROLE_CLOSE, TURN_CLOSE = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"([<\[])(/?s>|/?INST\]|</?SYS>>)|(\\)"

SYSTEM, ASSISTANT = "system", "assistant"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, turns of history it may repeat, characters that make a token.

    Spans start anew at every half of ``tokens``; the other half is for the system turn,
    the history and the end of the span's last turn. History that does not fit is left out,
    oldest first, so a window is larger only if a turn or the system turn is.
    """
    tokens: int = 1024
    history_turns: int = 2
    chars_per_token: int = 4


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_windows(turns: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text).

    Gives conv_id, window (its place in the conversation), text, n_context (turns at its
    start that another window trains on), n_turns (all turns in it) and loss, an array of
    (start, length) in code points of ``text``. A NULL role or text is empty. Turns with the
    same number are ordered by role and text and repeated rows stay; a NULL conversation is
    one of its own. An empty table gives an
    empty one; other columns are not read.
    """
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    coded = rows.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(TURN_OPEN), escaped(F.col("role")), F.lit(ROLE_CLOSE)).alias("head"),
        escaped(F.col("text")).alias("body"))
    size = F.ceil((F.length("head") + F.length("body") + len(TURN_CLOSE))
                  / budget.chars_per_token)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = coded.select(
        "conv_id", "role", "head", "body",
        F.row_number().over(order).alias("place"), size.alias("size"),
        F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    placed = Window.partitionBy("conv_id").orderBy("place")
    spans = numbered.withColumn("before", F.coalesce("before", F.lit(0))).withColumn(
        "span", F.floor(F.col("before") * 2 / budget.tokens))
    later = [F.lead("span", k).over(placed) for k in range(1, budget.history_turns + 1)]
    is_system = (F.col("place") == 1) & (F.col("role") == SYSTEM)
    turn = ("place", "role", "head", "body", "span", "before", "size")
    reach = spans.select(
        "*", F.array(F.col("span"), *later).alias("history"), is_system.alias("is_system"),
        F.coalesce(F.col("span") != F.lag("span").over(placed), F.lit(True)).alias("opens"),
        F.first(F.when(is_system, F.struct(*turn))).over(placed).alias("system"))
    entry = "array<struct<window:bigint,place:int,role:string,head:string,body:string,span:bigint,before:bigint,size:bigint,is_system:boolean>>"

    def in_window(window: Column, of: str, system: Column) -> Column:
        return F.struct(window.alias("window"), *(F.col(f"{of}{c}").alias(c) for c in turn), system.alias("is_system"))

    own = F.transform(F.when(F.col("is_system"), F.array("span")).otherwise(
        F.array_distinct(F.array_compact("history"))), lambda w: in_window(w, "", F.col("is_system")))
    # The first turn of a span brings the system turn along: a long turn leaves span numbers unused.
    brought = F.when(F.col("opens") & ~F.col("is_system") & F.col("system").isNotNull(),
                     F.array(in_window(F.col("span"), "system.", F.lit(True)))).otherwise(F.array())
    copies = reach.select("conv_id", F.inline(F.concat(own.cast(entry), brought.cast(entry))))
    piece = F.struct(
        "place",
        (F.col("window") == F.col("span")).alias("fresh"),
        ((F.col("window") == F.col("span")) & (F.col("role") == ASSISTANT)).alias("trained"),
        "head", "body", "before", "is_system")
    fixed = F.sum(F.when(F.col("is_system"), F.col("size")).otherwise(0))
    grouped = (
        copies.groupBy("conv_id", "window")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"), fixed.alias("fixed"),
             F.max(F.col("before") + F.col("size")).alias("end"))
        .withColumn("pieces", F.filter("pieces", lambda p: p["fresh"] | p["is_system"] | (
            F.col("end") - p["before"] + F.col("fixed") <= budget.tokens))))
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def add(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        span = F.struct(start.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct(
            (start + F.length(p["body"]) + len(TURN_CLOSE)).alias("at"),
            F.when(p["trained"], F.array_append(state["loss"], span))
            .otherwise(state["loss"]).alias("loss"))

    return grouped.select(
        "conv_id", "window",
        F.array_join(F.transform("pieces", lambda p: F.concat(
            p["head"], p["body"], F.lit(TURN_CLOSE))), "").alias("text"),
        F.size(F.filter("pieces", lambda p: ~p["fresh"])).alias("n_context"),
        F.size("pieces").alias("n_turns"),
        F.aggregate("pieces", F.struct(F.lit(0).alias("at"), empty.alias("loss")), add,
                    lambda state: state["loss"]).alias("loss"))


def read_windows(windows: DataFrame) -> DataFrame:
    """The window's own turns, read back: windows with ``turns`` (role, text) and ``targets``.

    ``targets`` are the unescaped texts under the loss mask.
    """
    pieces = F.split("text", TURN_CLOSE, -1)
    own = F.slice(pieces, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))

    def turn(piece: Column) -> Column:
        rest = F.substr(piece, F.lit(len(TURN_OPEN) + 1))
        role = F.substring_index(rest, ROLE_CLOSE, 1)
        return F.struct(
            unescaped(role).alias("role"),
            unescaped(F.substr(rest, F.length(role) + len(ROLE_CLOSE) + 1)).alias("text"))

    return windows.select(
        "*", F.transform(own, turn).alias("turns"),
        F.transform("loss", lambda s: unescaped(
            F.substr(F.col("text"), s["start"] + 1, s["length"]))).alias("targets"))


def digests(windows: DataFrame) -> DataFrame:
    """What a conversation's windows hold, read back from them, in a row per conversation."""
    read = read_windows(windows).select(
        "conv_id", "window", F.size("turns").alias("n"), F.length("text").alias("chars"),
        F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("learned"))
    parts = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
        F.array_sort(F.collect_list(F.struct("window", "said", "learned"))).alias("parts"))
    learned = F.array_join("parts.learned", "")
    return parts.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join("parts.said", ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars", "n_windows")
