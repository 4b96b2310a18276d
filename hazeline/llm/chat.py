"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens, taken inside blocks of turns on top of the sums of
the blocks before, place every turn in one window: the one whose stretch of
tokens holds the turn's start. A stretch is the window's room without the longest
turn of the conversation, which may start at its very end. A window is made of the system turn, a limited
history of turns from the window before, and its own turns; only the assistant
texts among its own turns are under the loss mask, so each is a target once.

Every turn is ``<|im_start|>role\\n text <|im_end|>\\n`` (without the spaces).
Texts can't hold a marker: a backslash is doubled and ``<|`` becomes ``<\\|``; a
role's line break becomes ``<\\/``. :func:`unescaped` is the exact inverse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens counted for a turn's markers.
TURN_TOKENS = 4
#: Turn numbers that share a block of the prefix sums.
BLOCK = 64


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\/"))


def unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("<\\/"), F.lit("\n")), F.lit("<\\|"), F.lit("<|"))
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """Words of a text and the turn's markers: what the budget counts unless a
    column of sizes is named. Only a rough measure of texts with spaces."""
    return (F.regexp_count(text, F.lit(r"\S+")) + TURN_TOKENS).cast("long")


def turn_bytes(role: Column, text: Column) -> Column:
    """UTF-8 bytes of a turn as formatted: no byte-level tokenizer makes more
    tokens of it, in any script."""
    plain = F.concat(escaped_role(F.coalesce(role, F.lit(""))), escaped(F.coalesce(text, F.lit(""))))
    return (F.octet_length(plain) + len(START) + len("\n") + len(END)).cast("long")


def _placed(turns: DataFrame) -> DataFrame:
    """Adds seq (from 1) and start (tokens of the turns before) by conversation."""
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    t = turns.withColumn("block", block)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (t.groupBy("conv_id", "block").agg(F.sum("tokens").alias("s"), F.count("*").alias("c"))
            .select(F.col("conv_id").alias("k"), F.col("block").alias("b"),
                    F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"),
                    F.coalesce(F.sum("c").over(before), F.lit(0)).alias("rows")))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    running = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (t.join(sums, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("block") == F.col("b")))
            .withColumn("seq", F.col("rows") + F.row_number().over(inside))
            .withColumn("start", F.col("base") + running - F.col("tokens"))
            .select("conv_id", "seq", "start", "tokens", "role", "text"))


def windows(conversations: DataFrame, budget: int = 2048, history: int = 256, size: str | None = None) -> DataFrame:
    """One row per window: conv_id, window, formatted, loss_spans (array of
    start and length in characters of ``formatted``), own_from (where its own
    turns begin), n_turns and n_tokens of all its turns, over_budget.

    ``conversations`` has conv_id, turn, role, text; other columns aren't read.
    Null texts and roles are empty. Turns are ordered by turn (null first), then
    role and text; repeated rows are turns of their own. A null conv_id is one
    conversation. The first turn with role ``system`` begins every window after
    its own. ``size`` names a column with each turn's tokens (of a tokenizer, or
    :func:`turn_bytes`); null counts as 0. A window's own turns hold at most budget
    - system - history tokens unless one turn alone is longer than half of that:
    turns are never cut, and over_budget marks such windows. No row in, no row out.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)) if size else turn_tokens(F.coalesce("text", F.lit("")))).alias("tokens"))
    turns = _placed(turns)
    first = F.min(F.when(F.col("role") == "system", F.struct("seq", "text", "tokens")))
    known = turns.groupBy(F.col("conv_id").alias("k")).agg(first.alias("sys"), F.max("tokens").alias("longest"))
    t = turns.join(known, F.col("conv_id").eqNullSafe(F.col("k"))).drop("k")
    # A stretch holds the starts of a window's own turns: the last of them goes
    # beyond it by its length at most.
    room = F.lit(budget - history) - F.coalesce(F.col("sys.tokens"), F.lit(0))
    t = t.withColumn("stretch", F.greatest(room - F.least(F.col("longest"), F.floor(room / 2)), F.lit(1)))
    t = t.withColumn("at", F.floor(F.col("start") / F.col("stretch")))
    # A turn belongs to its window and may be history of the next: no farther,
    # as the history is no longer than a stretch.
    t = t.withColumn("window", F.explode(F.array("at", F.col("at") + 1)))
    one = F.struct("seq", "start", (F.col("window") == F.col("at")).alias("own"), "role", "text", "tokens")
    grouped = (t.groupBy("conv_id", "window")
               .agg(F.sort_array(F.collect_list(one)).alias("all"), F.first("sys").alias("sys"),
                    F.first("stretch").alias("stretch"),
                    F.min(F.when(F.col("window") == F.col("at"), F.col("start"))).alias("begins"),
                    F.min(F.when(F.col("window") == F.col("at"), F.col("seq"))).alias("from_seq"))
               .where("begins is not null"))
    far = F.col("begins") - F.least(F.lit(history).cast("long"), F.col("stretch"))
    none = F.expr("cast(array() as array<struct<seq:bigint,start:bigint,own:boolean,role:string,text:string,tokens:bigint>>)")
    again = F.when(F.col("sys.seq") < F.col("from_seq"), F.array(F.struct(
        F.col("sys.seq").alias("seq"), F.lit(0).cast("long").alias("start"), F.lit(False).alias("own"),
        F.lit("system").alias("role"), F.col("sys.text").alias("text"), F.col("sys.tokens").alias("tokens")))).otherwise(none)
    past = F.filter("all", lambda x: ~x["own"] & (x["start"] >= far)
                    & ~x["seq"].eqNullSafe(F.col("sys.seq")))
    own = F.filter("all", lambda x: x["own"])
    parts = grouped.select("conv_id", "window", again.alias("again"), past.alias("past"), own.alias("own"))
    parts = parts.withColumn("turns", F.concat("again", "past", "own"))
    shown = F.transform("turns", lambda x: F.struct(
        x["own"].alias("own"), x["role"].alias("role"),
        F.concat(F.lit(START), escaped_role(x["role"]), F.lit("\n")).alias("head"),
        escaped(x["text"]).alias("body")))
    shown = parts.withColumn("shown", shown)
    begin = F.struct(F.lit(0).alias("pos"), F.lit(-1).alias("own_from"),
                     F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        at = state["pos"] + F.length(x["head"])
        span = F.array(F.struct(at.alias("start"), F.length(x["body"]).alias("length")))
        target = x["own"] & (x["role"] == "assistant")
        return F.struct((at + F.length(x["body"]) + len(END)).alias("pos"),
                        F.when(x["own"] & (state["own_from"] < 0), state["pos"]).otherwise(state["own_from"]).alias("own_from"),
                        F.when(target, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    told = shown.withColumn("walk", F.aggregate("shown", begin, step))
    text = F.concat_ws("", F.transform("shown", lambda x: F.concat(x["head"], x["body"], F.lit(END))))
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])
    return told.select("conv_id", "window", text.alias("formatted"), F.col("walk.spans").alias("loss_spans"),
                       F.col("walk.own_from").alias("own_from"), F.size("turns").alias("n_turns"),
                       total.alias("n_tokens"), (total > budget).alias("over_budget"))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted text: array of role and text, unescaped."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # what follows the last end is empty
    body = F.transform(pieces, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    return F.transform(body, lambda p: F.struct(
        unescaped(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, F.lit("\n")) + 1, F.length(p))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations as their windows tell them: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows. A digest
    of a whole conversation needs its text in one row, so the last grouping
    does; everything before works on windows."""
    own = F.substring(F.col("formatted"), F.col("own_from") + 1, F.length("formatted"))
    w = formatted.select("conv_id", "window", "formatted", "loss_spans", parsed(own).alias("turns"))
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]))))
    w = w.select("conv_id", "window", F.size("turns").cast("long").alias("n"), said.alias("said"), loss.alias("loss"),
                 F.length("formatted").cast("long").alias("chars"))
    whole = w.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("w"),
        F.sum("chars").alias("formatted_chars"))
    text = lambda name: F.concat_ws("", F.transform("w", lambda x: x[name]))
    return whole.select("conv_id", "n_turns", F.sha2(text("said"), 256).alias("turns_sha256"),
                        F.length(text("loss")).cast("long").alias("loss_chars"),
                        F.sha2(text("loss"), 256).alias("loss_sha256"), "formatted_chars",
                        F.size("w").cast("long").alias("n_windows"))
