"""Chat formatting into budgeted, turn-aligned training windows.

Prefix sums of turn tokens deal the turns of a conversation to spans: a turn
belongs to the span in whose stride of the prefix sum it starts, so every
turn finds its span on its own. Each span becomes one window: the system turn
again, the turns just before the span that fit the history budget, then the
span's own turns. Repeated turns carry no loss, so each assistant text is a
target once.

The prefix sums are taken in two levels (blocks of turn numbers, then turns
of a block), so that a very long conversation isn't sorted in one task. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: tokens of a window without its system turn, and of the repeated history in it
BUDGET, HISTORY = 768, 192
#: turn numbers in a block of the two-level prefix sum
BLOCK = 512
#: estimate of a text's tokens: pieces of up to four letters or three digits, other marks singly
TOKEN = r"\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}]"
#: tokens of the marks around a turn
MARKS = 5


def escape(text: Column) -> Column:
    """No control string survives: backslashes are doubled and the bar of
    every ``<|`` gets one. Reversed by ``unescape``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As ``escape``; a line end becomes backslash n, as it ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Splits at doubled backslashes (found from the left, as written) and
    undoes the other escapes between them."""
    return F.array_join(F.transform(F.split(text, r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))), "\\")


def with_prefix(turns: DataFrame) -> DataFrame:
    """Adds ``at``: the tokens of the conversation's turns before this one, by
    turn, role and text (null turns first). Block totals are summed over each
    conversation's blocks, then turns within their block."""
    t = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("long"))
    totals = t.groupBy("conv_id", "block").agg(F.sum("tokens").alias("total"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
                         F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    t = t.join(base, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block")))
    return t.withColumn("at", F.col("base") + F.col("inner")).drop("block", "b_conv", "b_block", "base", "inner")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (number from 0), formatted,
    n_context (repeated turns at its head), n_turns (own turns), tokens,
    over_budget, loss (array of start, length in code points: the escaped
    assistant texts that are targets).

    Own turns start within half of ``budget - history`` of each other, so a
    window without its system turn stays within ``budget`` unless one turn is
    longer than that half; such a turn is kept whole and ``over_budget`` says
    so. Turns go by turn, role, text; null texts and roles count as empty,
    null turns come first, rows with a null conv_id form one conversation,
    repeated rows are turns of their own, other columns are ignored, an empty
    table gives an empty result. A first turn of role ``system`` is repeated
    in every later window."""
    stride = (budget - history) // 2
    if stride < 1 or history > stride:
        raise ValueError("history must fit half of the rest of the budget")
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = with_prefix(t.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + MARKS))
    t = t.withColumn("window", F.floor(F.col("at") / stride).cast("long"))
    body = escape(F.col("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    t = t.select("conv_id", "window", "at", "tokens", F.concat(head, body, F.lit(END + "\n")).alias("segment"),
                 F.char_length(head).alias("skip"), F.char_length(body).alias("chars"),
                 (F.col("role") == "assistant").alias("target"), ((F.col("at") == 0) & (F.col("role") == "system")).alias("system"))
    spans = t.groupBy("conv_id", "window").agg(F.min("at").alias("opens"))
    nxt = spans.select(F.col("conv_id").alias("n_conv"), (F.col("window") - 1).alias("n_window"), F.col("opens").alias("next_opens"))
    t = t.join(nxt, F.col("conv_id").eqNullSafe(F.col("n_conv")) & (F.col("window") == F.col("n_window")), "left").drop("n_conv", "n_window")
    # a turn that starts within the history budget of the next window is repeated there
    again = ~F.col("system") & (F.col("next_opens") - F.col("at") <= history)
    own = t.withColumn("place", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    own = own.select("conv_id", (F.col("window") + F.col("place")).alias("window"), "at", "tokens", "segment", "skip", "chars",
                     (F.col("target") & (F.col("place") == 0)).alias("target"), (F.col("place") == 1).alias("repeated"))
    system = t.where("system").select("conv_id", F.lit(-1).cast("long").alias("at"), "tokens", "segment", "skip", "chars",
                                      F.lit(False).alias("target"), F.lit(True).alias("repeated"))
    later = spans.where("window > 0").select(F.col("conv_id").alias("l_conv"), "window")
    system = system.join(later, F.col("conv_id").eqNullSafe(F.col("l_conv"))).select(*own.columns)
    rows = own.unionByName(system).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct(
        "at", "tokens", "segment", "skip", "chars", "target", "repeated"))).alias("s"))
    loss = F.aggregate("s", F.struct(F.lit(0).alias("n"), F.lit(None).cast("array<struct<start:int,length:int>>").alias("spans")),
                       lambda a, x: F.struct(
                           (a["n"] + F.char_length(x["segment"])).alias("n"),
                           F.when(x["target"], F.concat(F.coalesce(a["spans"], F.array().cast("array<struct<start:int,length:int>>")), F.array(
                               F.struct((a["n"] + x["skip"]).alias("start"), x["chars"].alias("length"))))).otherwise(a["spans"]).alias("spans")),
                       lambda a: F.coalesce(a["spans"], F.array().cast("array<struct<start:int,length:int>>")))
    total = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    paid = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.when(x["at"] >= 0, x["tokens"]).otherwise(F.lit(0)))
    n_context = F.size(F.filter("s", lambda x: x["repeated"]))
    return rows.select("conv_id", "window", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"),
                       n_context.alias("n_context"), (F.size("s") - n_context).alias("n_turns"), total.alias("tokens"),
                       (paid > budget).alias("over_budget"), loss.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """What the formatted windows say, from their text and loss spans alone:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    parts = F.split("formatted", r"<\|im_end\|>\n")
    turns = F.slice(parts, F.col("n_context") + 1, F.size(parts) - 1 - F.col("n_context"))

    def turn(p: Column) -> Column:
        inner = F.substring(p, F.lit(len(START) + 1), F.char_length(p))
        role = F.substring_index(inner, "\n", 1)
        return F.concat(unescape(role), F.lit("\n"), unescape(F.substring(inner, F.char_length(role) + 2, F.char_length(inner))), F.lit("\n"))

    w = windows.select("conv_id", "window", F.size(turns).alias("n"), F.array_join(F.transform(turns, turn), "").alias("said"),
                       F.array_join(F.transform("loss", lambda x: unescape(F.substring("formatted", x["start"] + 1, x["length"]))), "").alias("target"),
                       F.char_length("formatted").cast("long").alias("chars"))
    c = w.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                 F.array_sort(F.collect_list(F.struct("window", "said", "target"))).alias("w"))
    said = F.array_join(F.transform("w", lambda x: x["said"]), "")
    target = F.array_join(F.transform("w", lambda x: x["target"]), "")
    return c.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.char_length(target).cast("long").alias("loss_chars"),
                    F.sha2(target, 256).alias("loss_sha256"), "formatted_chars")
