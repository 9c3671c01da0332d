"""Chat formatting in budgeted windows, with DataFrame functions only.

The turns of a conversation lie end to end on a line of tokens; prefix sums give each its place. The line
is cut every ``step`` tokens: turns inside a stretch are a window, a turn across a cut is a window of its
own, so a window's new turns exceed ``step`` only where a single turn does. A window opens with the
conversation's system turn and with the turns that lie wholly in the ``history`` tokens before it. These
repeats are not trained on again: the loss mask covers the assistant turns of the window where they are new.

The prefix sums are taken in two levels, inside blocks of turn numbers and over the blocks' totals, so a
long conversation is not one task's sort. A window is bounded by its budget, so is what one row gathers.

Template: ``### role: text</turn>`` and a line feed for each turn. In texts and roles a backslash is doubled,
``</turn>`` becomes ``<\\/turn>`` and ``##`` becomes ``#\\#`` (no three in a row stay): reading drops each backslash and
keeps the character behind it. In roles ``%`` becomes ``%0`` and a colon ``%1`` before that, so the first colon of a
turn ends its role and is found without a pattern, however long the role is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import stage

BUDGET = 1024
HISTORY = 128
SYSTEM_RESERVE = 128
#: Turn numbers of a block of the prefix sums.
BLOCK = 256

#: What a conversation is known by: its id as text, and whether it has none. Plain columns keep a
#: partitioning through joins that a null-safe comparison would deal out again.
CONV = ["conv_key", "conv_null"]

OPEN, CLOSE = "### ", "</turn>"
SYSTEM, ASSISTANT = "system", "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit(CLOSE), F.lit("<\\/turn>")), F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%0")), F.lit(":"), F.lit("%1")))


def unescape_role(head: Column) -> Column:
    return F.replace(F.replace(unescape(head), F.lit("%1"), F.lit(":")), F.lit("%0"), F.lit("%"))


def estimated_tokens(text: Column) -> Column:
    """A quarter of the characters, and four for a turn's marks."""
    return (F.ceil(F.char_length(text) / 4) + 4).cast("long")


def placed_turns(df: DataFrame, conv: str, turn: str, role: str, text: str, tokens: Column | None) -> DataFrame:
    """Escaped turns with the place ``begin`` and ``end`` of each on its conversation's line of tokens."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    speaker = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    counted = estimated_tokens(body) if tokens is None else F.greatest(tokens.cast("long"), F.lit(1))
    number = F.col(f"`{turn}`")
    own = F.col(f"`{conv}`")
    rows = df.select(
        own.alias("conv"), F.coalesce(own.cast("string"), F.lit("")).alias("conv_key"), own.isNull().alias("conv_null"),
        # A null turn number comes first; equal numbers go by role and text.
        number.alias("turn"), F.coalesce(F.floor(number / BLOCK), F.lit(-(1 << 62))).alias("block"), speaker.alias("role"), escape(body).alias("body"), escape_role(speaker).alias("head"),
        counted.alias("tokens"),
    )
    inside = Window.partitionBy(*CONV, "block").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*CONV, "block").agg(F.sum("tokens").alias("total"))
    over = Window.partitionBy(*CONV).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(*CONV, "block", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("before"))
    local = rows.withColumn("local", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    begin = F.col("before") + F.col("local")
    return local.join(before, [*CONV, "block"]).select(
        "conv", *CONV, "role", "body", "head", begin.alias("begin"), (begin + F.col("tokens")).alias("end"),
    )


def format_windows(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokens: Column | None = None,
    budget: int = BUDGET, history: int = HISTORY, system_reserve: int = SYSTEM_RESERVE,
) -> DataFrame:
    """One row per window: conversation id, ``window`` (ascending), ``text``, ``n_repeated`` (turns at its
    head that earlier windows have), ``loss`` (start and length of each span, in code points from 1),
    ``n_tokens`` and ``over_budget`` (a single turn, or the system turn, is too long).

    ``tokens`` counts a turn's tokens (1 at least); by default they are estimated. Null texts and roles
    count as empty. Null ids are one conversation. Repeated turns stay, ordered by role and text. Several
    system turns: the first is retained. Empty input: no rows.
    """
    step = budget - history - system_reserve
    if not 0 <= history <= step:
        raise ValueError("the history may not exceed what is left for new turns")
    turns = stage(placed_turns(df, conv, turn, role, text, tokens), "turns")
    stretch = F.floor(F.col("begin") / step)
    across = (F.floor((F.col("end") - 1) / step) != stretch).cast("long")
    own = turns.withColumn("window", 2 * stretch + across)
    starts = own.groupBy(*CONV, "window").agg(F.min("begin").alias("start"))

    # The windows that may open within ``history`` tokens behind a turn: a few, found by their number.
    reach = F.sequence(2 * F.floor(F.col("end") / step), 2 * F.floor((F.col("begin") + history) / step) + 1)
    near = turns.filter(F.col("end") <= F.col("begin") + history).withColumn("window", F.explode(reach))
    recent = (F.col("start") >= F.col("end")) & (F.col("start") <= F.col("begin") + history)
    repeats = near.join(starts, [*CONV, "window"]).filter(recent).drop("start")

    systems = turns.filter(F.col("role") == SYSTEM)
    first = systems.groupBy(*CONV).agg(F.min("begin").alias("begin"))
    system = systems.join(first, [*CONV, "begin"])
    retained = starts.join(system, CONV).filter((F.col("begin") < F.col("start") - history) & (F.col("end") <= F.col("start")))
    retained = retained.drop("start")

    pieces = reduce(
        lambda a, b: a.unionByName(b),
        (p.withColumn("new", F.lit(new)) for p, new in ((own, True), (repeats, False), (retained, False))),
    )
    opening = F.concat(F.lit(OPEN), F.col("head"), F.lit(": "))
    piece = F.struct(
        "begin", "new", opening.alias("opening"), "body", (F.col("new") & (F.col("role") == ASSISTANT)).alias("loss"),
        (F.col("end") - F.col("begin")).alias("tokens"),
    )
    windows = pieces.groupBy(*CONV, "window").agg(F.first("conv").alias("conv"), F.array_sort(F.collect_list(piece)).alias("turns"))
    closing = F.lit(CLOSE + "\n")
    rendered = F.transform("turns", lambda t: F.concat(t["opening"], t["body"], closing))
    # Each turn's first character: what stands before it, summed up.
    lengths = F.transform("turns", lambda t: F.char_length(t["opening"]) + F.char_length(t["body"]) + len(CLOSE) + 1)
    offsets = F.aggregate(
        F.col("lengths"), F.array(F.lit(1)), lambda seen, n: F.concat(seen, F.array(F.element_at(seen, -1) + n))
    )
    spans = F.zip_with("turns", F.col("offsets"), lambda t, at: F.struct(
        t["loss"].alias("loss"), (at + F.char_length(t["opening"])).alias("start"), F.char_length(t["body"]).alias("length")
    ))
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    laid = windows.withColumn("lengths", lengths).withColumn("offsets", F.slice(offsets, 1, F.size("turns"))).withColumn("spans", spans)
    return laid.select(
        F.col("conv").alias(conv), "window", F.array_join(rendered, "").alias("text"),
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("n_repeated"),
        F.transform(F.filter("spans", lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"])).alias("loss"),
        total.alias("n_tokens"), (total > budget).alias("over_budget"),
    )


def read_turns(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The conversation read back from its windows: id, ``window``, ``turns`` (role and text, each turn once),
    ``targets`` (the texts under the loss mask) and ``n_chars`` of the window's text."""
    marked = F.split("text", f"{CLOSE}\n")
    # What follows the last mark is empty; repeats stand at the head.
    marked = F.slice(marked, F.col("n_repeated") + 1, F.size(marked) - 1 - F.col("n_repeated"))

    def turn(t: Column) -> Column:
        head = F.substring(F.substring_index(t, ": ", 1), F.lit(len(OPEN) + 1), F.char_length(t))
        body = F.substring(t, F.char_length(head) + len(OPEN) + 3, F.char_length(t))
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    targets = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"], s["length"])))
    return windows.select(
        F.col(conv), "window", F.transform(marked, turn).alias("turns"), targets.alias("targets"), F.char_length("text").cast("long").alias("n_chars")
    )
