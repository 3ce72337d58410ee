"""Multi-party perspective rotation for chat training data.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant, everybody else as named users and setting roles
(``system``) as they are; loss masks cover what that speaker says.

A rendered dialogue is cut into parts of ``part_turns`` turn numbers, and a part
in which numbers repeat into sections of ``SECTION_TURNS`` turns, so a
conversation of any length stays in rows of bounded size; the whole dialogue
is its parts and sections in order.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The delimiters of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PART_TURNS = 64
SECTION_TURNS = 256
HEX_DIGITS = "0123456789abcdef"  # a part each for the turns without a number
SETTING_ROLES = ("system",)
_LAST = 9223372036854775807 - 64 * 16


def rotate_perspectives(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", setting_roles: tuple[str, ...] = SETTING_ROLES, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, participant (``speaker``), ``part`` and ``section``.

    Columns: the conversation id, ``speaker``, ``part``, ``section`` (from 0),
    ``n_turns``, ``rendered`` and ``mask`` (array of start and end in code
    points of ``rendered``, end exclusive: the contents and end marks of the
    speaker's turns).

    Turns sort by number, then role, then text; equal rows with a number are
    one turn.  Turns without a number come last, in up to 16
    parts by hash of role and text, and each of their copies is a turn of its
    own.  A null role is the unnamed user and no participant; null texts are
    empty; rows with a null conversation id form one conversation.
    Conversations in which only setting roles speak, and empty tables, give no
    rows; a text of any length is one turn; further columns are not read.
    """
    role, text, number = (F.col(c) for c in ("__role", "__text", "__turn"))
    rows = turns.select(F.col(conv_col).alias("__conv"), F.col(turn_col).cast("long").alias("__turn"), F.coalesce(F.col(role_col), F.lit("")).alias("__role"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    distinct = rows.groupBy("__conv", "__turn", "__role", "__text").agg(F.count(F.lit(1)).alias("__n"))
    digit = F.instr(F.lit(HEX_DIGITS), F.substring(F.md5(F.concat(role, F.lit(" "), text).cast("binary")), 1, 1)) - 1
    last = F.lit(_LAST // part_turns) + digit
    placed = distinct.withColumn("__part", F.when(number.isNull(), last).otherwise(F.expr(f"(__turn - pmod(__turn, {part_turns})) div {part_turns}")))
    placed = placed.withColumn("__n", F.when(number.isNull(), F.col("__n")).otherwise(F.lit(1)))
    before = Window.partitionBy("__conv", "__part").orderBy("__turn", "__role", "__text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("__end", F.sum("__n").over(before)).withColumn("__at", F.col("__end") - F.col("__n"))
    # a run of copies may go on through several sections
    spread = ranked.withColumn("__section", F.explode(F.expr(f"sequence(__at div {SECTION_TURNS}, (__end - 1) div {SECTION_TURNS})")))
    copies = F.least("__end", (F.col("__section") + 1) * SECTION_TURNS) - F.greatest("__at", F.col("__section") * SECTION_TURNS)
    said = F.struct(F.col("__at").alias("at"), role.alias("role"), text.alias("text"), copies.cast("int").alias("n"))
    parts = spread.groupBy("__conv", "__part", "__section").agg(F.array_sort(F.collect_list(said)).alias("__said"))
    parts = parts.withColumn("__turns", F.flatten(F.transform("__said", lambda t: F.array_repeat(t, t["n"])))).drop("__said")
    speakers = (
        turns.where(F.col(role_col).isNotNull() & (F.col(role_col) != "") & ~F.col(role_col).isin(*setting_roles))
        .select(F.col(conv_col).alias("__conv"), F.col(role_col).alias("speaker"))
        .distinct()
    )
    each = parts.alias("p").join(speakers.alias("s"), F.col("p.__conv").eqNullSafe(F.col("s.__conv"))).select("p.*", "s.speaker")

    def head(t: Column) -> Column:
        said_by = F.when(t["role"] == F.col("speaker"), F.lit("assistant")).when(t["role"].isin(*setting_roles), t["role"]).when(t["role"] == "", F.lit("user")).otherwise(F.concat(F.lit("user name="), t["role"]))
        return F.concat(F.lit(OPEN), said_by, F.lit("\n"))

    blocks = F.transform("__turns", lambda t: F.struct(head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), (t["role"] == F.col("speaker")).alias("own")))
    mask_type = "array<struct<start:bigint,end:bigint>>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {mask_type})").alias("out"))

    def step(acc: Column, b: Column) -> Column:
        start = acc["at"] + F.length(b["head"])
        end = start + F.length(b["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(b["own"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    made = each.withColumn("__blocks", blocks)
    return made.select(
        F.col("__conv").alias(conv_col),
        "speaker",
        F.col("__part").alias("part"),
        F.col("__section").alias("section"),
        F.size("__blocks").cast("long").alias("n_turns"),
        F.array_join(F.transform("__blocks", lambda b: F.concat(b["head"], b["body"])), "").alias("rendered"),
        F.aggregate("__blocks", begin, step, lambda acc: acc["out"]).alias("mask"),
    )
