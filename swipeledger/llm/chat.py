"""Multi-party dialogues from the perspective of every participant. Column expressions only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
NOBODY = "unknown"


def _numbered(turns: DataFrame, cell_turns: int) -> DataFrame:
    """``seq``: the place of a row in its conversation, from 0. Rows are ranked within cells of
    ``cell_turns`` turn numbers, and only the cells of a conversation are added up, so that a very
    long conversation is no single group."""
    turns = turns.withColumn("cell", F.floor(F.col("turn") / cell_turns))
    order = [F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("text")]
    ranked = turns.withColumn("at", F.row_number().over(Window.partitionBy("conv", "cell").orderBy(*order)) - 1)
    by_cell = Window.partitionBy("conv").orderBy(F.col("cell").asc_nulls_last())
    cells = (
        turns.groupBy("conv", "cell").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col("conv").alias("c_conv"), F.col("cell").alias("c_cell"), F.coalesce("before", F.lit(0)).alias("before"))
    )
    same = F.col("conv").eqNullSafe(F.col("c_conv")) & F.col("cell").eqNullSafe(F.col("c_cell"))
    return ranked.join(cells, same).withColumn("seq", F.col("before") + F.col("at"))


def _head(speaker: Column, me: Column) -> Column:
    role = (
        F.when(speaker == SYSTEM, F.lit(SYSTEM))
        .when(speaker == me, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), speaker))
    )
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def perspectives(conversations: DataFrame, part_turns: int = 256) -> DataFrame:
    """Every conversation once for each of its participants: that speaker's turns are the
    assistant's, all others' are those of users with their names, and the system's are the system's.

    One row per conversation, participant and part: ``conv_id``, ``speaker``, ``part`` (from 0),
    ``n_turns``, ``dialogue``, ``start`` (code points of the dialogue before this part) and ``masks``,
    the spans of ``dialogue`` that count for the loss: what the speaker says, with the closing
    mark, in code points from the part's start. A part has ``part_turns`` turns; a conversation
    up to that length is one row. The parts of one dialogue, joined in order, are the dialogue.

    Turns are ordered by number, null last, then speaker, then text; repeated rows are
    repeated turns. A null text is an empty turn, a null role the speaker ``unknown``; rows without
    an id are one conversation. The system is no participant, so a conversation with system turns
    alone gives no row. Columns beyond the four are left out."""
    turns = conversations.select(
        F.col("conv_id").alias("conv"), "turn",
        F.coalesce("role", F.lit(NOBODY)).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = (
        _numbered(turns, part_turns)
        .groupBy("conv", F.floor(F.col("seq") / part_turns).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("seq", "speaker", "text"))).alias("turns"))
    )
    people = (
        turns.where(F.col("speaker") != SYSTEM)
        .select(F.col("conv").alias("p_conv"), F.col("speaker").alias("me")).distinct()
    )
    me = F.col("me")
    said = lambda t: F.concat(_head(t["speaker"], me), t["text"], F.lit(CLOSE))
    span = lambda at, t: F.struct(
        (at + F.length(_head(t["speaker"], me))).alias("start"), (at + F.length(said(t))).alias("end")
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    walked = F.aggregate(
        "turns",
        nothing,
        lambda acc, t: F.struct(
            (acc["at"] + F.length(said(t))).alias("at"),
            F.when(t["speaker"] == me, F.concat(acc["spans"], F.array(span(acc["at"], t)))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    seen = parts.join(people, F.col("conv").eqNullSafe(F.col("p_conv"))).select(
        F.col("conv").alias("conv_id"), me.alias("speaker"), "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", said), "").alias("dialogue"),
        walked["spans"].alias("masks"),
    )
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return seen.withColumn("start", F.coalesce(F.sum(F.length("dialogue")).over(before), F.lit(0)))
