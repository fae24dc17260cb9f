"""Chat formatting with multi-party perspective rotation.

Every dialogue is rendered once for each of its participants: that speaker's messages become the
assistant's, all others' become named users', and the mask marks what the assistant says. Messages
with a fixed role (system) are nobody's and stay what they are.

A rendering comes as rows of at most ``CHUNK`` messages, so a usual dialogue is one row and a huge one
is many, none of them unbounded. Messages are numbered by a range partitioning: a huge dialogue is
spread over many tasks, each numbers its own part, and parts begin where the counts before them end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.session import materialise

CHUNK = 64
FIXED_ROLES = ("system",)
NOBODY = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def number_messages(messages: DataFrame) -> DataFrame:
    """Adds ``index``, from 0 in each conversation by turn, speaker and text, nulls last."""
    order = [F.col(c).asc_nulls_last() for c in ("turn", "speaker", "content")]
    placed = messages.repartitionByRange(F.col("conv_id").asc_nulls_last(), *order)
    placed = materialise(placed.withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("conv_id", "__part").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy("conv_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("conv_id").alias("__conv"),
        F.col("__part").alias("__of"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
    )
    inner = Window.partitionBy("conv_id", "__part").orderBy(*order)
    ranked = placed.withColumn("__rank", F.row_number().over(inner))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__part") == F.col("__of"))
    return ranked.join(starts, same).select(
        "conv_id", "speaker", "content", (F.col("__start") + F.col("__rank") - 1).alias("index")
    )


def escape(text: Column) -> Column:
    """One more backslash between ``<`` and ``|``, so that no text holds a mark; taking one away undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def header(speaker: Column, name: Column, perspective: Column, fixed: tuple[str, ...]) -> Column:
    role = (
        F.when(speaker == perspective, F.lit("assistant"))
        .when(speaker.isin(*fixed), speaker)
        .otherwise(F.concat(F.lit("user name="), name))
    )
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def rotate(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    fixed: tuple[str, ...] = FIXED_ROLES,
) -> DataFrame:
    """One row per dialogue, participant and chunk: conv_id, perspective, chunk, messages, text, masks.

    ``masks`` is an array of (start, end) in code points of the row's text: the assistant's messages
    with their closing mark. Marks inside texts and names are escaped (see :func:`escape`) and line
    breaks in names are blanks, so no message can pose as another speaker's. A null speaker is the participant "unknown", a
    null text is empty, null turns come last, and rows without a conversation id are one conversation.
    Messages with equal turns are ordered by speaker and text, repeated rows are all rendered. A
    dialogue without participants gives no row. Other columns are not looked at.
    """
    messages = df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit(NOBODY)).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    numbered = number_messages(messages).select(
        "conv_id",
        "index",
        "speaker",
        F.regexp_replace(escape(F.col("speaker")), r"[\r\n]", " ").alias("name"),
        escape(F.col("content")).alias("content"),
    )
    chunks = numbered.groupBy("conv_id", F.floor(F.col("index") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("index", "speaker", "name", "content"))).alias("part")
    )  # at most CHUNK messages
    people = messages.where(~F.col("speaker").isin(*fixed)).select(
        F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")
    )
    rows = chunks.join(people.distinct(), F.col("conv_id").eqNullSafe(F.col("__conv")))
    perspective = F.col("perspective")
    pieces = F.transform(
        "part",
        lambda m: F.struct(
            header(m["speaker"], m["name"], perspective, fixed).alias("head"),
            F.concat(m["content"], F.lit(CLOSE)).alias("body"),
            (m["speaker"] == perspective).alias("ours"),
        ),
    )
    rows = rows.withColumn("pieces", pieces)
    spoken = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["head"])
        end = start + F.length(piece["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"),
            F.when(piece["ours"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    empty = F.array().cast("array<struct<start:int,end:int>>")
    masks = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), empty.alias("spans")), add)["spans"]
    return rows.select(
        "conv_id",
        "perspective",
        "chunk",
        F.size("part").alias("messages"),
        spoken.alias("text"),
        masks.alias("masks"),
    )
