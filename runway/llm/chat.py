"""Chat formatting by multi-party perspective rotation.

Every participant of a dialogue gets a rendering of it in which that speaker is
the assistant, the others are named users, and system turns stay system turns.
The mask of a rendering covers what the assistant writes: the content of its
turns and their closing mark.

A dialogue of any length is spread over tasks: turns are range-partitioned by
(dialogue, turn, speaker, text), positions and offsets are running sums inside a
partition plus the totals of the partitions before it, and a rendering comes in
chunks of ``CHUNK_TURNS`` turns with their place in the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runway.llm.common import stage

CHUNK_TURNS = 128
# The marks of the chat format and the speakers that are no participants.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
NOT_PARTICIPANTS = ("system",)
UNNAMED = "unknown"
# Characters of a name that would end it or its header, and the escape sign itself, first.
ESCAPED = (("%", "%25"), (" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\x0b", "%0B"), ("\f", "%0C"), ("\r", "%0D"), ("<|", "%3C|"))


def _name(speaker: Column) -> Column:
    """The speaker as written: white space and marks escaped, so that different
    speakers have different names and no name closes its header."""
    for plain, escaped in ESCAPED:
        speaker = F.replace(speaker, F.lit(plain), F.lit(escaped))
    return speaker


def _header(speaker: Column, perspective: Column) -> Column:
    role = (F.when(speaker.isin(*NOT_PARTICIPANTS), speaker).when(speaker == perspective, F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), _name(speaker))))
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """Renderings of every dialogue from every participant's perspective.

    Returns conv_id, perspective, chunk (from 0), n_turns, start (characters of
    the rendering before the chunk), text, masks ("from-to" character ranges of
    the whole rendering, comma-separated). Turns are ordered by turn, speaker
    and text (nulls first). A null speaker is named "unknown", a null text is
    an empty turn, rows without conv_id form one dialogue of their own,
    repeated rows are repeated turns, marks inside a text are defused, marks, percent
    signs and white space inside a name are escaped as percent and hex digits. A
    dialogue with system turns only has no participant and no rendering. Other
    columns are ignored.
    """
    content = F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(UNNAMED)).alias("speaker"), content.alias("content"))
    rows = rows.repartitionByRange("conv_id", "turn", "speaker", "content").sortWithinPartitions(
        "conv_id", "turn", "speaker", "content")
    rows = stage(rows.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "turns")
    participants = rows.where(~F.col("speaker").isin(*NOT_PARTICIPANTS)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    views = rows.join(participants, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    header = _header(F.col("speaker"), F.col("perspective"))
    views = views.withColumn("header", header).withColumn(
        "chars", (F.length("header") + F.length("content") + len(CLOSE)).cast("long"))

    totals = views.groupBy("conv_id", "perspective", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("sum"))
    earlier = W.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(F.col("conv_id").alias("_conv"), F.col("perspective").alias("_view"), F.col("part").alias("_part"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
                           F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("chars_before"))
    inside = W.partitionBy("conv_id", "perspective", "part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    placed = (views.withColumn("_n", F.row_number().over(W.partitionBy("conv_id", "perspective", "part").orderBy("seq")) - 1)
              .withColumn("_chars", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
              .join(before, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_view"))
                    & (F.col("part") == F.col("_part"))))
    position = F.col("n_before") + F.col("_n")
    start = F.col("chars_before") + F.col("_chars")
    mask = F.when(F.col("speaker") == F.col("perspective"), F.concat_ws(
        "-", start + F.length("header"), start + F.col("chars")))
    turn = F.struct(position.alias("at"), start.alias("start"), mask.alias("mask"),
                    F.concat("header", "content", F.lit(CLOSE)).alias("text"))
    chunk = placed.select("conv_id", "perspective", F.floor(position / CHUNK_TURNS).cast("int").alias("chunk"), turn.alias("t"))
    # a group is one chunk: at most CHUNK_TURNS turns
    grouped = chunk.groupBy("conv_id", "perspective", "chunk").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return grouped.select(
        "conv_id", "perspective", "chunk", F.size("ts").cast("long").alias("n_turns"), F.col("ts")[0]["start"].alias("start"),
        F.array_join("ts.text", "").alias("text"), F.array_join("ts.mask", ",").alias("masks"))
