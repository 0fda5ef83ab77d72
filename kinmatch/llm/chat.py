"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered once, with that participant as
``assistant`` and all others as users that carry their name; system turns stay system turns. A row
is one rendered segment; the segments of a (dialogue, perspective) in order of ``position`` are the
text. ``char_start`` and ``char_end`` place the segment in that text, ``loss_start`` and
``loss_end`` the code points to train on: the assistant's words and the end mark after them.

A dialogue of any length is laid out in blocks of turns: positions and offsets are counted inside
the block, then the blocks' totals are summed, so no task needs a whole dialogue.

Defined results: order is by turn (null first), then speaker, then text; equal rows are all kept;
a null text is an empty message; a null speaker is a participant named ``unknown``; rows with a
null dialogue id form one dialogue; a dialogue of system turns only has no participant and gives no
row; an empty table gives none. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
BLOCK_TURNS = 64


def _header(speaker: Column, own: Column) -> Column:
    role = F.when(own, F.lit("assistant")).when(speaker == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), speaker))
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def perspectives(messages: DataFrame, *, dialogue: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, perspective, position, turn, speaker, segment, char_start, char_end, loss_start, loss_end``.

    Where a block begins follows from counts by (dialogue, block, speaker) alone: a participant's
    own messages are longer or shorter by the difference of the two headers. Texts are shuffled
    once, to their blocks.
    """
    said = messages.select(
        F.col(dialogue).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    ).withColumns(
        {
            "k": F.coalesce(F.concat(F.lit("id "), F.col("conv_id").cast("string")), F.lit("null")),
            "block": F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(2**62))).cast("long"),
        }
    )
    tail = F.length(F.lit(f"{CLOSE}\n"))
    by_speaker = said.groupBy("k", "block", "speaker").agg(F.count(F.lit(1)).alias("own"), F.sum(F.length(_header(F.col("speaker"), F.lit(False))) + F.length("body") + tail).alias("chars"))
    people = by_speaker.filter(F.col("speaker") != SYSTEM).select("k", F.col("speaker").alias("perspective")).distinct()
    blocks = by_speaker.groupBy("k", "block").agg(F.sum("own").alias("n"), F.sum("chars").alias("chars"))
    own = by_speaker.select("k", "block", F.col("speaker").alias("perspective"), "own")
    views = blocks.join(people, "k").join(own, ["k", "block", "perspective"], "left")
    before = Window.partitionBy("k", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    change = F.length(_header(F.col("perspective"), F.lit(True))) - F.length(_header(F.col("perspective"), F.lit(False)))
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    bases = views.select("k", "block", F.struct("perspective", earlier("n").alias("n0"), (earlier("chars") + change * earlier(F.coalesce("own", F.lit(0)))).alias("chars0")).alias("base"))
    bases = bases.groupBy("k", "block").agg(F.collect_list("base").alias("bases"))
    seen = said.join(bases, ["k", "block"]).withColumn("base", F.explode("bases")).select("k", "block", "conv_id", "turn", "speaker", "body", "base.*")
    is_own = F.col("speaker") == F.col("perspective")
    seen = seen.withColumn("own", is_own).withColumn("header", _header(F.col("speaker"), F.col("own"))).withColumn("segment", F.concat("header", "body", F.lit(f"{CLOSE}\n")))
    inside = Window.partitionBy("k", "block", "perspective").orderBy(F.col("turn").asc_nulls_first(), "speaker", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = seen.withColumns({"at": F.count(F.lit(1)).over(inside), "upto": F.sum(F.length("segment")).over(inside)})
    end = F.col("chars0") + F.col("upto")
    laid = laid.withColumns({"char_end": end.cast("long"), "char_start": (end - F.length("segment")).cast("long")})
    return laid.select(
        "conv_id",
        "perspective",
        (F.col("n0") + F.col("at")).cast("long").alias("position"),
        "turn",
        "speaker",
        "segment",
        "char_start",
        "char_end",
        F.when(F.col("own"), F.col("char_start") + F.length("header")).alias("loss_start"),
        F.when(F.col("own"), F.col("char_end") - 1).alias("loss_end"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """One row a (dialogue, perspective): ``text`` and the ranges to train on. For dialogues that fit a row."""
    parts = F.array_sort(F.collect_list(F.struct("position", "segment", "loss_start", "loss_end")))
    spans = F.transform(F.filter("parts", lambda x: x["loss_start"].isNotNull()), lambda x: F.struct(x["loss_start"].alias("start"), x["loss_end"].alias("end")))
    return segments.groupBy("conv_id", "perspective").agg(parts.alias("parts")).select("conv_id", "perspective", F.array_join(F.transform("parts", lambda x: x["segment"]), "").alias("text"), spans.alias("loss"))


def chat_query(spark, sf_dir: str) -> DataFrame:
    """All conversations, from every participant's side."""
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


CHAT_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
s AS (
  SELECT m.conv_id, perspective, turn, speaker, body, speaker = perspective AS own,
    '{OPEN}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user name=' || speaker END
      || chr(10) AS header
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
g AS (SELECT *, header || body || '{CLOSE}' || chr(10) AS segment FROM s),
o AS (
  SELECT *, row_number() OVER w AS position, sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
  FROM g WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body))
SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, turn, speaker, segment,
  CAST(e - length(segment) AS BIGINT) AS char_start, CAST(e AS BIGINT) AS char_end,
  CASE WHEN own THEN CAST(e - length(segment) + length(header) AS BIGINT) END AS loss_start,
  CASE WHEN own THEN CAST(e - 1 AS BIGINT) END AS loss_end
FROM o
"""
