"""Multi-party perspective rotation of dialogues.

For every participant of a dialogue, the whole dialogue is rendered with that
participant as the assistant and everyone else as a named user; only the
assistant's own words are to be trained on.

A rendering is kept as one row per turn (header, text, footer, character
offsets, loss mask range), which never puts a dialogue into one row: a
dialogue may hold a third of all rows.  Offsets are running sums: turns are
numbered and summed inside ranges of ``RANGE`` turn numbers first, and the
ranges' totals, far fewer, give each range its start.

Defined results: rows without a dialogue id are left out; a null speaker is
the participant ``unknown``; a null text is an empty turn; rows of one turn
number are ordered by speaker and text, and repeated rows each stay; a null
turn number comes first; a speaker named ``system`` is an instruction, not a
participant, unless nobody else speaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

RANGE = 256
INSTRUCTION, UNKNOWN = "system", "unknown"
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text") -> DataFrame:
    """One row per dialogue, perspective and turn.

    conv_id, perspective, position (from 0), turn, speaker, header, text,
    footer, start and end of the rendered turn, mask_start and mask_end of
    what is trained on (null where nothing is).
    """
    said = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(speaker, F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(text, F.lit("")).alias("text"), F.expr(f"`{turn}` div {RANGE}").alias("part"))
    order = Window.partitionBy("conv_id", "part").orderBy("turn", "speaker", "text")
    said = said.withColumn("place", F.row_number().over(order) - 1)
    # one row for each participant: who speaks besides the instructions, or the instructions if nobody does
    people = said.groupBy("conv_id", "speaker").agg(F.count("*").alias("own"))
    others = people.groupBy("conv_id").agg(F.max(F.col("speaker") != INSTRUCTION).alias("others"))
    people = (people.join(others, "conv_id").where((F.col("speaker") != INSTRUCTION) | ~F.col("others"))
              .select("conv_id", F.col("speaker").alias("perspective")))
    seen = said.join(people, "conv_id")
    own = F.col("speaker") == F.col("perspective")
    role = (F.when(own, F.lit("assistant")).when(F.col("speaker") == INSTRUCTION, F.lit(INSTRUCTION))
            .otherwise(F.concat(F.lit("user name="), "speaker")))
    seen = (seen.withColumn("header", F.concat(F.lit(OPEN), role, F.lit(MIDDLE))).withColumn("footer", F.lit(CLOSE))
            .withColumn("size", F.length("header") + F.length("text") + F.length("footer")))
    inside = Window.partitionBy("conv_id", "perspective", "part").orderBy("place")
    seen = seen.withColumn("upto", F.sum("size").over(inside))
    totals = seen.groupBy("conv_id", "perspective", "part").agg(F.sum("size").alias("chars"), F.count("*").alias("rows"))
    earlier = (Window.partitionBy("conv_id", "perspective").orderBy(F.asc_nulls_first("part"))
               .rowsBetween(Window.unboundedPreceding, -1))
    begun = totals.select("conv_id", "perspective", "part",
                          F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("char0"),
                          F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("row0"))
    seen = seen.withColumn("key", F.struct("conv_id", "perspective", F.coalesce("part", F.lit(0)), F.col("part").isNull()))
    begun = begun.select(F.struct("conv_id", "perspective", F.coalesce("part", F.lit(0)), F.col("part").isNull())
                         .alias("key"), "char0", "row0")
    rows = seen.join(begun, "key").withColumn("end", F.col("char0") + F.col("upto"))
    own, text_end = F.col("speaker") == F.col("perspective"), F.col("end") - F.length("footer")
    return rows.select(
        "conv_id", "perspective", (F.col("row0") + F.col("place")).alias("position"), "turn", "speaker", "header",
        "text", "footer", (F.col("end") - F.col("size")).alias("start"), "end",
        F.when(own, text_end - F.length("text")).alias("mask_start"), F.when(own, F.col("end")).alias("mask_end"))


def rendered(turns: DataFrame) -> DataFrame:
    """The rotated turns with their rendered text and a 0/1 mask string of the same length."""
    rows = rotate(turns)
    trained = F.col("mask_start").isNotNull()
    body = F.length("text") + F.length("footer")
    return (rows.withColumn("rendered", F.concat("header", "text", "footer"))
            .withColumn("mask", F.concat(F.repeat(F.lit("0"), F.length("header")),
                                         F.when(trained, F.repeat(F.lit("1"), body))
                                         .otherwise(F.repeat(F.lit("0"), body)))))


def sql() -> str:
    """``rendered`` as DuckDB SQL over ``conversations``."""
    return f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS said
              FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said) - 1 AS position FROM said),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said),
others AS (SELECT conv_id, bool_or(perspective <> '{INSTRUCTION}') AS others FROM people GROUP BY conv_id),
seen AS (SELECT placed.*, perspective, speaker = perspective AS own,
                '<|' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = '{INSTRUCTION}' THEN speaker
                             ELSE 'user name=' || speaker END || '|>' || chr(10) AS header,
                said || '<|end|>' || chr(10) AS body
         FROM placed JOIN people USING (conv_id) JOIN others USING (conv_id)
         WHERE perspective <> '{INSTRUCTION}' OR NOT others),
ends AS (SELECT *, CAST(sum(length(header) + length(body))
                        OVER (PARTITION BY conv_id, perspective ORDER BY position) AS BIGINT) AS upto FROM seen)
SELECT conv_id, perspective, position, turn, header || body AS rendered,
       repeat('0', length(header)) || repeat(CASE WHEN own THEN '1' ELSE '0' END, length(body)) AS mask,
       upto - length(header) - length(body) AS "start", upto AS "end",
       CASE WHEN own THEN upto - length(body) END AS mask_start, CASE WHEN own THEN upto END AS mask_end
FROM ends"""
