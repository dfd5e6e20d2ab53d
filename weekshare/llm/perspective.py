"""Chat formatting by perspective rotation (operator 10), DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered once
with that speaker as the assistant and all others as named users. System
turns stay system turns and are no participants. The result has one row per
conversation, perspective and turn: the rendered segment, its code-point
range in that perspective's dialogue, and the range a trainer learns from
(the assistant's words and their end mark). Concatenating ``segment`` by
``position`` gives the dialogue, whatever its length; no task ever holds a
whole conversation.

Plan: turns are cut into blocks of ``BLOCK`` turn numbers. A small table of
(conversation, block, participant) sums gives every block its first position
and offset per perspective. The turns meet it in one join keyed by
conversation and block, and the running sums inside a block reuse that
partitioning, so texts are shuffled once and one conversation holding a third
of all rows is spread over its blocks if its turn numbers differ. Rows with the
same few turn numbers, or none, share a block, which one task per perspective
sorts (and spills) alone; all rows with a null ``conv_id`` and no turn are one.

Defined cases: a null or blank role is the speaker ``unknown``; a null text is
empty; turns sort by turn (null first), role, text; repeated rows are
rendered each; a conversation with no participant has no rows; a null
``conv_id`` is one conversation; the marks ``<|`` inside texts are broken up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table

BLOCK = 64          # turn numbers per block
# The rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    t = turns.selectExpr(
        f"`{conv_col}` AS conv_id", f"coalesce('=' || cast(`{conv_col}` AS string), '') AS conv",
        f"`{turn_col}` AS turn",
        f"coalesce(nullif(trim(`{role_col}`), ''), 'unknown') AS speaker",
        f"replace(coalesce(`{text_col}`, ''), '<|', '< |') AS body")
    t = t.selectExpr(
        "conv_id", "conv", "turn", "speaker", "body",
        f"coalesce(cast(floor(turn / {BLOCK}) AS long), -1) AS block",
        "lower(speaker) = 'system' AS is_system",
        "regexp_replace(speaker, '[^A-Za-z0-9_-]', '_') AS name")
    user = f"'{OPEN}user name=' || name || '\n'"
    other = f"CASE WHEN is_system THEN '{OPEN}system\n' ELSE {user} END"
    own = f"'{OPEN}assistant\n'"

    sums = (t.selectExpr("conv", "block", "speaker", "is_system",
                         f"length({other}) + length(body) + {len(CLOSE)} AS width",
                         f"length({own}) - length({user}) AS gain")
            .groupBy("conv", "block", "speaker", "is_system", "gain")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("width")))
    blocks = sums.groupBy("conv", "block").agg(F.sum("n").alias("n"), F.sum("width").alias("width"))
    people = (sums.where("NOT is_system").groupBy("conv", "speaker")
              .agg(F.first("gain").alias("gain")).withColumnRenamed("speaker", "perspective"))
    spoken = sums.where("NOT is_system").selectExpr(
        "conv", "block", "speaker AS perspective", "n AS own_n")
    before = (Window.partitionBy("conv", "perspective").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (blocks.join(people, "conv")
              .join(spoken, ["conv", "block", "perspective"], "left")
              .withColumn("own_n", F.coalesce("own_n", F.lit(0)))
              .select("conv", "block", "perspective",
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("block_position"),
                      F.coalesce(F.sum(F.expr("width + gain * own_n")).over(before), F.lit(0))
                      .alias("block_start")))
    rows = (t.join(starts, ["conv", "block"])
            .withColumn("trained", F.expr("NOT is_system AND speaker = perspective"))
            .withColumn("head", F.expr(f"CASE WHEN trained THEN {own} ELSE {other} END"))
            .withColumn("n_chars", F.expr(f"length(head) + length(body) + {len(CLOSE)}").cast("long")))
    inside = (Window.partitionBy("conv", "block", "perspective")
              .orderBy(F.asc_nulls_first("turn"), "speaker", "body")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (rows.withColumn("position", F.col("block_position") + F.count(F.lit(1)).over(inside) - 1)
            .withColumn("start", F.col("block_start") + F.sum("n_chars").over(inside) - F.col("n_chars")))
    return rows.selectExpr(
        "conv_id", "perspective", "position", "turn", "speaker",
        "CASE WHEN trained THEN 'assistant' WHEN is_system THEN 'system' ELSE 'user' END AS chat_role",
        f"head || body || '{CLOSE}' AS segment", "start", "start + n_chars AS stop",
        "trained",
        "CASE WHEN trained THEN start + length(head) END AS mask_start",
        "CASE WHEN trained THEN start + n_chars - 1 END AS mask_stop")


def op10_perspective_rotation(spark, sf_dir: str) -> DataFrame:
    return rotate_perspectives(read_table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role, ' '), ''), 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE lower(speaker) <> 'system'),
r AS (
  SELECT t.conv_id, perspective, turn, speaker, body,
         lower(speaker) <> 'system' AND speaker = perspective AS trained,
         CASE WHEN lower(speaker) = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN speaker = perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || regexp_replace(speaker, '[^A-Za-z0-9_-]', '_', 'g') || chr(10)
         END AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM r),
o AS (
  SELECT *, CAST(row_number() OVER w - 1 AS BIGINT) AS position,
         CAST(sum(length(segment)) OVER w - length(segment) AS BIGINT) AS start
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective
                      ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, speaker,
       CASE WHEN trained THEN 'assistant' WHEN lower(speaker) = 'system' THEN 'system'
            ELSE 'user' END AS chat_role,
       segment, start, start + length(segment) AS stop, trained,
       CASE WHEN trained THEN start + length(head) END AS mask_start,
       CASE WHEN trained THEN start + length(segment) - 1 END AS mask_stop
FROM o
"""
