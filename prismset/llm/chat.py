"""Chat formatting by multi-party perspective rotation.

Every participant of a dialogue is made the assistant once; the other speakers
are named users, system turns stay system turns. The result has one row per
perspective and turn with the rendered segment, its place in the rendered
dialogue and the span that counts for training, so a dialogue of any length is
never gathered in one row or task. Only DataFrame and SQL functions are used.

Places are prefix sums in two levels: rows are dealt out by range of (dialogue,
turn, ...), summed within a range, and the totals of a dialogue's ranges are
summed before that. A dialogue with a third of all rows spans many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prismset.llm.common import materialize
from prismset.session import table

SYSTEM = "system"
NOBODY = "unknown"
END = "<|end|>\n"


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system: str = SYSTEM) -> DataFrame:
    """One row per dialogue, perspective and turn.

    Columns: conv_id, perspective, position (from 0), turn, speaker, role,
    segment, start, stop, mask_start, mask_stop, trained. Offsets count code
    points in the dialogue as rendered for that perspective; the mask span covers
    the perspective's own words with their end mark and is empty (at ``stop``)
    elsewhere. The segments in order of position, concatenated, are the dialogue.

    Turns are ordered by turn (null last), speaker, text; repeated rows are
    repeated turns. A null role speaks as ``unknown``, a null text is empty, rows
    with a null dialogue id form one dialogue, and a dialogue of system turns
    only has no perspective and gives no row. ``<|`` in texts and names becomes
    ``< |``, so that no text can forge a mark.
    """
    plain = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        plain(F.coalesce(F.col(role_col).cast("string"), F.lit(NOBODY))).alias("speaker"),
        plain(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
    )
    order = [F.col("turn").isNull(), F.col("turn"), F.col("speaker"), F.col("text")]
    dealt = materialize(
        rows.repartitionByRange(n, F.col("conv_id"), *order, F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()),
        "turns",
    )
    people = dealt.where(F.col("speaker") != system).select(F.col("conv_id").alias("conv"), F.col("speaker").alias("perspective")).distinct()
    said = dealt.join(people, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    own = F.col("speaker") == F.col("perspective")
    said = said.withColumn("role", F.when(F.col("speaker") == system, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.lit("user")))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.when(F.col("role") == "user", F.concat(F.col("speaker"), F.lit(": "))).otherwise(F.lit("")))
    said = said.withColumn("head", F.length(head).cast("long")).withColumn("segment", F.concat(head, F.col("text"), F.lit(END))).withColumn("size", F.length("segment").cast("long"))
    within = W.partitionBy("conv_id", "perspective", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    said = said.withColumn("place", F.count("*").over(within) - 1).withColumn("to", F.sum("size").over(within))
    before = W.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = said.groupBy("conv_id", "perspective", "part").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    parts = parts.select(
        F.col("conv_id").alias("c"),
        F.col("perspective").alias("p"),
        F.col("part").alias("k"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"),
    )
    out = said.join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("part") == F.col("k")))
    stop = F.col("s0") + F.col("to")
    trained = F.col("role") == "assistant"
    return out.select(
        "conv_id",
        "perspective",
        (F.col("n0") + F.col("place")).alias("position"),
        "turn",
        "speaker",
        "role",
        "segment",
        (stop - F.col("size")).alias("start"),
        stop.alias("stop"),
        F.when(trained, stop - F.col("size") + F.col("head")).otherwise(stop).alias("mask_start"),
        stop.alias("mask_stop"),
        trained.alias("trained"),
    )


def op4_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` from the perspective of each participant."""
    return rotate(table(spark, sf_dir, "conversations"))


OP4_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
s AS (
  SELECT r.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|' || role || '|>' || chr(10) || CASE WHEN role = 'user' THEN speaker || ': ' ELSE '' END AS head FROM s),
g AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM h),
o AS (
  SELECT *, CAST(row_number() OVER w - 1 AS BIGINT) AS position, CAST(sum(length(segment)) OVER w AS BIGINT) AS stop FROM g
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn IS NULL, turn, speaker, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, speaker, role, segment, stop - length(segment) AS start, stop,
       CASE WHEN role = 'assistant' THEN stop - length(segment) + length(head) ELSE stop END AS mask_start, stop AS mask_stop, role = 'assistant' AS trained
FROM o
"""
