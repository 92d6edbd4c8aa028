"""Chat formatting with cumulative snapshots collapsed.

Logs often hold a conversation several times, each time with some more turns.
Each turn gets a rolling hash of all turns up to it: sums of two 64-bit
hashes per turn that cover its place, role and text, so a prefix is known by
its length and two sums.  A conversation whose whole hash is a proper prefix
of another one goes by an anti-join; of equal conversations the one with the
smallest id stays.  What is left is rendered turn by turn.

Running sums are made inside range partitions of (conversation, turn), and
what earlier partitions hold of the same conversation is added afterwards, so
one conversation may be spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize

TURNS_PER_PARTITION = 1 << 20
KEYS = ["n", "h1", "h2"]


def _cleaned(turns: DataFrame) -> DataFrame:
    return (turns.where("conv_id is not null")
                 .select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
                 .distinct())


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Each distinct turn with its place ``n`` (from 1) in its conversation
    and the rolling hashes ``h1``, ``h2`` of the turns up to it; ``o1``,
    ``o2`` are the turn's own part."""
    spark = turns.sparkSession
    clean = materialize(_cleaned(turns), "chat-turns")
    order = ["conv_id", "turn", "role", "text"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-clean.count() // TURNS_PER_PARTITION))
    # Written once: the range bounds are sampled, and both uses below must see the same partitions.
    dealt = materialize(clean.repartitionByRange(parts, "conv_id", "turn", F.xxhash64("role", "text"))
                             .withColumn("part", F.spark_partition_id()), "chat-ranges")
    # Order inside a conversation: turn, then the hash that the ranges use, then role and text.
    local = Window.partitionBy("part", "conv_id").orderBy("turn", F.xxhash64("role", "text"), "role", "text")
    ranked = dealt.withColumn("k", F.row_number().over(local))
    totals = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("c0", F.sum("c").over(before)).where("c0 > 0").select("conv_id", "part", "c0")
    # A conversation has an offset only where it crosses a partition's edge: at most one row per partition.
    placed = ranked.join(F.broadcast(offsets), ["conv_id", "part"], "left") \
                   .withColumn("n", F.col("k") + F.coalesce("c0", F.lit(0)))
    own = lambda salt: F.xxhash64(F.lit(salt), "n", "role", "text").cast("decimal(38,0)")
    placed = materialize(placed.select(*order, "part", "n", own("a").alias("o1"), own("b").alias("o2")), "chat-places")
    through = Window.partitionBy("part", "conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy("conv_id", "part").agg(F.sum("o1").alias("c1"), F.sum("o2").alias("c2"))
    offsets = sums.select("conv_id", "part", F.sum("c1").over(before).alias("p1"), F.sum("c2").over(before).alias("p2")) \
                  .where("p1 is not null")
    zero = F.lit(0).cast("decimal(38,0)")
    return (placed.withColumn("l1", F.sum("o1").over(through)).withColumn("l2", F.sum("o2").over(through))
                  .join(F.broadcast(offsets), ["conv_id", "part"], "left")
                  .select(*order, "n", "o1", "o2", (F.col("l1") + F.coalesce("p1", zero)).cast("decimal(38,0)").alias("h1"),
                          (F.col("l2") + F.coalesce("p2", zero)).cast("decimal(38,0)").alias("h2")))


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv_id, n): conversations that are no proper prefix of another one,
    the smallest id of those that are equal."""
    ends = hashed.groupBy("conv_id").agg(F.max("n").alias("n"), F.max_by(F.struct("h1", "h2"), "n").alias("h")) \
                 .select("conv_id", "n", "h.h1", "h.h2")
    one = ends.groupBy(*KEYS).agg(F.min("conv_id").alias("conv_id"))
    # The state one turn earlier is a proper prefix of the same conversation.
    earlier = hashed.where("n > 1").select((F.col("n") - 1).alias("n"),
                                           (F.col("h1") - F.col("o1")).cast("decimal(38,0)").alias("h1"),
                                           (F.col("h2") - F.col("o2")).cast("decimal(38,0)").alias("h2")).distinct()
    return one.join(earlier, KEYS, "left_anti").select("conv_id", "n")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per turn of each maximal conversation: conv_id, n_turns,
    position (from 1), role, and ``rendered``, the turn between its marks; a
    conversation's text is its rows joined in order of position.

    Turns are ordered by ``turn`` (null first); exact repeats of a row count
    once, and different rows with one turn number follow in a fixed order.
    Null roles and texts count as empty.  Turns without conversation id belong
    to no conversation and are left out.  Extra columns are not looked at.
    """
    hashed = materialize(prefix_hashes(turns), "chat-hashes")
    kept = maximal_conversations(hashed).withColumnRenamed("n", "n_turns")
    rendered = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    return hashed.join(kept, "conv_id").select(
        "conv_id", F.col("n_turns").cast("int").alias("n_turns"), F.col("n").cast("int").alias("position"), "role",
        rendered.alias("rendered"))


# The same in SQL for tables without repeated turn numbers: exact turn lists in place of hashes.
FORMAT_SQL = """
WITH t AS (
  SELECT conv_id, role, text, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS position
  FROM conversations),
p AS (
  SELECT conv_id, position, string_agg(md5(coalesce(role, '') || chr(31) || coalesce(text, '')), ',')
    OVER (PARTITION BY conv_id ORDER BY position) AS prefix FROM t),
e AS (SELECT conv_id, max(position) AS n_turns, arg_max(prefix, position) AS prefix FROM p GROUP BY conv_id),
kept AS (
  SELECT min(conv_id) AS conv_id, n_turns FROM e
  WHERE prefix NOT IN (SELECT p.prefix FROM p JOIN e USING (conv_id) WHERE p.position < e.n_turns)
  GROUP BY prefix, n_turns)
SELECT conv_id, n_turns, position, coalesce(role, '') AS role,
  '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
FROM t JOIN kept USING (conv_id)
"""
