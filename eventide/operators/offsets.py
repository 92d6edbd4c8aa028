"""Broker coordinates as the identity of a delivery (K6).

An event without an id cannot be recognised by its content, but its message
can: (topic, partition, offset) names one delivery.  A job that stores
messages keeps, per run, the ranges of offsets that it has committed.  Ranges
merge as a topic is read on, so they count the gaps of what was read, not the
messages.  A re-delivered message is one inside a committed range.

The ranges lie beside the events, below a folder that readers of the events
skip: ``<events>/_offsets/run=<run>/batch=<n>/``.  Each batch writes all ranges
of its run so far; older ones are dropped once no restart can need them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.operators.joins import broadcast_if_small

OFFSETS_DIR = "_offsets"
COORDINATES = ("topic", "partition", "offset")
RANGES = "topic string, partition int, first long, last long"
# Offsets whose order one task settles, and those that one join key holds.
CHUNK = 1 << 16
BUCKET = 1 << 20


def known(messages: DataFrame) -> DataFrame:
    """The coordinates of the messages that have them."""
    return messages.select(*COORDINATES).where("topic is not null and partition is not null and offset is not null")


def _islands(ranges: DataFrame) -> DataFrame:
    """The ranges of each (topic, partition, _chunk) merged where they meet; a null chunk is one like any other."""
    place = ["topic", "partition", "_chunk"]
    w = Window.partitionBy(*place).orderBy("first", "last")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    island = F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranges.withColumn("_starts", starts).withColumn("_island", island).groupBy(*place, "_island")
                  .agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island"))


def _join_chunks(pieces: DataFrame, chunk: int) -> DataFrame:
    """Merge ranges across chunks, within which they are merged already: only
    those at an edge of their chunk, two a chunk at most, can go on in another."""
    edge = (F.pmod("first", F.lit(chunk)) == 0) | (F.pmod("last", F.lit(chunk)) == chunk - 1)
    return _islands(pieces.withColumn("_chunk", F.when(~edge, F.col("_chunk")))).drop("_chunk")


def merge_ranges(ranges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The fewest ranges (topic, partition, first, last) that cover the same offsets.

    They are cut at multiples of ``chunk`` and merged within these chunks, so a
    partition with most of the ranges is not one task."""
    at = lambda c: F.floor(F.col(c) / F.lit(chunk)).cast("long")
    cut = ranges.select("topic", "partition", "first", "last", F.explode(F.sequence(at("first"), at("last"))).alias("_chunk"))
    begin = F.col("_chunk") * chunk
    return _join_chunks(_islands(cut.withColumn("first", F.greatest("first", begin))
                                    .withColumn("last", F.least("last", begin + (chunk - 1)))), chunk)


def offset_ranges(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The ranges of consecutive offsets among ``messages``.

    Offsets are ordered within chunks of ``chunk``, so a partition with most
    of the messages is not one task; only ranges at the edges of chunks are
    merged per partition."""
    w = Window.partitionBy("topic", "partition", "_chunk").orderBy("offset")
    pieces = (known(messages).distinct().withColumn("_chunk", F.floor(F.col("offset") / F.lit(chunk)).cast("long"))
              .withColumn("_island", F.col("offset") - F.row_number().over(w))
              .groupBy("topic", "partition", "_chunk", "_island")
              .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("_island"))
    return _join_chunks(pieces, chunk)


def offset_spans(messages: DataFrame) -> DataFrame:
    """One range per partition, for a source that reads offsets in order: a gap
    in what it delivered (a compacted or a transaction's message) holds nothing."""
    return known(messages).groupBy("topic", "partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))


def drop_covered(messages: DataFrame, ranges: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``messages`` whose offset is in none of the disjoint ``ranges``; a message without coordinates stays.

    Only the parts of ranges between the batch's own first and last offsets
    count, cut at multiples of ``bucket``: an equi-join on the bucket, spread
    over the buckets of a hot partition."""
    spans = known(messages).groupBy("topic", "partition").agg(F.min("offset").alias("_lo"), F.max("offset").alias("_hi"))
    near = (ranges.join(broadcast_if_small(spans), ["topic", "partition"]).where("first <= _hi and last >= _lo")
                  .select("topic", "partition", F.greatest("first", "_lo").alias("_first"), F.least("last", "_hi").alias("_last")))
    at = lambda c: F.floor(F.col(c) / F.lit(bucket)).cast("long")
    near = near.withColumn("_bucket", F.explode(F.sequence(at("_first"), at("_last"))))
    near = near.select(*[F.col(c).alias(f"_r{c}") for c in ("topic", "partition", "_bucket")], "_first", "_last")
    placed = messages.withColumn("_bucket", at("offset"))
    same = [placed["topic"] == near["_rtopic"], placed["partition"] == near["_rpartition"], placed["_bucket"] == near["_r_bucket"],
            placed["offset"].between(near["_first"], near["_last"])]
    return placed.join(broadcast_if_small(near), same, "left_anti").drop("_bucket")


# --- the manifest --------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str, run: str) -> list[int]:
    """Batches of ``run`` whose ranges are there whole (one short listing)."""
    fs, p = _fs(spark, f"{root}/run={run}")
    if not fs.exists(p):
        return []
    names = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(p)]
    make = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n.partition("=")[2]) for at, n in names if n.startswith("batch=") and fs.exists(make(at, "_SUCCESS")))


def _snapshot(spark: SparkSession, root: str, run: str, batch: int) -> DataFrame:
    return spark.read.schema(RANGES).parquet(f"{root}/run={run}/batch={batch:010d}")


def _last_before(spark: SparkSession, root: str, run: str, batch: int | None = None) -> DataFrame | None:
    there = [n for n in _numbers(spark, root, run) if batch is None or n < batch]
    return _snapshot(spark, root, run, there[-1]) if there else None


def committed(spark: SparkSession, root: str, run: str, batch: int) -> DataFrame | None:
    """The ranges that are stored: by all other runs, and by ``run`` before its
    ``batch`` (a batch that runs again must not see itself).  None if there are none."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return None
    runs = [s.getPath().getName().partition("=")[2] for s in fs.listStatus(p) if s.getPath().getName().startswith("run=")]
    found = [f for r in sorted(runs) if (f := _last_before(spark, root, r, batch if r == run else None)) is not None]
    if not found:
        return None
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return merge_ranges(every)


def commit(spark: SparkSession, root: str, run: str, batch: int, ranges: DataFrame) -> None:
    """Add the ``ranges`` of ``batch`` to those of its run.  The ones before are
    kept for a restart that runs this batch again; those before them go."""
    before = _last_before(spark, root, run, batch)
    every = ranges if before is None else merge_ranges(before.unionByName(ranges))
    every.write.mode("overwrite").parquet(f"{root}/run={run}/batch={batch:010d}")
    there = [n for n in _numbers(spark, root, run) if n < batch]
    for old in there[:-1]:
        fs, p = _fs(spark, f"{root}/run={run}/batch={old:010d}")
        fs.delete(p, True)
