"""Retry counting, dead-letter routing, inspection and replay.

R1 keeps the source system's counter rule: per message the count before an
attempt is the number of consecutive failures since the last success (or
the last dead-letter hand-off); the attempt whose count reaches the maximum
goes to the dead-letter queue and the counter starts again.  In batch this
is a chunked segmented scan (see ``retry_route``) -- no per-message loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions import columns as C
from eventide.operators.joins import broadcast_if_small, materialize
from eventide.operators.scan import CHUNK_WIDTH

MAX_RETRIES = 3


def retry_route(attempts: DataFrame, key: list[str], attempt: str, failed: str,
                max_retries: int = MAX_RETRIES, chunk_width: int = CHUNK_WIDTH,
                materialize_runs: bool = False) -> DataFrame:
    """R1/P4 over an attempt log -> one row per failed attempt with
    ``retry_count`` (the count before this attempt) and ``to_dlq``.

    The count is the length of the current run of failures (since the last
    success) minus one, taken modulo ``max_retries + 1`` because a hand-off to
    the dead-letter queue restarts it.  The run length is a segmented scan,
    done in chunks of the attempt order so that a hot message is never one
    task: a window per (key, chunk) gives the run inside the chunk, and a
    small per-chunk summary gives the run carried in from earlier chunks.
    The windowed rows feed two branches; ``materialize_runs`` checkpoints them
    so the sort runs once (worth it when sorting costs more than a write, as
    on object stores; on local disks recomputing was faster).
    """
    fail = F.when(F.col(failed), 1).otherwise(0)
    b = attempts.withColumn("_chunk", F.floor(F.col(attempt) / F.lit(chunk_width)).cast("long"))
    w = (Window.partitionBy(*key, "_chunk").orderBy(attempt)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    loc = (b.withColumn("_lf", F.sum(fail).over(w))                                # failures so far in chunk
            .withColumn("_m", F.max(F.when(~F.col(failed), F.col("_lf"))).over(w)))  # ... at its last success
    if materialize_runs:      # the windowed rows feed two branches: sort once, read twice
        loc = materialize(loc)
    summ = loc.groupBy(*key, "_chunk").agg(F.max("_lf").alias("_tot"), F.max("_m").alias("_mlast"))
    wc = Window.partitionBy(*key).orderBy("_chunk")
    upto = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_cum", F.sum("_tot").over(upto))
    last_succ = F.last(F.when(F.col("_mlast").isNotNull(),
                              F.struct((F.col("_tot") - F.col("_mlast")).alias("tail"),
                                       F.col("_cum").alias("cum"))), ignorenulls=True).over(before)
    prev_cum = F.col("_cum") - F.col("_tot")
    carry = summ.select(*key, "_chunk",
                        F.coalesce(last_succ["tail"] + prev_cum - last_succ["cum"], prev_cum)
                        .cast("long").alias("_carry"))
    j = loc.where(F.col(failed)).join(broadcast_if_small(carry), on=[*key, "_chunk"], how="inner")
    run = F.when(F.col("_m").isNull(), F.col("_carry") + F.col("_lf")).otherwise(F.col("_lf") - F.col("_m"))
    count = F.pmod(run - 1, F.lit(max_retries + 1)).cast("long")
    return (j.withColumn("retry_count", count)
             .withColumn("to_dlq", C.should_dlq("retry_count", max_retries))
             .drop("_chunk", "_lf", "_m", "_carry"))


def dlq_inspect(dlq: DataFrame) -> DataFrame:
    """What an operator reads from each dead-letter message."""
    return dlq.select(
        C.header(C.H_ORIGINAL_TOPIC).alias("original_topic"),
        C.header(C.H_ERROR_TYPE).alias("error_type"),
        C.header(C.H_ERROR_MESSAGE).alias("error_message"),
        F.col("key").cast("string").alias("key"),
        F.col("offset"))


def dlq_replay(dlq: DataFrame, dry_run: bool = False) -> DataFrame:
    """Messages whose original topic is known go back there as (topic, key, value),
    without the error headers.  ``dry_run`` only counts them."""
    topic = C.header(C.H_ORIGINAL_TOPIC)
    out = dlq.where(topic != "").select(topic.alias("topic"), "key", "value", "offset")
    if dry_run:
        return out.select(F.count(F.lit(1)).alias("would_replay"))
    return out
