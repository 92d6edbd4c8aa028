"""Join helpers with explicit size checks.

A side is broadcast only when a count proves it small; otherwise the join
is left to a shuffle (sort-merge or AQE's choice).  Nothing unbounded is
ever pulled to the driver: ``collect_small`` refuses past its limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a dimension side may have to be broadcast (each executor holds a copy).
BROADCAST_MAX_ROWS = 1_000_000


class TooLarge(ValueError):
    pass


def row_count_at_most(df: DataFrame, limit: int) -> int | None:
    """Exact row count if it is <= ``limit``, else None.  A plain count: each task
    sends one number, no rows."""
    n = df.count()
    return n if n <= limit else None


# Above this optimizer size estimate a side is not even counted: it is left to the
# shuffle join, which AQE still turns into a broadcast if the measured side is small.
COUNT_ONLY_BELOW_BYTES = 2 << 30
# What the optimizer says of local rows and the like, whose size it does not know.
UNKNOWN_BYTES = 1 << 62


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job runs)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when its row count is proven <= ``max_rows``; else ``df`` as is.

    A side whose estimated size is already far beyond broadcast range is not
    counted at all (counting would compute it once more), so the check stays
    cheap for large inputs."""
    est = estimated_bytes(df)
    if est is not None and COUNT_ONLY_BELOW_BYTES < est < UNKNOWN_BYTES:
        return df
    return F.broadcast(df) if row_count_at_most(df, max_rows) is not None else df


def collect_small(df: DataFrame, max_rows: int) -> list:
    """Collect a bounded dimension table; raise instead of pulling an unbounded one."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooLarge(f"more than {max_rows} rows; refusing to collect to the driver")
    return rows


def spread_for_python(df: DataFrame) -> DataFrame:
    """Give an Arrow/Python stage at least one partition per core.

    Python stages cost far more per row than JVM expressions, so an input
    with fewer partitions than the cluster's default parallelism (one small
    file, one row group) is spread round-robin first.  Inputs that already
    have enough partitions -- every large scan or topic -- are left as they
    are, so at scale this adds no shuffle.
    """
    if df.isStreaming:
        return df
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- no RDD view (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(want) if have < want else df


# Files that a task reads, if there are enough for so many tasks a core.
PACKED_BYTES, PACKED_TASKS_A_CORE = 32 << 20, 16


def pack_small_files(df: DataFrame) -> DataFrame:
    """Rows of a scan over many small files, in fewer tasks.

    Spark counts 4 MB for each file it opens, so a task gets a few files of some kilobytes
    and is over before it was worth starting.  Here a task gets files of ``PACKED_BYTES``, or
    less while a core has ``PACKED_TASKS_A_CORE`` tasks; a scan with fewer tasks is left as it is.
    """
    size = estimated_bytes(df)
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 -- no SparkContext (e.g. a Spark Connect session): leave as is
        return df
    if size is None or size >= UNKNOWN_BYTES:
        return df
    return df.coalesce(max(PACKED_TASKS_A_CORE * cores, -(-size // PACKED_BYTES)))


def materialize(df: DataFrame) -> DataFrame:
    """Write a (compact) intermediate once to the shared checkpoint folder and
    cut its lineage, so several later uses read it instead of recomputing it
    from the input.  Reliable ``checkpoint`` only, never a local one."""
    from eventide.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
