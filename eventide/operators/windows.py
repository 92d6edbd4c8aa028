"""Tumbling event-time window counts.

One code path serves batch and Structured Streaming: ``F.window`` on the
event-time column is what lets a streaming aggregate close windows by
watermark.  The aggregate is Spark's own partial/final HashAggregate
(A3's "incremental count with merge"), so a hot key is pre-counted on the
map side and the shuffle carries one row per (window, key) per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.columns import event_time

WINDOW = "1 minute"
WATERMARK = "5 seconds"


def with_event_time(df: DataFrame, ts_col: str = "timestamp", out: str = "event_time") -> DataFrame:
    """Epoch seconds -> zoned TimestampType event time."""
    return df.withColumn(out, event_time(ts_col))


def _bounds(win_col: str = "window"):
    return [F.unix_millis(F.col(f"{win_col}.start")).alias("window_start"),
            F.unix_millis(F.col(f"{win_col}.end")).alias("window_end")]


def window_counts(df: DataFrame, key: str, count_name: str = "count",
                  width: str = WINDOW, ts_col: str = "timestamp",
                  watermark: str | None = None) -> DataFrame:
    """Count rows per tumbling window and ``key`` -> (window_start, window_end, key, count).

    Window bounds are epoch milliseconds (D12); a window is ``[start, end)``.
    ``watermark`` is only needed for streams (T1).
    """
    ev = with_event_time(df.select(key, ts_col), ts_col)
    if watermark:
        ev = ev.withWatermark("event_time", watermark)
    agg = ev.groupBy(F.window("event_time", width).alias("window"), key) \
            .agg(F.count(F.lit(1)).alias(count_name))
    return agg.select(*_bounds(), F.col(key), F.col(count_name))


def window_type_counts(df: DataFrame, **kw) -> DataFrame:
    """A1: events per type per minute."""
    return window_counts(df, "type", "count", **kw)


def window_wiki_counts(df: DataFrame, **kw) -> DataFrame:
    """A2: edits per wiki per minute."""
    return window_counts(df, "wiki", "edits", **kw)


def window_counts_union(df: DataFrame, width: str = WINDOW, ts_col: str = "timestamp",
                        watermark: str | None = None) -> DataFrame:
    """T5: both counts from one scan and one aggregate.

    Each event is exploded into a (dim, key) pair per dimension, so the two
    streams of the original graph become one shuffle on (window, dim, key).
    """
    ev = with_event_time(df.select("type", "wiki", ts_col), ts_col)
    if watermark:
        ev = ev.withWatermark("event_time", watermark)
    pairs = ev.select(
        "event_time",
        F.explode(F.array(
            F.struct(F.lit("type").alias("dim"), F.col("type").alias("key")),
            F.struct(F.lit("wiki").alias("dim"), F.col("wiki").alias("key")),
        )).alias("p"))
    agg = (pairs.groupBy(F.window("event_time", width).alias("window"),
                         F.col("p.dim").alias("dim"), F.col("p.key").alias("key"))
           .agg(F.count(F.lit(1)).alias("count")))
    return agg.select(*_bounds(), "dim", "key", "count")


def top_per_window(counts: DataFrame, k: int = 3, key: str = "wiki",
                   value: str = "edits") -> DataFrame:
    """A4: the ``k`` keys with the highest count per window (ties by key).

    Runs on the aggregated table, which holds one row per (window, key), so
    partitioning the ranking by window keeps every group small.
    """
    w = Window.partitionBy("window_start").orderBy(F.col(value).desc(), F.col(key))
    return (counts.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k))


def aggregate_json(counts: DataFrame, key: str, value: str) -> DataFrame:
    """K8: one JSON line per result, ``{"window":{"start","end"},key,value}``."""
    return counts.select(F.to_json(F.struct(
        F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
        F.col(key), F.col(value))).alias("value"))


def union_json(union_counts: DataFrame) -> DataFrame:
    """K8 over T5's output: the type lines use ``count``, the wiki lines ``edits``."""
    win = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window")
    type_line = F.to_json(F.struct(win, F.col("key").alias("type"), F.col("count").alias("count")))
    wiki_line = F.to_json(F.struct(win, F.col("key").alias("wiki"), F.col("count").alias("edits")))
    return union_counts.select(
        F.when(F.col("dim") == "type", type_line).otherwise(wiki_line).alias("value"))
