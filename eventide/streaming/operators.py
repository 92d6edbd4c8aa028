"""Stateful streaming operators (T1-T7, R1 streaming form, M9)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.columns import event_time

DEDUP_WATERMARK = "10 minutes"


def dedup_stream(df: DataFrame, watermark: str = DEDUP_WATERMARK, ts_col: str = "timestamp") -> DataFrame:
    """Drop re-deliveries of the same (wiki, id) within the watermark.

    Rows with ``id = 0`` have no identity and pass through untouched.  State
    for a key is dropped once the watermark passes its first occurrence plus
    the delay, so the state size is bounded by the watermark span.
    """
    ev = df.withColumn("event_time", event_time(ts_col)).withWatermark("event_time", watermark)
    keyed = ev.where(F.col("id") != 0).dropDuplicatesWithinWatermark(["wiki", "id"])
    anon = ev.where(F.col("id") == 0)
    return keyed.unionByName(anon).drop("event_time")


RETRY_OUT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("retry_count", T.LongType()),
    T.StructField("to_dlq", T.BooleanType()),
])


class RetryCounter(StatefulProcessor):
    """R1 as keyed state: per (topic, partition, offset) the number of
    consecutive failures; a failure whose count reaches ``max_retries`` is
    routed to the dead-letter queue and the count starts again; a success
    clears the state."""

    def __init__(self, max_retries: int = 3):
        self.max_retries = max_retries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("attempt")
        n = self.count.get()[0] if self.count.exists() else 0
        out = []
        for attempt, failed in zip(batch["attempt"], batch["failed"]):
            if failed:
                dlq = n >= self.max_retries
                out.append((key[0], int(key[1]), int(key[2]), int(attempt), n, bool(dlq)))
                n = 0 if dlq else n + 1
            else:
                n = 0
        if n:
            self.count.update((n,))
        else:
            self.count.clear()
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in RETRY_OUT.fields])

    def close(self) -> None:
        pass


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def retry_stream(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """R1 on a stream of attempts (topic, partition, offset, attempt, failed).

    Keyed state needs the RocksDB state store; it is selected here when the
    session has another provider (a new query records it in its checkpoint).
    """
    spark = attempts.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (attempts.groupBy("topic", "partition", "offset")
            .transformWithStateInPandas(RetryCounter(max_retries), RETRY_OUT, "append", "None"))


def throughput(query) -> float:
    """M9: rows per second of the last micro-batch."""
    p = query.lastProgress
    return float(p.get("processedRowsPerSecond") or 0.0) if p else 0.0


def dropped_by_watermark(query, all_batches: bool = False) -> int:
    """T4: late rows dropped by stateful operators in the last micro-batch
    (or, with ``all_batches``, in every progress report the query kept)."""
    reports = list(query.recentProgress) if all_batches else [query.lastProgress]
    return sum(int(s.get("numRowsDroppedByWatermark", 0))
               for p in reports if p for s in p.get("stateOperators", []))


def observe_outcomes(decoded: DataFrame, name: str = "event_counters",
                     error: str = "error_message") -> DataFrame:
    """M1 live: published / consumed / failed counts of every micro-batch,
    reported in ``StreamingQueryProgress.observedMetrics[name]`` without an
    extra pass over the data."""
    e = F.col(error)
    return decoded.observe(name, F.count(F.lit(1)).alias("published"),
                           F.count_if(e.isNull()).alias("consumed"),
                           F.count_if(e.isNotNull()).alias("failed"))


def observed(query, name: str = "event_counters") -> dict:
    """Totals of an observed metric over the progress reports a query kept."""
    tot: dict = {}
    for p in query.recentProgress:
        row = (p.get("observedMetrics") or {}).get(name)
        if row is None:
            continue
        for k, v in (row.asDict() if hasattr(row, "asDict") else dict(row)).items():
            tot[k] = tot.get(k, 0) + int(v)
    return tot


def _offsets(obj) -> dict:
    import json
    if isinstance(obj, str):
        try:
            obj = json.loads(obj)
        except ValueError:
            return {}
    return obj if isinstance(obj, dict) else {}


def consumer_lag_from_progress(progress: dict) -> int:
    """M6 live: sum over topic partitions of (latest offset - end offset of the
    last micro-batch), from a Kafka source's progress entry.  0 when the
    source reports no offsets (file sources)."""
    lag = 0
    for src in progress.get("sources", []):
        latest, end = _offsets(src.get("latestOffset")), _offsets(src.get("endOffset"))
        for topic, parts in latest.items():
            if not isinstance(parts, dict):
                continue
            done = end.get(topic, {}) if isinstance(end.get(topic), dict) else {}
            for part, off in parts.items():
                lag += max(int(off) - int(done.get(part, 0)), 0)
    return lag
