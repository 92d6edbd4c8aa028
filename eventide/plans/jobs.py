"""The four end-to-end jobs as Spark jobs (section 3 of the survey).

* ``start_ingest``   capture files -> frames -> change events -> wire -> topic   (3.1)
* ``start_store``    topic -> decode -> dead letters + deduplicated dt/hour Parquet  (3.2)
* ``start_windows``  JSON topic -> watermark -> per-minute counts -> JSON lines  (3.3)
* ``replay``         stored days -> wire -> topic, one distributed batch job   (3.4, R5)

Streaming jobs write through ``foreachBatch`` or file sinks whose commit
follows the batch's writes, so offsets are only committed after the data
landed (T7); every write is keyed by run and batch (``batch_key``) so a
re-run replaces instead of duplicating, and a fresh checkpoint never
overwrites an earlier run (K6, D13).
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.functions.columns import event_key, event_time
from eventide.operators import offsets
from eventide.operators.dedup import dedup_events
from eventide.operators.generate import dense_index
from eventide.operators.windows import WATERMARK, union_json, window_counts_union
from eventide.plans.feature_store import commit_partitions
from eventide.schema import CHANGE_EVENT_COLUMNS, ENVELOPE
from eventide.session import scratch_path
from eventide.sinks.parquet import FLUSH_INTERVAL, with_partitions, write_events
from eventide.sinks.wire import encode_wire, publish, to_dlq, to_envelope, use_broker
from eventide.sources.json_events import frames_to_payloads, parse_change_event, parse_defaults
from eventide.sources.replay import check_range, read_events, read_partitions
from eventide.sources.wire import SCHEMA_V1_JSON, decode_all, rejected_rows, valid_rows
from eventide.streaming.sources import clock

TOPIC = "recentchanges"
DLQ_TOPIC = "recentchanges-dlq"
AGG_TOPIC = "recentchanges-aggregated"


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or scratch_path(spark, f"ckpt-{name}")


def batch_key(checkpoint: str, batch_id: int) -> str:
    """Partition value of one micro-batch: the run (a digest of the checkpoint
    path, stable across restarts of that checkpoint) and the batch number.
    A restart re-runs a batch under the same key and replaces its files; a
    fresh checkpoint starts a new run and can never overwrite an old run's files."""
    import hashlib
    run = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    return f"{run}-{int(batch_id):010d}"


def start_ingest(spark: SparkSession, capture_dir: str, topic_dir: str | None, dlq_dir: str | None,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 schema_id: int = 1, schema_json: str = SCHEMA_V1_JSON,
                 bootstrap_servers: str | None = None, line_sep: str = "\n\n"):
    """3.1: S1 -> S2 -> K2 -> K1; JSON rejects go to the dead-letter directory.  ``line_sep`` is the frame separator ("\r\n\r\n" for CRLF captures)."""
    frames = spark.readStream.option("lineSep", line_sep).text(capture_dir)
    ckpt = _checkpoint(spark, "ingest", checkpoint)

    def batch(df: DataFrame, batch_id: int) -> None:
        key = batch_key(ckpt, batch_id)
        df.persist()
        try:
            write(df, key)
        finally:
            df.unpersist()

    def write(df: DataFrame, key: str) -> None:
        valid, rejected = parse_change_event(frames_to_payloads(df))
        enc = encode_wire(valid, schema_id, schema_json)
        env = to_envelope(enc, TOPIC, event_key(), timestamp=event_time("timestamp"))
        _write_batch(env, topic_dir, key, TOPIC, bootstrap_servers)
        rej = rejected.select(
            F.lit(None).cast("binary").alias("key"), F.col("payload").cast("binary").alias("value"),
            F.lit(TOPIC).alias("topic"), F.lit(None).cast("int").alias("partition"),
            # no broker time for a captured frame; NULL (not "now") keeps a retried
            # batch's dead letters in the same partition
            F.lit(None).cast("long").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
            F.array().cast("array<struct<key:string,value:binary>>").alias("headers"), "error_message")
        _write_dlq(to_dlq(rej, DLQ_TOPIC), dlq_dir, key, bootstrap_servers)

    w = frames.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
    return w.trigger(**(trigger or {"processingTime": FLUSH_INTERVAL})).start()


def _write_batch(df: DataFrame, path: str | None, key: str, topic: str | None = None,
                 bootstrap_servers: str | None = None) -> None:
    """Per-batch write of envelope rows.

    To Kafka (``topic``) when servers are given: at-least-once,
    consumers deduplicate (T6/D1).  Otherwise Parquet under ``path`` in a
    ``batch_id=`` partition with dynamic overwrite, so a re-run batch replaces
    its own files.
    """
    if use_broker(df.sparkSession, bootstrap_servers):
        publish(df, topic, bootstrap_servers=bootstrap_servers)
        return
    (df.withColumn("batch_id", F.lit(key))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def _write_dlq(dlq: DataFrame, path: str | None, key: str, bootstrap_servers: str | None = None) -> None:
    """Dead-letter rows of one batch, exactly once per original message.

    Kafka: publish (at-least-once).  Parquet: partitioned by the failed
    message's day and the batch key; a row whose original (topic, partition,
    offset) is already stored for that day by another batch is dropped, so a
    fresh checkpoint re-reading old messages adds no second copy.  Rows
    without coordinates (JSON rejects) cannot be matched and are kept.
    """
    if use_broker(dlq.sparkSession, bootstrap_servers):
        publish(dlq, DLQ_TOPIC, bootstrap_servers=bootstrap_servers)
        return
    from eventide.functions.columns import H_ORIGINAL_TOPIC, dt_col, header
    spark = dlq.sparkSession
    rows = (dlq.withColumn("dt", dt_col(F.unix_seconds(F.col("timestamp"))))
               .withColumn("_orig", header(H_ORIGINAL_TOPIC)))
    if _exists(spark, path):
        from pyspark.sql import types as T

        schema = T.StructType(ENVELOPE.fields + [T.StructField("dt", T.StringType()),
                                                 T.StructField("batch_id", T.StringType())])
        stored = (_read_touched(spark, path, rows.select("dt"), schema)
                  .where(F.col("batch_id") != F.lit(key))
                  .select("dt", header(H_ORIGINAL_TOPIC).alias("_orig"), "partition", "offset").distinct())
        rows = rows.join(stored, on=["dt", "_orig", "partition", "offset"], how="left_anti")
    (rows.drop("_orig").withColumn("batch_id", F.lit(key))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt", "batch_id").parquet(path))


# Up to so many partition directories are read by their paths; a batch that touches
# more reads the whole tree, whose rows the joins below match on the partition as well.
READ_BY_PATH = 1000


def _read_touched(spark: SparkSession, root: str, parts: DataFrame, schema) -> DataFrame:
    """Stored rows of the partitions (columns of ``parts``) that a batch touches,
    and perhaps of others."""
    touched = parts.distinct().limit(READ_BY_PATH + 1).collect()      # bounded by the limit
    if len(touched) > READ_BY_PATH:
        return spark.read.schema(schema).parquet(root)                # explicit schema: fine on an empty folder
    default = "__HIVE_DEFAULT_PARTITION__"
    return read_partitions(spark, root, ["/".join(f"{c}={default if r[c] is None else r[c]}" for c in parts.columns)
                                         for r in touched], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_stored(events: DataFrame, events_dir: str, key: str) -> DataFrame:
    """Remove events already stored by *other* batches (re-deliveries, replays of old
    days, section 7.4).  Only the key columns of the (day, hour) partitions this
    batch touches are listed and read -- a live batch spans an hour or two -- so
    a batch costs the same however much is stored besides.  The batch's own files
    are excluded, so re-running it still replaces them instead of dropping
    everything."""
    spark = events.sparkSession
    if not _exists(spark, events_dir):
        return events
    from eventide.functions.columns import dt_col, hour_col
    from eventide.operators.dedup import anti_join_existing
    from eventide.sources.replay import STORED
    from pyspark.sql import types as T
    placed = events.withColumn("dt", dt_col("timestamp")).withColumn("hour", hour_col("timestamp"))
    schema = T.StructType(STORED.fields + [T.StructField("batch_id", T.StringType())])
    stored = _read_touched(spark, events_dir, placed.select("dt", "hour"), schema) \
        .where(F.col("batch_id") != F.lit(str(key)))
    return anti_join_existing(placed, stored, key=["dt", "hour", "wiki", "id"]).drop("dt", "hour")


def _one_per_message(df: DataFrame) -> DataFrame:
    """One row for each (topic, partition, offset); rows that lack one of them all stay."""
    has = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return df.where(has).dropDuplicates(list(offsets.COORDINATES)).unionByName(df.where(~has))


# Stored beside each event: the message that it came in.
SOURCE = ("source_topic", "source_partition", "source_offset")


def store_batch(df: DataFrame, key: str, events_dir: str, dlq_dir: str | None,
                registry: DataFrame, bootstrap_servers: str | None = None,
                max_records_per_file: int | None = None, in_order: bool = False,
                max_bytes_per_file: int | None = None) -> None:
    """3.2 for one micro-batch: drop messages stored before; decode; rejects -> DLQ;
    valid -> dedup (within the batch and against stored days) -> dt/hour files;
    then commit the batch's offsets and partitions.

    The decoded batch is persisted because several steps read it, and the batch
    itself if offsets are committed that it is compared with.  Both writes
    replace their own ``batch_id`` partition and the offsets are committed after
    them, so a replayed batch adds nothing twice: what it left behind is
    overwritten, whatever was committed is not seen by itself (K6).
    ``in_order``: the source reads every offset of a partition in order.
    """
    spark = df.sparkSession
    run, _, number = key.rpartition("-")
    manifest = f"{events_dir.rstrip('/')}/{offsets.OFFSETS_DIR}"
    before = offsets.committed(spark, manifest, run, int(number))
    if before is not None:
        df = df.persist()                   # read once from the topic: for its offsets and for its messages
    msgs = df.withColumnRenamed("timestamp", "broker_timestamp")
    if before is not None:
        msgs = offsets.drop_covered(msgs, before)
    keep = ("key", "topic", "partition", "offset", "broker_timestamp", "headers")
    dec = decode_all(msgs, registry, keep=keep).persist()     # decoded once, read by both sinks
    try:
        rejects = _one_per_message(rejected_rows(dec, keep=keep))
        _write_dlq(to_dlq(rejects, DLQ_TOPIC, ts_col="broker_timestamp"), dlq_dir, key, bootstrap_servers)
        valid = valid_rows(dec, keep=offsets.COORDINATES).withColumnsRenamed(dict(zip(offsets.COORDINATES, SOURCE)))
        events = drop_stored(dedup_events(valid, delivery=SOURCE), events_dir, key)
        write_events(events, events_dir, batch_id=key, max_records_per_file=max_records_per_file, keep=SOURCE,
                     max_bytes_per_file=max_bytes_per_file)
        done = offsets.offset_spans(dec) if in_order else offsets.offset_ranges(dec)
        commit_partitions(with_partitions(valid), events_dir, run, int(number))
        offsets.commit(spark, manifest, run, int(number), done)
    finally:
        dec.unpersist()
        df.unpersist()


def start_store(spark: SparkSession, topic_stream: DataFrame, events_dir: str, dlq_dir: str | None,
                registry: DataFrame, checkpoint: str | None = None, trigger: dict | None = None,
                bootstrap_servers: str | None = None, max_records_per_file: int | None = None,
                max_bytes_per_file: int | None = None):
    """3.2 as a stream: offsets are committed by the checkpoint after ``store_batch`` returns.
    Files have the size that the rebalance aims at; ``max_records_per_file`` (the source
    system: ``FLUSH_MAX_ROWS``) and ``max_bytes_per_file`` (``FLUSH_MAX_BYTES``) make them smaller."""
    ckpt = _checkpoint(spark, "store", checkpoint)
    w = topic_stream.writeStream.foreachBatch(
        lambda df, bid: store_batch(df, batch_key(ckpt, bid), events_dir, dlq_dir, registry, bootstrap_servers,
                                    max_records_per_file, bool(bootstrap_servers), max_bytes_per_file)
    ).option("checkpointLocation", ckpt)
    return w.trigger(**(trigger or {"processingTime": FLUSH_INTERVAL})).start()


def windows_stream(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """3.3 as a DataFrame: P6 -> P9 -> T1 -> T5 -> K8 (append mode: a window is
    emitted once the watermark passes its end, D14)."""
    valid, _ = parse_defaults(payloads, payload)
    counts = window_counts_union(valid, watermark=WATERMARK)
    return union_json(counts)


def start_windows(spark: SparkSession, payloads: DataFrame, out_dir: str | None,
                  checkpoint: str | None = None, trigger: dict | None = None,
                  bootstrap_servers: str | None = None):
    """3.3: JSON lines to the aggregate topic (Kafka sink, at-least-once) or, without
    a broker, as text files (the file sink's commit log makes that exactly-once)."""
    out = windows_stream(payloads).writeStream.outputMode("append") \
        .option("checkpointLocation", _checkpoint(spark, "windows", checkpoint))
    if use_broker(spark, bootstrap_servers):
        q = out.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", AGG_TOPIC)
    else:
        q = out.format("text").option("path", out_dir)
    return q.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def replay(spark: SparkSession, events_dir: str, date_from: str, date_to: str,
           topic_dir: str | None = None, dry_run: bool = False,
           schema_id: int = 1, schema_json: str = SCHEMA_V1_JSON,
           bootstrap_servers: str | None = None) -> DataFrame:
    """3.4/R5: stored days -> wire messages -> topic, as one distributed job.

    Returns the totals (events, files); with ``dry_run`` nothing is written.
    """
    from eventide.sources.replay import replay_totals
    stored = read_events(spark, events_dir, date_from, date_to)
    totals = replay_totals(stored)
    if dry_run:
        return totals
    enc = encode_wire(stored.drop("dt", "hour"), schema_id, schema_json)
    env = to_envelope(enc, TOPIC, event_key(), timestamp=event_time("timestamp"))
    publish(env, TOPIC, path=topic_dir, bootstrap_servers=bootstrap_servers)
    return totals


class PacedReplay(NamedTuple):
    """A running paced replay: its query, and after how many ticks it is done."""
    query: StreamingQuery
    ticks: int

    def await_end(self, poll_seconds: float = 0.1) -> None:
        """Wait for the last tick, then stop the clock (which would go on for ever)."""
        while self.query.isActive:
            last = self.query.lastProgress
            if not self.ticks or last and last["batchId"] >= self.ticks - 1:
                break
            time.sleep(poll_seconds)
        self.query.stop()
        if self.query.exception():
            raise self.query.exception()


# Messages that lie in one folder, and file, of the release table.
BLOCK_MESSAGES = 1 << 17


def release_table(spark: SparkSession, events_dir: str, date_from: str, date_to: str, path: str,
                  schema_id: int = 1, schema_json: str = SCHEMA_V1_JSON) -> DataFrame:
    """The wire messages of the days' events, numbered by event time and written
    under ``path`` in blocks, in order; what is there whole is used again, so
    that a restart releases the same events at the same ticks."""
    schema = T.StructType([*ENVELOPE.fields, T.StructField("release", T.LongType()), T.StructField("block", T.LongType())])
    if not _exists(spark, f"{path}/_SUCCESS"):
        stored = read_events(spark, events_dir, date_from, date_to).select(*CHANGE_EVENT_COLUMNS)
        first = ["timestamp", "wiki", "id"]
        order = [*first, *(c for c in CHANGE_EVENT_COLUMNS if c not in first)]
        enc = encode_wire(dense_index(stored, order, out="release"), schema_id, schema_json)
        env = to_envelope(enc, TOPIC, event_key(), timestamp=event_time("timestamp"), keep=("release",)) \
            .withColumn("block", F.floor(F.col("release") / F.lit(BLOCK_MESSAGES)).cast("long"))
        env.repartition("block").sortWithinPartitions("block", "release").write.mode("overwrite").partitionBy("block").parquet(path)
    return spark.read.schema(schema).parquet(path)


def start_replay_paced(spark: SparkSession, events_dir: str, topic_dir: str | None, date_from: str, date_to: str,
                       events_per_second: float, interval_seconds: float = 1.0, checkpoint: str | None = None,
                       schema_id: int = 1, schema_json: str = SCHEMA_V1_JSON,
                       bootstrap_servers: str | None = None) -> PacedReplay:
    """Replay the stored events of ``[date_from, date_to]`` in order of event
    time at ``events_per_second``: each tick of a clock, one every
    ``interval_seconds``, releases the next ``events_per_second * interval_seconds``.

    The range is listed by its days' paths, numbered and encoded once; a tick
    reads only its own block of that table, cut to its rows by the file
    statistics, and does nothing but send them, however long the range.  A
    trigger that comes late releases its own tick, so no interval gets more.
    A restart of the checkpoint goes on at the tick that was not committed.
    """
    check_range(date_from, date_to)
    per_tick = max(1, int(events_per_second * interval_seconds))
    ckpt = _checkpoint(spark, "replay", checkpoint).rstrip("/")
    table = release_table(spark, events_dir, date_from, date_to, f"{ckpt}-messages-{schema_id}-{per_tick}", schema_id, schema_json)
    ticks = -(-table.count() // per_tick)
    columns = ENVELOPE.fieldNames()

    def batch(df: DataFrame, batch_id: int) -> None:
        if batch_id >= ticks:               # the clock ticks once a batch: its number is the tick
            return
        lo, hi = batch_id * per_tick, (batch_id + 1) * per_tick
        blocks = F.col("block").between(lo // BLOCK_MESSAGES, (hi - 1) // BLOCK_MESSAGES)
        due = table.where(blocks & (F.col("release") >= lo) & (F.col("release") < hi))
        _write_batch(due.select(*columns), topic_dir, batch_key(ckpt, batch_id), TOPIC, bootstrap_servers)

    w = clock(spark, interval_seconds).writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
    return PacedReplay(w.trigger(processingTime=f"{max(1, int(interval_seconds * 1000))} milliseconds").start(), ticks)


def start_top_wikis(spark: SparkSession, payloads: DataFrame, out_dir: str, k: int = 3,
                    payload: str = "payload", checkpoint: str | None = None, trigger: dict | None = None):
    """A4 on a stream: per closed minute, the ``k`` wikis with the most edits.

    The per-minute counts run in append mode, so every window reaches a
    micro-batch exactly once and complete; ranking it there (``foreachBatch``)
    is therefore final.  Writes are keyed by ``batch_id`` like the other jobs.
    """
    from eventide.operators.windows import top_per_window, window_wiki_counts
    valid, _ = parse_defaults(payloads, payload)
    counts = window_wiki_counts(valid, watermark=WATERMARK)

    ckpt = _checkpoint(spark, "top", checkpoint)

    def batch(df: DataFrame, batch_id: int) -> None:
        _write_batch(top_per_window(df, k=k), out_dir, batch_key(ckpt, batch_id))

    w = counts.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", ckpt)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
