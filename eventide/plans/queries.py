"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or data Spark derives from them) in
full, so its work grows with the input.  Output columns are aliased to the
names the oracle SQL uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import columns as C
from eventide.operators import features, metrics, reliability, windows
from eventide.operators.compatibility import compatibility
from eventide.operators.dedup import dedup_events
from eventide.operators.generate import amplify
from eventide.operators.joins import materialize, pack_small_files
from eventide.plans import inject
from eventide.schema import CHANGE_EVENT_V1, CHANGE_EVENT_V2, align_schema
from eventide.session import scratch_path
from eventide.sinks.parquet import write_events
from eventide.sinks.wire import to_dlq
from eventide.sources.json_events import (parse_change_event, parse_change_event_all, parse_defaults,
                                          parse_defaults_all, sse_frames)
from eventide.sources.replay import read_events
from eventide.sources.tables import EPOCH_SECONDS_SQL, ce_columns, change_events, read_table
from eventide.sources.wire import (decode_all, decode_wire, lookup_schema, registry_frame, rejected_rows,
                                   valid_rows, wire_envelope)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---- windows (A1, A2, A4, T3, T5, K8) ----------------------------------------------------

@query("window_type_counts")
def q_window_type_counts(spark, sf_dir):
    return windows.window_type_counts(change_events(spark, sf_dir))


@query("window_wiki_counts")
def q_window_wiki_counts(spark, sf_dir):
    return windows.window_wiki_counts(change_events(spark, sf_dir))


@query("window_counts_union")
def q_window_counts_union(spark, sf_dir):
    return windows.window_counts_union(change_events(spark, sf_dir))


@query("window_counts_json")
def q_window_counts_json(spark, sf_dir):
    return windows.union_json(windows.window_counts_union(change_events(spark, sf_dir)))


@query("stream_window_counts")
def q_stream_window_counts(spark, sf_dir):
    """T1/T3/T5 as Structured Streaming: JSON payloads of every event (a file
    source), parsed with defaults, 5 s watermark, per-minute counts of both
    dimensions in append mode, written by the file sink.  One micro-batch
    holds all input, so no row is late; the windows emitted are those that
    end by the final watermark (the newest event time minus 5 s)."""
    src = scratch_path(spark, "json-stream-in")
    inject.json_payloads(change_events(spark, sf_dir)).select("payload").write.text(src)
    payloads = spark.readStream.text(src).withColumnRenamed("value", "payload")
    valid, _ = parse_defaults(payloads)
    counts = windows.window_counts_union(valid, watermark=windows.WATERMARK)
    out, ckpt = scratch_path(spark, "json-stream-out"), scratch_path(spark, "json-stream-ckpt")
    q = (counts.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


@query("stream_window_json")
def q_stream_window_json(spark, sf_dir):
    """3.3 as the service runs it: JSON payloads of every event through the
    windows job; the result is the JSON lines its (exactly-once) text sink wrote."""
    from eventide.plans import jobs
    src = scratch_path(spark, "json-lines-in")
    inject.json_payloads(change_events(spark, sf_dir)).select("payload").write.text(src)
    payloads = spark.readStream.text(src).withColumnRenamed("value", "payload")
    out = scratch_path(spark, "json-lines-out")
    q = jobs.start_windows(spark, payloads, out, checkpoint=scratch_path(spark, "json-lines-ckpt"),
                           trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.text(out)


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """T6 as Structured Streaming: every event plus re-deliveries (a file
    source), deduplicated on (wiki, id) within the watermark; id-0 rows pass.
    Which copy survives inside one micro-batch is not fixed, so the result is
    the surviving identities (wiki, id)."""
    from eventide.streaming.operators import dedup_stream
    src = scratch_path(spark, "dedup-stream-in")
    inject.with_duplicates(change_events(spark, sf_dir)).write.parquet(src)
    stream = spark.readStream.schema(CHANGE_EVENT_V1).parquet(src)
    kept = dedup_stream(stream).select("wiki", "id")
    out, ckpt = scratch_path(spark, "dedup-stream-out"), scratch_path(spark, "dedup-stream-ckpt")
    q = (kept.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(kept.schema).parquet(out)


@query("stream_top_wikis")
def q_stream_top_wikis(spark, sf_dir):
    """A4 as a stream: per closed minute the 3 busiest wikis, ranked inside
    ``foreachBatch`` over the windows the append-mode aggregate emits."""
    from eventide.plans import jobs
    src = scratch_path(spark, "top-stream-in")
    inject.json_payloads(change_events(spark, sf_dir)).select("payload").write.text(src)
    payloads = spark.readStream.text(src).withColumnRenamed("value", "payload")
    out = scratch_path(spark, "top-stream-out")
    q = jobs.start_top_wikis(spark, payloads, out, k=3, checkpoint=scratch_path(spark, "top-stream-ckpt"),
                             trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out).select("window_start", "window_end", "wiki", "edits", "rank")


@query("window_top_wikis")
def q_window_top_wikis(spark, sf_dir):
    counts = windows.window_wiki_counts(change_events(spark, sf_dir))
    return windows.top_per_window(counts, k=3)


# ---- stored rows, partitioned sink, replay (P1, P2, P8, K3, K5, S5, P7, D1) --------------

REPLAY_FROM, REPLAY_TO = "2024-01-08", "2024-01-14"


@query("event_key")
def q_event_key(spark, sf_dir):
    ce = change_events(spark, sf_dir)
    return ce.select("id", C.event_key().alias("event_key"))


@query("stored_row")
def q_stored_row(spark, sf_dir):
    ce = change_events(spark, sf_dir)
    back = C.utc_to_epoch(C.epoch_to_utc("parsed_timestamp"))
    return ce.select("id", F.col("namespace").cast("int").alias("namespace"), "parsed_timestamp",
                     C.utc_text("parsed_timestamp").alias("parsed_utc"),
                     (back == F.col("parsed_timestamp")).alias("round_trip"))


@query("estimated_bytes")
def q_estimated_bytes(spark, sf_dir):
    ce = change_events(spark, sf_dir)
    return ce.select("id", C.estimated_bytes().alias("estimated_bytes"))


def _stored(spark, sf_dir):
    path = scratch_path(spark, "events")
    write_events(ce_columns(change_events(spark, sf_dir)), path)
    return path


# Limits of ``flush_by_bytes``: the given hours hold some tens of rows, so the source
# system's own (1,000 rows, 10 MB) would cut none of them.
FLUSH_ROWS, FLUSH_BYTES = 6, 1024


@query("flush_by_bytes")
def q_flush_by_bytes(spark, sf_dir):
    """K4: every event stored with files limited by rows and estimated bytes; one row per file."""
    path = scratch_path(spark, "flushed")
    write_events(ce_columns(change_events(spark, sf_dir)), path, max_records_per_file=FLUSH_ROWS,
                 max_bytes_per_file=FLUSH_BYTES)
    back = pack_small_files(read_events(spark, path).withColumn("_at", F.col("_metadata.file_path")))
    return back.groupBy("dt", "hour", "_at").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("events"),
        F.sum(C.estimated_bytes()).alias("estimated_bytes")).drop("_at")


@query("partition_counts")
def q_partition_counts(spark, sf_dir):
    back = read_events(spark, _stored(spark, sf_dir))
    return back.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("events"))


@query("replay_range")
def q_replay_range(spark, sf_dir):
    back = read_events(spark, _stored(spark, sf_dir), REPLAY_FROM, REPLAY_TO)
    return back.select("id", C.event_key().alias("event_key"), "dt", "hour")


def _replayed(spark, sf_dir):
    """R5 of the range over the whole stored table: its totals, and the topic it wrote."""
    from eventide.plans import jobs
    topic = scratch_path(spark, "replay-topic")
    return jobs.replay(spark, _stored(spark, sf_dir), REPLAY_FROM, REPLAY_TO, topic_dir=topic), topic


@query("replay_totals")
def q_replay_totals(spark, sf_dir):
    """A5: events of the replayed range, and whether files were counted."""
    totals, _ = _replayed(spark, sf_dir)
    return totals.select("events", (F.col("files") > 0).alias("has_files"))


@query("replay_job")
def q_replay_job(spark, sf_dir):
    """R5 end to end: stored days -> wire messages -> topic, decoded back."""
    _, topic = _replayed(spark, sf_dir)
    valid, _ = decode_wire(spark.read.parquet(topic).select("value"), registry_frame(spark))
    return valid


PACE, PACE_INTERVAL = 10_000, 0.2         # events per second; seconds between releases


@query("replay_paced")
def q_replay_paced(spark, sf_dir):
    """The range replayed at ``PACE``: each event with the tick that released it."""
    from eventide.plans import jobs
    topic = scratch_path(spark, "paced-topic")
    jobs.start_replay_paced(spark, _stored(spark, sf_dir), topic, REPLAY_FROM, REPLAY_TO, PACE, PACE_INTERVAL,
                            checkpoint=scratch_path(spark, "paced-ckpt")).await_end()
    sent = spark.read.parquet(topic).withColumn("tick", F.substring_index("batch_id", "-", -1).cast("long"))
    valid, _ = decode_wire(sent.select("value", "tick"), registry_frame(spark), keep=("tick",))
    return valid.select("id", C.event_key().alias("event_key"), "timestamp", "tick")


@query("publish_partitions")
def q_publish_partitions(spark, sf_dir):
    """K1: every event published; per key, its messages and the partitions they are in."""
    from eventide.sinks.wire import encode_wire, publish, to_envelope
    from eventide.sources.wire import SCHEMA_V1_JSON
    topic = scratch_path(spark, "published-topic")
    enc = encode_wire(ce_columns(change_events(spark, sf_dir)), 1, SCHEMA_V1_JSON)
    publish(to_envelope(enc, inject.TOPIC, C.event_key(), timestamp=C.event_time()), inject.TOPIC, path=topic)
    return (spark.read.parquet(topic).groupBy(F.col("key").cast("string").alias("event_key"))
            .agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("partition").alias("partitions")))


@query("dedup_events")
def q_dedup_events(spark, sf_dir):
    return dedup_events(inject.with_duplicates(change_events(spark, sf_dir)))


# ---- parsing and schema evolution (S1, S2, P6, E1, E2) -----------------------------------

@query("parse_change_event")
def q_parse_change_event(spark, sf_dir):
    payloads = inject.json_payloads(change_events(spark, sf_dir))
    a = parse_change_event_all(payloads, keep=("source_id",))       # one pass, no branches
    return a.select("source_id", F.col("error_message").isNull().alias("is_valid"),
                    *CHANGE_EVENT_V1.fieldNames(), "error_message")


@query("parse_defaults")
def q_parse_defaults(spark, sf_dir):
    payloads = inject.json_payloads(change_events(spark, sf_dir))
    a = parse_defaults_all(payloads, keep=("source_id",))
    return a.select("source_id", F.col("error_message").isNull().alias("is_valid"),
                    "wiki", "type", "timestamp", "error_message")


@query("sse_frames")
def q_sse_frames(spark, sf_dir):
    path = scratch_path(spark, "capture")
    inject.sse_capture(change_events(spark, sf_dir)).write.text(path)
    valid, _ = parse_change_event(sse_frames(spark, path))
    return valid


def _mixed_versions(spark, sf_dir):
    """Even ids written with the v2 writer schema, odd ids with v1."""
    ce = ce_columns(change_events(spark, sf_dir))
    path = scratch_path(spark, "versions")
    ce.where(F.col("id") % 2 != 0).write.parquet(path)
    (ce.where(F.col("id") % 2 == 0)
       .withColumn("minor", (F.col("namespace") % 2).cast("int"))
       .withColumn("page_id", F.col("id"))
       .write.mode("append").parquet(path))
    return path


@query("evolve_v1_v2")
def q_evolve_v1_v2(spark, sf_dir):
    df = spark.read.schema(CHANGE_EVENT_V2).parquet(_mixed_versions(spark, sf_dir))
    return align_schema(df, CHANGE_EVENT_V2)


@query("evolve_v2_v1")
def q_evolve_v2_v1(spark, sf_dir):
    df = spark.read.schema(CHANGE_EVENT_V2).parquet(_mixed_versions(spark, sf_dir))
    return align_schema(df, CHANGE_EVENT_V1)


# ---- wire format, dead letters, retries (S4, S7, K2, K7, P3-P5, R1-R4) --------------------

def _messages(spark, sf_dir):
    return inject.wire_messages(change_events(spark, sf_dir))


ENVELOPE_KEEP = ("key", "topic", "partition", "offset", "broker_timestamp", "headers")


def _decoded_all(spark, sf_dir):
    msgs = _messages(spark, sf_dir).withColumnRenamed("timestamp", "broker_timestamp")
    return decode_all(msgs, registry_frame(spark), keep=ENVELOPE_KEEP)


def _decoded(spark, sf_dir):
    dec = _decoded_all(spark, sf_dir)
    return valid_rows(dec, keep=ENVELOPE_KEEP), rejected_rows(dec, keep=ENVELOPE_KEEP)


@query("store_job")
def q_store_job(spark, sf_dir):
    """3.2 end to end as a stream: the wire messages of every event (a topic
    directory) through the store job (decode, dead letters, dedup, dt/hour
    Parquet with run-scoped batch keys); the result is what it stored."""
    from eventide.plans import jobs
    from eventide.streaming.sources import read_topic
    topic = scratch_path(spark, "store-topic")
    _messages(spark, sf_dir).write.parquet(topic)
    events, dlq = scratch_path(spark, "store-events"), scratch_path(spark, "store-dlq")
    q = jobs.start_store(spark, read_topic(spark, inject.TOPIC, path=topic), events, dlq,
                         registry_frame(spark), checkpoint=scratch_path(spark, "store-ckpt"),
                         trigger={"availableNow": True})
    q.awaitTermination()
    return ce_columns(read_events(spark, events))


@query("store_redelivery")
def q_store_redelivery(spark, sf_dir):
    """K6: a topic that holds every message twice, read by two runs of the store job with
    checkpoints of their own: each event is stored once, those without an id too."""
    from eventide.plans import jobs
    from eventide.streaming.sources import read_topic
    topic = scratch_path(spark, "redelivery-topic")
    inject.redelivered_topic(ce_columns(change_events(spark, sf_dir))).write.parquet(topic)
    events, dlq = scratch_path(spark, "redelivery-events"), scratch_path(spark, "redelivery-dlq")
    for run in ("first", "second"):
        jobs.start_store(spark, read_topic(spark, inject.TOPIC, path=topic), events, dlq, registry_frame(spark),
                         checkpoint=scratch_path(spark, f"redelivery-{run}"), trigger={"availableNow": True}).awaitTermination()
    return ce_columns(read_events(spark, events))


@query("ingest_job")
def q_ingest_job(spark, sf_dir):
    """3.1 end to end as a stream: an event-stream capture of every event
    through the ingest job (frames, JSON, Avro wire, topic); the result is the
    topic decoded back."""
    from eventide.plans import jobs
    capture = scratch_path(spark, "ingest-capture")
    inject.sse_capture(change_events(spark, sf_dir)).write.text(capture)
    topic, dlq = scratch_path(spark, "ingest-topic"), scratch_path(spark, "ingest-dlq")
    q = jobs.start_ingest(spark, capture, topic, dlq, checkpoint=scratch_path(spark, "ingest-ckpt"),
                          trigger={"availableNow": True})
    q.awaitTermination()
    valid, _ = decode_wire(spark.read.parquet(topic).select("value"), registry_frame(spark))
    return valid


@query("wire_envelope")
def q_wire_envelope(spark, sf_dir):
    env = wire_envelope(_messages(spark, sf_dir))
    return env.select(F.col("offset").alias("source_id"), "magic", "schema_id", "envelope_error")


@query("schema_lookup")
def q_schema_lookup(spark, sf_dir):
    env = wire_envelope(_messages(spark, sf_dir)).select("offset", "schema_id")
    out = lookup_schema(env, registry_frame(spark))
    return out.select(F.col("offset").alias("source_id"), "schema_id", "subject", "version", "found")


@query("schema_compatibility")
def q_schema_compatibility(spark, sf_dir):
    found = compatibility(inject.schema_versions(read_table(spark, sf_dir, "events")))
    return found.select("subject", "version", "previous_version", "backward", "forward", "full",
                        F.array_join("backward_problems", "; ").alias("backward_problems"),
                        F.array_join("forward_problems", "; ").alias("forward_problems"))


@query("decode_wire")
def q_decode_wire(spark, sf_dir):
    # valid rows and rejects from one decode pass: no branch re-runs the decoder
    dec = _decoded_all(spark, sf_dir)
    ok = F.col("error_message").isNull()
    aligned = align_schema(dec, CHANGE_EVENT_V1, keep=("offset", "error_message"))
    return aligned.select(F.col("offset").alias("source_id"), ok.alias("is_valid"),
                          *[F.when(ok, F.col(c)).alias(c) for c in CHANGE_EVENT_V1.fieldNames()],
                          "error_message")


@query("evolve_wire_v2")
def q_evolve_wire_v2(spark, sf_dir):
    """E1 over the wire: messages written with v1 and with v2 writer schemas,
    decoded under the v2 reader schema (v1 bodies get minor = 0, page_id = NULL)."""
    valid, _ = decode_wire(_messages(spark, sf_dir), registry_frame(spark), target=CHANGE_EVENT_V2)
    return valid


@query("wire_round_trip")
def q_wire_round_trip(spark, sf_dir):
    """K2 then S4 on undamaged messages: every event comes back unchanged."""
    from eventide.sinks.wire import encode_wire
    from eventide.sources.wire import SCHEMA_V1_JSON
    ce = ce_columns(change_events(spark, sf_dir))
    enc = encode_wire(ce, 1, SCHEMA_V1_JSON)
    valid, _ = decode_wire(enc.select("value"), registry_frame(spark))
    return valid


@query("error_type")
def q_error_type(spark, sf_dir):
    _, wire_rej = _decoded(spark, sf_dir)
    _, json_rej = parse_change_event(inject.json_payloads(change_events(spark, sf_dir)), keep=("source_id",))
    rej = (wire_rej.select(F.lit("wire").alias("source"), F.col("offset").alias("source_id"),
                           "error_message")
           .unionByName(json_rej.select(F.lit("json").alias("source"), "source_id", "error_message")))
    return rej.withColumn("error_type", C.error_type("error_message"))


def _dlq(spark, sf_dir):
    _, rejected = _decoded(spark, sf_dir)
    return to_dlq(rejected, ts_col="broker_timestamp")


@query("dlq_route")
def q_dlq_route(spark, sf_dir):
    dlq = _dlq(spark, sf_dir)
    return dlq.select(
        F.col("offset").alias("source_id"), F.col("key").cast("string").alias("key"), "topic",
        C.header(C.H_ERROR_TYPE).alias("error_type"),
        C.header(C.H_ERROR_MESSAGE).alias("error_message"),
        C.header(C.H_ORIGINAL_TOPIC).alias("original_topic"),
        C.header(C.H_RETRY_COUNT).alias("retry_count"),
        C.header(C.H_ORIGINAL_TIMESTAMP).alias("original_timestamp"),
        C.header(C.H_ERROR_STAGE).alias("error_stage"),
        F.size("headers").cast("int").alias("n_headers"))


@query("dlq_inspect")
def q_dlq_inspect(spark, sf_dir):
    return reliability.dlq_inspect(inject.legacy_dlq(_dlq(spark, sf_dir)))


@query("dlq_replay")
def q_dlq_replay(spark, sf_dir):
    out = reliability.dlq_replay(inject.legacy_dlq(_dlq(spark, sf_dir)))
    return out.select("topic", F.col("key").cast("string").alias("key"), "offset")


@query("retry_route")
def q_retry_route(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    attempts = ev.select(F.col("user_id").alias("part"), F.col("event_id").alias("attempt"),
                         F.col("event_type").isin("error", "view").alias("failed"))
    return reliability.retry_route(attempts, ["part"], "attempt", "failed") \
                      .select("attempt", "retry_count", "to_dlq")


@query("stream_retry_route")
def q_stream_retry_route(spark, sf_dir):
    """R1 as keyed streaming state (``transformWithStateInPandas``): the attempt
    log of every event (a file source) -> count before each failed attempt and
    the dead-letter decision, per message (topic, partition, offset)."""
    from eventide.streaming.operators import retry_stream
    ev = read_table(spark, sf_dir, "events")
    src = scratch_path(spark, "retry-stream-in")
    ev.select(F.lit(inject.TOPIC).alias("topic"), F.lit(0).alias("partition"),
              F.col("user_id").alias("offset"), F.col("event_id").alias("attempt"),
              F.col("event_type").isin("error", "view").alias("failed")).write.parquet(src)
    schema = "topic string, partition int, offset long, attempt long, failed boolean"
    out_rows = retry_stream(spark.readStream.schema(schema).parquet(src))
    out, ckpt = scratch_path(spark, "retry-stream-out"), scratch_path(spark, "retry-stream-ckpt")
    q = (out_rows.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(out_rows.schema).parquet(out).select("attempt", "retry_count", "to_dlq")


SINK_ERROR_MESSAGE = "write to sink failed: flush error"


@query("dlq_route_retries")
def q_dlq_route_retries(spark, sf_dir):
    """R1 -> R2/K7 for sink failures: attempts whose retry count reached the
    maximum go to the dead-letter topic with their real count and stage."""
    ev = read_table(spark, sf_dir, "events")
    attempts = ev.select(F.col("user_id").alias("part"), F.col("event_id").alias("attempt"),
                         F.col("event_type").isin("error", "view").alias("failed"),
                         F.expr(EPOCH_SECONDS_SQL).alias("ts"))
    routed = reliability.retry_route(attempts, ["part"], "attempt", "failed").where("to_dlq")
    env = routed.select(
        F.col("part").cast("string").cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"),
        F.lit(inject.TOPIC).alias("topic"), (F.col("part") % 4).cast("int").alias("partition"),
        F.col("attempt").alias("offset"), F.timestamp_seconds("ts").alias("timestamp"),
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"),
        F.lit(SINK_ERROR_MESSAGE).alias("error_message"), "retry_count")
    dlq = to_dlq(env, stage="sink")
    return dlq.select(
        F.col("offset").alias("source_id"), F.col("key").cast("string").alias("key"),
        C.header(C.H_ERROR_TYPE).alias("error_type"), C.header(C.H_ERROR_MESSAGE).alias("error_message"),
        C.header(C.H_ORIGINAL_TOPIC).alias("original_topic"), C.header(C.H_RETRY_COUNT).alias("retry_count"),
        C.header(C.H_ORIGINAL_TIMESTAMP).alias("original_timestamp"),
        C.header(C.H_ERROR_STAGE).alias("error_stage"))


# ---- features (F1-F8) ---------------------------------------------------------------------

ASOF_TTL = 7200                       # seconds, the TTL the as-of check uses
LATEST_FROM, LATEST_TO = 1704844800, 1705708800   # [2024-01-10, 2024-01-20) UTC


@query("feature_events")
def q_feature_events(spark, sf_dir):
    return features.feature_events(change_events(spark, sf_dir))


@query("feature_edit_stats")
def q_feature_edit_stats(spark, sf_dir):
    return features.edit_stats(change_events(spark, sf_dir))


@query("feature_asof")
def q_feature_asof(spark, sf_dir):
    ce = change_events(spark, sf_dir)
    # the feature table is materialized once (as a feature store would) because
    # the as-of join reads it in two branches
    stats = materialize(features.edit_stats(ce))
    return features.asof_join(ce.select("id", "wiki", "timestamp"), stats, ["wiki"],
                              "timestamp", "feature_ts", ttl=ASOF_TTL)


@query("feature_service")
def q_feature_service(spark, sf_dir):
    """Both views at their declared times to live, for a request per event:
    before it, within 120 days after it, or 400 days after it."""
    from eventide.plans.feature_store import feature_service
    stored = features.feature_source(spark, _stored(spark, sf_dir))
    ce = change_events(spark, sf_dir)
    after = (F.when(F.col("id") % 13 == 0, F.lit(400 * features.DAY)).when(F.col("id") % 10 == 0, F.lit(-1800))
             .otherwise((F.col("id") % 120) * features.DAY + (F.col("id") % 7) * 1800))
    asked = ce.select(F.col("id").alias("event_id"), "wiki", (F.col("timestamp") + after).cast("long").alias("request_ts"))
    return feature_service(asked, stored, materialize(features.edit_stats(ce)))


DELIVERY_ENDS = (1704931200, 1705795200)     # 2024-01-11 and 2024-01-21, UTC


@query("feature_incremental")
def q_feature_incremental(spark, sf_dir):
    """F8: the events stored in three deliveries, one in twenty late by one or two of
    them, with an incremental materialization after each: the whole grid."""
    from eventide.plans import feature_store
    from eventide.sinks.parquet import with_partitions
    ce = ce_columns(change_events(spark, sf_dir))
    on_time = (F.when(F.col("timestamp") < DELIVERY_ENDS[0], 0).when(F.col("timestamp") < DELIVERY_ENDS[1], 1).otherwise(2))
    events, store = scratch_path(spark, "incremental-events"), scratch_path(spark, "incremental-store")
    for n in range(3):
        part = ce.where(F.when(F.col("id") % 20 == 0, F.lit(2)).otherwise(on_time) == n)
        write_events(part, events, batch_id=f"deliveries-{n:010d}")
        feature_store.commit_partitions(with_partitions(part), events, "deliveries", n)
        feature_store.materialize_incremental(spark, events, store)
    return feature_store.read_grid(spark, store)


@query("feature_latest")
def q_feature_latest(spark, sf_dir):
    stats = features.edit_stats(change_events(spark, sf_dir), start=LATEST_FROM, end=LATEST_TO)
    return features.latest_per_key(stats, ["wiki"], "feature_ts", LATEST_FROM, LATEST_TO)


# ---- metrics (M1-M8) and load generation (G1) --------------------------------------------

QUANTILES = [0.5, 0.95, 0.99]


@query("metric_counters")
def q_metric_counters(spark, sf_dir):
    return metrics.counters(_decoded_all(spark, sf_dir), inject.TOPIC)


@query("metric_histogram")
def q_metric_histogram(spark, sf_dir):
    ce = change_events(spark, sf_dir, with_duration=True)
    return metrics.histogram(ce, "duration_s", group=["type"])


@query("metric_quantiles")
def q_metric_quantiles(spark, sf_dir):
    ce = change_events(spark, sf_dir, with_duration=True)
    return metrics.histogram_quantiles(ce, "duration_s", QUANTILES, group=["type"])


@query("metric_rate")
def q_metric_rate(spark, sf_dir):
    return metrics.rate_per_second(change_events(spark, sf_dir), "timestamp", ["type"])


@query("metric_error_rate")
def q_metric_error_rate(spark, sf_dir):
    _, rejected = _decoded(spark, sf_dir)
    failed = rejected.select(F.unix_seconds("broker_timestamp").alias("ts"),
                             C.error_type("error_message").alias("error_type"))
    return metrics.rate_per_second(failed, "ts", ["error_type"])


@query("metric_lag")
def q_metric_lag(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).cast("int").alias("partition"), "event_type")
    offsets = ev.groupBy("partition").agg(F.count(F.lit(1)).alias("end_offset"),
                                          F.count_if(F.col("event_type") != "error").alias("committed_offset"))
    return metrics.lag_of(offsets, ["partition"])


@query("metric_batch_size")
def q_metric_batch_size(spark, sf_dir):
    sizes = metrics.flush_batch_sizes(change_events(spark, sf_dir), "timestamp", ["wiki"])
    return metrics.histogram(sizes, "batch_size", metrics.BATCH_SIZE_BUCKETS)


@query("slo_report")
def q_slo_report(spark, sf_dir):
    ce = change_events(spark, sf_dir, with_duration=True).select(
        "wiki", "timestamp", (F.col("duration_s") * 1000.0).alias("latency_ms"),
        (F.col("type") == "error").alias("is_error"))
    return metrics.slo_report(ce, ["wiki"], "latency_ms", "is_error", "timestamp")


@query("amplify_events")
def q_amplify_events(spark, sf_dir):
    seed = ce_columns(change_events(spark, sf_dir))
    n = 2 * seed.count()
    return amplify(seed, n)
