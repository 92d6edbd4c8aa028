import json
import os
import time

from pyspark.sql import functions as F

from eventide.plans import inject, jobs
from eventide.schema import CHANGE_EVENT_V1
from eventide.sources.replay import read_events
from eventide.sources.tables import ce_columns, change_events
from eventide.sources.wire import decode_wire, registry_frame
from eventide.streaming.operators import dedup_stream, dropped_by_watermark, retry_stream, throughput
from eventide.streaming.sources import read_event_files, read_topic
from tests.conftest import SF001


def _files(path, batches, ext="txt"):
    """One file per micro-batch, increasing modification times."""
    os.makedirs(path, exist_ok=True)
    now = time.time() - 1000
    for i, lines in enumerate(batches):
        p = os.path.join(path, f"b{i:03d}.{ext}")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (now + i, now + i))


def _ev(ts, typ, i=1, wiki="enwiki"):
    return json.dumps({"id": i, "type": typ, "timestamp": ts, "wiki": wiki})


def _run_windows(spark, tmp, batches, name):
    src = os.path.join(tmp, "in")
    _files(src, batches)
    payloads = spark.readStream.option("maxFilesPerTrigger", 1).text(src) \
                    .withColumnRenamed("value", "payload")
    q = (jobs.windows_stream(payloads).writeStream.format("memory").queryName(name)
         .outputMode("append").option("checkpointLocation", os.path.join(tmp, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = dropped_by_watermark(q, all_batches=True)
    rows = [json.loads(r.value) for r in spark.table(name).collect()]
    return rows, dropped


def _type_counts(rows):
    return sorted((r["window"]["start"] // 60000, r["type"], r["count"]) for r in rows if "type" in r)


PROBE = [[_ev(1, "edit"), _ev(59, "edit"), _ev(66, "new")],
         [_ev(30, "edit"), _ev(70, "edit", 9), _ev(70, "edit", 9), _ev(200, "log")],
         [_ev(61, "edit")]]


def test_late_rows_counted_under_lagging_watermark(spark, tmp):
    rows, dropped = _run_windows(spark, tmp, PROBE, "probe_a")
    assert _type_counts(rows) == [(0, "edit", 3), (1, "edit", 3), (1, "new", 1)]
    assert dropped == 0
    wiki = sorted((r["window"]["start"] // 60000, r["wiki"], r["edits"]) for r in rows if "wiki" in r)
    assert wiki == [(0, "enwiki", 3), (1, "enwiki", 4)]


def test_late_row_dropped(spark, tmp):
    rows, dropped = _run_windows(spark, tmp, PROBE + [[_ev(10, "edit")]], "probe_b")
    assert _type_counts(rows) == [(0, "edit", 3), (1, "edit", 3), (1, "new", 1)]
    # one late event; the single aggregate sees it once per dimension (type, wiki)
    assert dropped == 2


def test_dedup_stream(spark, tmp):
    ce = ce_columns(change_events(spark, SF001))
    dup = inject.with_duplicates(ce)
    src = os.path.join(tmp, "ev")
    # a stream arrives roughly in event-time order: three files of consecutive time ranges
    dup.repartitionByRange(3, "timestamp").sortWithinPartitions("timestamp").write.parquet(src)
    _order_files(src)
    s = read_event_files(spark, src, CHANGE_EVENT_V1, max_files_per_trigger=1)
    q = (dedup_stream(s).writeStream.format("memory").queryName("dedup_s")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("dedup_s")
    n_zero = dup.where(F.col("id") == 0).count()
    n_keys = dup.where(F.col("id") != 0).select("wiki", "id").distinct().count()
    assert got.count() == n_zero + n_keys
    assert throughput(q) >= 0.0


def _order_files(path):
    now = time.time() - 1000
    for i, name in enumerate(sorted(f for f in os.listdir(path) if f.endswith(".parquet"))):
        os.utime(os.path.join(path, name), (now + i, now + i))


def _topic_files(spark, tmp, n_files=3):
    msgs = inject.wire_messages(change_events(spark, SF001))
    path = os.path.join(tmp, "topic")
    msgs.repartition(n_files).write.parquet(path)
    return msgs, path


def test_store_job_idempotent_and_rate_limited(spark, tmp):
    msgs, topic = _topic_files(spark, tmp)
    reg = registry_frame(spark)
    valid, rejected = decode_wire(msgs, reg)
    events_dir, dlq_dir = os.path.join(tmp, "events"), os.path.join(tmp, "dlq")
    for attempt in range(2):          # second run: fresh checkpoint, same batch ids -> no duplicates
        stream = read_topic(spark, "recentchanges", path=topic, max_files_per_trigger=1)
        q = jobs.start_store(spark, stream, events_dir, dlq_dir, reg,
                             checkpoint=os.path.join(tmp, f"ck{attempt}"), trigger={"availableNow": True})
        q.awaitTermination()
        assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3   # one file per batch
        assert read_events(spark, events_dir).count() == valid.count()
        assert spark.read.parquet(dlq_dir).count() == rejected.count()


def test_retry_stream_state_across_batches(spark, tmp):
    src = os.path.join(tmp, "attempts")
    rows = lambda a: [json.dumps({"topic": "t", "partition": 0, "offset": 42, "attempt": x, "failed": True})
                      for x in a]
    _files(src, [rows([1, 2, 3]), rows([4, 5, 6])], ext="json")
    schema = "topic string, partition int, offset long, attempt long, failed boolean"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    q = (retry_stream(s).writeStream.format("memory").queryName("retry_s").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.attempt, r.retry_count, r.to_dlq) for r in spark.table("retry_s").collect())
    assert got == [(1, 0, False), (2, 1, False), (3, 2, False), (4, 3, True), (5, 0, False), (6, 1, False)]


def test_ingest_job(spark, tmp):
    ce = ce_columns(change_events(spark, SF001))
    cap = os.path.join(tmp, "capture")
    inject.sse_capture(ce).coalesce(2).write.text(cap)
    with open(os.path.join(cap, "zz-bad.txt"), "w") as f:
        f.write("data: {broken\n\n" + "data: " + "y" * (1 << 20) + "\n\n")
    topic, dlq = os.path.join(tmp, "topic"), os.path.join(tmp, "dlq")
    q = jobs.start_ingest(spark, cap, topic, dlq, checkpoint=os.path.join(tmp, "ck"),
                          trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(topic)
    valid, rej = decode_wire(out.select("value"), registry_frame(spark))
    assert valid.count() == ce.count() and rej.count() == 0
    assert spark.read.parquet(dlq).count() == 2


def test_store_restart_processes_only_new_files(spark, tmp):
    msgs, topic = _topic_files(spark, tmp, n_files=2)
    reg = registry_frame(spark)
    events_dir, dlq_dir, ck = os.path.join(tmp, "events"), os.path.join(tmp, "dlq"), os.path.join(tmp, "ck")
    run = lambda: jobs.start_store(spark, read_topic(spark, "recentchanges", path=topic), events_dir,
                                   dlq_dir, reg, checkpoint=ck, trigger={"availableNow": True})
    q = run()
    q.awaitTermination()
    first = read_events(spark, events_dir).count()
    more = inject.wire_messages(change_events(spark, SF001).withColumn("id", F.col("id") + 10**6))
    more.write.mode("append").parquet(topic)
    q = run()                          # restart from the same checkpoint
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == more.count()
    assert read_events(spark, events_dir).count() == 2 * first


def test_replay_job_and_paced_replay(spark, tmp):
    from eventide.sinks.parquet import write_events
    ce = ce_columns(change_events(spark, SF001))
    events_dir = os.path.join(tmp, "events")
    write_events(ce, events_dir)
    dry = jobs.replay(spark, events_dir, "2024-01-02", "2024-01-03", dry_run=True).first()
    want = ce.where(F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd")
                    .between("2024-01-02", "2024-01-03")).count()
    assert dry.events == want and dry.files >= 2
    topic = os.path.join(tmp, "topic")
    jobs.replay(spark, events_dir, "2024-01-02", "2024-01-03", topic_dir=topic)
    valid, _ = decode_wire(spark.read.parquet(topic).select("value"), registry_frame(spark))
    assert valid.count() == want


def test_paced_replay_releases_its_rate_and_goes_on_after_a_restart(spark, tmp):
    from eventide.sinks.parquet import write_events
    ce = ce_columns(change_events(spark, SF001))
    events_dir, topic, ck = (os.path.join(tmp, x) for x in ("events", "topic", "ck"))
    write_events(ce.unionByName(ce.limit(3)), events_dir)                 # repeated rows are released each
    want = read_events(spark, events_dir, "2024-01-02", "2024-01-04").count()
    start = lambda: jobs.start_replay_paced(spark, events_dir, topic, "2024-01-02", "2024-01-04", events_per_second=100,
                                            interval_seconds=0.2, checkpoint=ck)
    job = start()
    assert job.ticks == -(-want // 20) > 2
    while not (job.query.lastProgress and job.query.lastProgress["batchId"] >= 1):
        time.sleep(0.05)
    job.query.stop()                                                       # stopped half-way
    start().await_end()
    sent = spark.read.parquet(topic)
    sizes = [r["count"] for r in sent.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sum(sizes) == want and set(sizes[:-1]) == {20} and sizes[-1] <= 20
    last = None
    for low, high in sent.groupBy("batch_id").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")) \
                         .orderBy("batch_id").select("a", "b").collect():
        assert last is None or last <= low
        last = high
    nothing = jobs.start_replay_paced(spark, events_dir, os.path.join(tmp, "none"), "2020-01-01", "2020-01-02", 100,
                                      checkpoint=os.path.join(tmp, "ck2"))
    nothing.await_end()
    assert nothing.ticks == 0 and not os.path.exists(os.path.join(tmp, "none"))


def test_paced_replay_encodes_once_however_many_ticks(spark, tmp, monkeypatch):
    from eventide.sinks.parquet import write_events
    events_dir, topic = os.path.join(tmp, "events"), os.path.join(tmp, "topic")
    write_events(ce_columns(change_events(spark, SF001)), events_dir)
    want = read_events(spark, events_dir, "2024-01-02", "2024-01-04")
    encoded, encode = [], jobs.encode_wire
    monkeypatch.setattr(jobs, "encode_wire", lambda *a: encoded.append(1) or encode(*a))
    monkeypatch.setattr(jobs, "BLOCK_MESSAGES", 30)              # a tick of 20 may lie in two blocks
    job = jobs.start_replay_paced(spark, events_dir, topic, "2024-01-02", "2024-01-04", events_per_second=100,
                                  interval_seconds=0.2, checkpoint=os.path.join(tmp, "ck"))
    job.await_end()
    assert job.ticks > 2 and len(encoded) == 1
    valid, rejected = decode_wire(spark.read.parquet(topic), registry_frame(spark))
    assert rejected.count() == 0
    assert valid.exceptAll(want.select(*valid.columns)).count() == 0 and valid.count() == want.count()


def test_windows_job_from_topic_to_json_files(spark, tmp):
    from eventide.streaming.sources import payloads_from_topic
    from eventide.schema import ENVELOPE
    topic = os.path.join(tmp, "topic")
    rows = [(None, bytearray(_ev(t, typ).encode()), "recentchanges", 0, i, None, [])
            for i, (t, typ) in enumerate([(1, "edit"), (59, "edit"), (66, "new"), (200, "log")])]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.parquet(topic)
    stream = payloads_from_topic(read_topic(spark, "recentchanges", path=topic))
    out = os.path.join(tmp, "agg")
    q = jobs.start_windows(spark, stream, out, checkpoint=os.path.join(tmp, "ck"),
                           trigger={"availableNow": True})
    q.awaitTermination()
    got = [json.loads(r.value) for r in spark.read.text(out).collect()]
    # windows [0,60) and [60,120) are closed by the event at 200 s; [180,240) stays open
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, [
        {"window": {"start": 0, "end": 60000}, "type": "edit", "count": 2},
        {"window": {"start": 0, "end": 60000}, "wiki": "enwiki", "edits": 2},
        {"window": {"start": 60000, "end": 120000}, "type": "new", "count": 1},
        {"window": {"start": 60000, "end": 120000}, "wiki": "enwiki", "edits": 1}]))


def test_observed_counters_in_stream(spark, tmp):
    from eventide.sources.wire import decode_all
    from eventide.streaming.operators import observe_outcomes, observed
    msgs, topic = _topic_files(spark, tmp, n_files=2)
    stream = read_topic(spark, "recentchanges", path=topic, max_files_per_trigger=1)
    dec = observe_outcomes(decode_all(stream, registry_frame(spark)))
    q = (dec.writeStream.format("noop").option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    tot = observed(q)
    valid, rejected = decode_wire(msgs, registry_frame(spark))
    assert tot == {"published": msgs.count(), "consumed": valid.count(), "failed": rejected.count()}


def test_lag_from_progress():
    from eventide.streaming.operators import consumer_lag_from_progress
    p = {"sources": [{"latestOffset": {"recentchanges": {"0": 120, "1": 80}},
                      "endOffset": '{"recentchanges": {"0": 100, "1": 80}}'}]}
    assert consumer_lag_from_progress(p) == 20
    assert consumer_lag_from_progress({"sources": [{"endOffset": {"logOffset": 3}}]}) == 0


def test_store_drops_redelivered_events(spark, tmp):
    msgs, topic = _topic_files(spark, tmp, n_files=1)
    reg = registry_frame(spark)
    valid, rejected = decode_wire(msgs, reg)
    msgs.coalesce(1).write.mode("append").parquet(topic)      # the same messages delivered again
    _order_files(topic)
    events_dir, dlq_dir = os.path.join(tmp, "events"), os.path.join(tmp, "dlq")
    q = jobs.start_store(spark, read_topic(spark, "recentchanges", path=topic, max_files_per_trigger=1),
                         events_dir, dlq_dir, reg, checkpoint=os.path.join(tmp, "ck"),
                         trigger={"availableNow": True})
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    stored = read_events(spark, events_dir)
    n_zero = valid.where(F.col("id") == 0).count()
    # identified events once; events without identity (id 0) are kept each time
    assert stored.count() == valid.count() + n_zero
    assert stored.where(F.col("id") != 0).select("wiki", "id").distinct().count() == \
        stored.where(F.col("id") != 0).count()


def test_top_wikis_stream(spark, tmp):
    src = os.path.join(tmp, "in")
    _files(src, [[_ev(1, "edit", 1, "enwiki"), _ev(2, "edit", 2, "dewiki"), _ev(3, "edit", 3, "dewiki"),
                  _ev(4, "edit", 4, "frwiki"), _ev(5, "edit", 5, "wikidata"), _ev(6, "edit", 6, "frwiki")],
                 [_ev(100, "edit", 7, "enwiki")]])
    payloads = spark.readStream.option("maxFilesPerTrigger", 1).text(src).withColumnRenamed("value", "payload")
    out = os.path.join(tmp, "top")
    q = jobs.start_top_wikis(spark, payloads, out, k=2, checkpoint=os.path.join(tmp, "ck"),
                             trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted((r.window_start, r.rank, r.wiki, r.edits) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1, "dewiki", 2), (0, 2, "frwiki", 2)]     # minute 1 is still open


def test_fresh_checkpoint_never_overwrites_an_earlier_run(spark, tmp):
    reg = registry_frame(spark)
    ce = change_events(spark, SF001)
    first = inject.wire_messages(ce)
    second = inject.wire_messages(ce.withColumn("id", F.col("id") + 10**6))   # other events, same hours
    events_dir, dlq_dir = os.path.join(tmp, "events"), os.path.join(tmp, "dlq")
    counts = []
    for i, msgs in enumerate((first, second)):
        topic = os.path.join(tmp, f"topic{i}")
        msgs.coalesce(1).write.parquet(topic)
        q = jobs.start_store(spark, read_topic(spark, "recentchanges", path=topic), events_dir, dlq_dir, reg,
                             checkpoint=os.path.join(tmp, f"ck{i}"), trigger={"availableNow": True})
        q.awaitTermination()
        counts.append(decode_wire(msgs, reg)[0].count())
    assert read_events(spark, events_dir).count() == sum(counts)
    # the same messages again under a third, fresh checkpoint: nothing new anywhere
    topic = os.path.join(tmp, "topic0")
    q = jobs.start_store(spark, read_topic(spark, "recentchanges", path=topic), events_dir, dlq_dir, reg,
                         checkpoint=os.path.join(tmp, "ck2"), trigger={"availableNow": True})
    q.awaitTermination()
    assert read_events(spark, events_dir).count() == sum(counts)
    rejects = decode_wire(first, reg)[1].count() + decode_wire(second, reg)[1].count()
    assert spark.read.parquet(dlq_dir).count() == rejects
