"""Broker coordinates as identity: ranges, the manifest, and the store job on re-deliveries (K6);
times that are none (S4, P8, P9); a broker that is named but not there."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import offsets
from eventide.plans import inject, jobs
from eventide.sources.replay import read_events
from eventide.sources.tables import ce_columns, change_events
from eventide.sources.wire import decode_all, decode_wire, registry_frame
from eventide.streaming.sources import read_topic
from tests.conftest import SF001

COORDS = "topic string, partition int, offset long"


def _ranges(df):
    return sorted(tuple(r) for r in df.select("topic", "partition", "first", "last").collect())


def _brute(cells):
    out = []
    for t, p, o in sorted(cells):
        if out and out[-1][:2] == (t, p) and out[-1][3] == o - 1:
            out[-1] = (*out[-1][:3], o)
        else:
            out.append((t, p, o, o))
    return out


def test_ranges_match_brute_force(spark):
    rng = random.Random(1)
    cells = {(rng.choice("ab"), rng.randint(0, 1), rng.randint(0, 400)) for _ in range(500)}
    rows = [*cells, *list(cells)[:50], ("a", None, 3), ("a", 0, None), (None, 0, 7)]
    df = spark.createDataFrame(rows, COORDS)
    assert _ranges(offsets.offset_ranges(df, chunk=16)) == _brute(cells)
    halves = [spark.createDataFrame(list(cells)[i::2], COORDS) for i in range(2)]
    both = offsets.offset_ranges(halves[0]).unionByName(offsets.offset_ranges(halves[1], chunk=7))
    assert _ranges(offsets.merge_ranges(both)) == _brute(cells)
    assert _ranges(offsets.offset_ranges(df.limit(0))) == []
    spans = _ranges(offsets.offset_spans(df))
    assert [s[:2] for s in spans] == sorted({c[:2] for c in cells}) and spans[0][3] == max(o for t, p, o in cells if (t, p) == spans[0][:2])


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 16])
def test_merged_ranges_cross_chunks(spark, chunk):
    rng = random.Random(3)
    spans = [("a", rng.randint(0, 1), lo, lo + rng.choice((0, 0, 1, 3, 40))) for lo in (rng.randint(0, 600) for _ in range(150))]
    spans += [("b", 0, 10, 500), ("b", 0, 20, 30), ("b", 0, 501, 501), ("b", 0, 503, 503)]
    cells = {(t, p, o) for t, p, lo, hi in spans for o in range(lo, hi + 1)}
    assert _ranges(offsets.merge_ranges(spark.createDataFrame(spans, offsets.RANGES), chunk=chunk)) == _brute(cells)


def test_scattered_ranges_are_not_written_by_one_task(spark, tmp):
    every = spark.range(200_000).selectExpr("'t' AS topic", "0 AS partition", "id * 2 AS offset")     # no two adjoin
    root = os.path.join(tmp, "_offsets")
    spark.conf.set("spark.sql.adaptive.enabled", "false")             # else so few rows share a task
    try:
        offsets.commit(spark, root, "r", 0, offsets.offset_ranges(every, chunk=1 << 14))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.read.parquet(os.path.join(root, "run=r", "batch=0000000000")).count() == 200_000
    assert len([f for f in os.listdir(os.path.join(root, "run=r", "batch=0000000000")) if f.startswith("part-")]) > 1


@pytest.mark.parametrize("bucket", [8, 1 << 20])
def test_covered_messages_are_dropped(spark, bucket):
    rng = random.Random(2)
    stored = {("a", p, o) for p in (0, 1) for o in range(200) if rng.random() < 0.5}
    ranges = offsets.offset_ranges(spark.createDataFrame(list(stored), COORDS))
    new = [(t, p, o) for t in ("a", "b") for p in (0, 1, 2) for o in range(50, 260)] + [("a", 0, None), (None, None, None)]
    got = offsets.drop_covered(spark.createDataFrame(new, COORDS), ranges, bucket=bucket).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, (c for c in new if c not in stored)))


def test_manifest_holds_one_snapshot_per_run_and_hides_a_batch_from_itself(spark, tmp):
    root = os.path.join(tmp, "_offsets")
    part = lambda lo, hi: spark.createDataFrame([("t", 0, lo, hi)], offsets.RANGES)
    assert offsets.committed(spark, root, "r", 0) is None
    for n in range(6):
        offsets.commit(spark, root, "r", n, part(10 * n, 10 * n + 9))
    assert sorted(os.listdir(os.path.join(root, "run=r"))) == ["batch=0000000004", "batch=0000000005"]
    assert _ranges(offsets.committed(spark, root, "r", 6)) == [("t", 0, 0, 59)]
    assert _ranges(offsets.committed(spark, root, "r", 5)) == [("t", 0, 0, 49)]        # batch 5 again
    offsets.commit(spark, root, "r", 5, part(50, 59))
    offsets.commit(spark, root, "other", 0, part(100, 120))
    assert _ranges(offsets.committed(spark, root, "r", 6)) == [("t", 0, 0, 59), ("t", 0, 100, 120)]
    assert _ranges(offsets.committed(spark, root, "other", 0)) == [("t", 0, 0, 59)]


def test_store_job_keeps_one_of_each_delivery(spark, tmp):
    reg = registry_frame(spark)
    ce = ce_columns(change_events(spark, SF001)).withColumn("id", F.col("id") + 1)
    msgs = inject.redelivered_topic(ce).persist()
    once = msgs.dropDuplicates(["partition", "offset"])
    valid, rejected = decode_wire(once, reg)
    topic, events, dlq = (os.path.join(tmp, x) for x in ("topic", "events", "dlq"))
    msgs.repartition(3).write.parquet(topic)
    for run in range(3):              # the third time with all messages in one batch
        stream = read_topic(spark, inject.TOPIC, path=topic, max_files_per_trigger=1 if run < 2 else None)
        jobs.start_store(spark, stream, events, dlq, reg, checkpoint=os.path.join(tmp, f"ck{run}"),
                         trigger={"availableNow": True}).awaitTermination()
        stored = read_events(spark, events)
        assert stored.count() == valid.count()
        assert stored.where("id = 0").count() == valid.where("id = 0").count() > 5
        assert spark.read.parquet(dlq).count() == rejected.count() > 0
    source = spark.read.parquet(events).select("source_topic", "source_partition", "source_offset")
    assert source.distinct().count() == valid.count()
    files = [f for _, _, names in os.walk(os.path.join(events, "_offsets")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 3 * 2        # two snapshots a run, however much is stored
    assert _ranges(offsets.committed(spark, os.path.join(events, "_offsets"), "none", 0)) == \
        _ranges(offsets.offset_ranges(once))


def test_nameless_events_with_a_message_each_stay(spark):
    from eventide.operators.dedup import dedup_events
    from eventide.schema import CHANGE_EVENT_V1
    row = (0, "edit", 0, "T", "T", "", 1718000000, "u", False, "s", "n", "w", "enwiki", 1718000000)
    schema = T.StructType([*CHANGE_EVENT_V1.fields, T.StructField("source_topic", T.StringType()),
                           T.StructField("source_partition", T.IntegerType()), T.StructField("source_offset", T.LongType())])
    tagged = spark.createDataFrame([(*row, "t", 0, o) for o in (0, 0, 1, None, None)], schema)
    got = sorted(str(r.source_offset) for r in dedup_events(tagged, delivery=jobs.SOURCE).collect())
    assert got == ["0", "1", "None", "None"]


def test_times_that_are_none_are_rejects(spark):
    ce = ce_columns(change_events(spark, SF001))
    msgs = inject.redelivered_topic(ce)
    bad = decode_all(msgs, registry_frame(spark), keep=("partition", "offset")).where("error_message is not null")
    kinds = {(r.offset * 4 + r.partition) % 40: r.error_message for r in bad.collect()}
    assert set(kinds) == {3, 5, 6, 7}
    assert {kinds[k] for k in (5, 6, 7)} == {"parse: timestamp is out of range"} and kinds[3].startswith("avro unmarshal")


def test_no_time_stops_the_columns(spark):
    from eventide.functions import columns as C
    rows = spark.createDataFrame([(0,), (253402300799,), (253402300800,), (-1,), ((1 << 63) - 1,), (None,)], "timestamp long")
    got = rows.select(C.dt_col(), C.hour_col(), C.event_time(), C.utc_text("timestamp")).collect()
    assert [r[0] for r in got] == ["1970-01-01", "9999-12-31", None, None, None, None]
    assert [r[2] is None for r in got] == [False, False, True, True, True, True]


def test_a_broker_without_connector_is_an_error(spark, tmp):
    env = inject.wire_messages(change_events(spark, SF001)).limit(1)
    with pytest.raises(ValueError, match="connector"):
        jobs._write_batch(env, tmp, "r-0", "t", "broker:9092")
    with pytest.raises(ValueError, match="connector"):
        jobs._write_dlq(env, tmp, "r-0", "broker:9092")
    with pytest.raises(ValueError, match="connector"):
        jobs.start_windows(spark, spark.readStream.text(tmp).withColumnRenamed("value", "payload"), None, bootstrap_servers="broker:9092")


def test_redelivered_messages_are_encoded_once(spark):
    """Every message lies there twice, byte for byte, from one pass of the encoder."""
    from eventide.schema import CHANGE_EVENT_V1
    rows = [(n, "edit", 0, f"P{n}", "u", None, 1_700_000_000 + n, "x", False, "s", "s", "s", "enwiki", n) for n in range(1, 60)]
    topic = inject.redelivered_topic(spark.createDataFrame(rows, CHANGE_EVENT_V1))
    plan = topic._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    seen = topic.groupBy("partition", "offset", "key", "value", "timestamp").count().collect()
    assert len(seen) == 59 and {r["count"] for r in seen} == {2}
