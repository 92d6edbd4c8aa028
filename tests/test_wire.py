from pyspark.sql import functions as F

from eventide.functions import avro
from eventide.schema import CHANGE_EVENT_V1, CHANGE_EVENT_V2, ENVELOPE
from eventide.sinks.wire import encode_wire, header_bytes, to_dlq
from eventide.sources.wire import (SCHEMA_V1_JSON, SCHEMA_V2_JSON, decode_wire, lookup_schema,
                                   registry_frame, wire_envelope)

EVENT = dict(id=123, type="edit", namespace=0, title="Test Article", title_url="Test_Article",
             comment="c", timestamp=1700000000, user="u", bot=False, server_url="s", server_name="n",
             server_script_url="/w", wiki="enwiki", parsed_timestamp=1705314600)  # 2024-01-15 10:30:00


def _one(spark, schema=CHANGE_EVENT_V1, **over):
    row = dict(EVENT, **over)
    return spark.createDataFrame([tuple(row[f.name] for f in CHANGE_EVENT_V1.fields)], CHANGE_EVENT_V1)


def test_codec_round_trip_python():
    fields = avro.parse_schema(SCHEMA_V2_JSON)
    body = avro.encode_record(fields, dict(EVENT, minor=1, page_id=None))
    assert avro.decode_record(fields, body) == dict(EVENT, minor=1, page_id=None)
    body = avro.encode_record(fields, dict(EVENT, minor=0, page_id=-5))
    assert avro.decode_record(fields, body)["page_id"] == -5


def test_round_trip_spark(spark):
    enc = encode_wire(_one(spark), 1, SCHEMA_V1_JSON)
    v = enc.first().value
    assert v[0] == 0 and len(v) >= 5 and bytes(v[:5]) == header_bytes(1)
    valid, rejected = decode_wire(enc.select("value"), registry_frame(spark))
    assert rejected.count() == 0
    assert valid.first().asDict() == EVENT


def test_short_and_bad_magic(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x01\x02"),), (bytearray(b"\xff\x00\x00\x00\x01\x00"),)],
                               "value binary")
    _, rejected = decode_wire(df, registry_frame(spark))
    msgs = sorted(r.error_message for r in rejected.collect())
    assert msgs == ["bad magic byte: 0xff", "short message: 3 bytes"]


def test_registry_hit_and_miss(spark):
    reg = registry_frame(spark, [(42, "test-value", 1,
                                  '{"type":"record","name":"Test","fields":[{"name":"x","type":"long"}]}')])
    df = spark.createDataFrame([(42,), (999,)], "schema_id int")
    got = {r.schema_id: r.found for r in lookup_schema(df, reg).collect()}
    assert got == {42: True, 999: False}
    unknown = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x03\xe7\x02"),)], "value binary")
    _, rej = decode_wire(unknown, reg)
    assert rej.first().error_message == "get schema 999: schema not found"


def test_v1_written_read_as_v2_and_back(spark):
    v1 = encode_wire(_one(spark, id=456), 1, SCHEMA_V1_JSON).select("value")
    valid, _ = decode_wire(v1, registry_frame(spark), target=CHANGE_EVENT_V2)
    r = valid.first()
    assert (r.id, r.minor, r.page_id) == (456, 0, None)
    v2src = _one(spark, id=789).withColumn("minor", F.lit(1)).withColumn("page_id", F.lit(77).cast("long"))
    v2 = encode_wire(v2src, 2, SCHEMA_V2_JSON).select("value")
    back, _ = decode_wire(v2, registry_frame(spark), target=CHANGE_EVENT_V1)
    assert back.columns == CHANGE_EVENT_V1.fieldNames() and back.first().id == 789
    as_v2, _ = decode_wire(v2, registry_frame(spark), target=CHANGE_EVENT_V2)
    assert (as_v2.first().minor, as_v2.first().page_id) == (1, 77)


def test_truncated_body(spark):
    enc = encode_wire(_one(spark), 1, SCHEMA_V1_JSON)
    cut = enc.select(F.expr("substring(value, 1, octet_length(value) - 2)").alias("value"))
    _, rej = decode_wire(cut, registry_frame(spark))
    assert rej.first().error_message.startswith("avro unmarshal:")


def test_dlq_headers_prepended(spark):
    env = wire_envelope(spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"\x00\x01"), "recentchanges", 0, 5, None,
          [("x-error-type", bytearray(b"sink_error"))])], ENVELOPE))
    env = env.withColumn("timestamp", F.timestamp_seconds(F.lit(1718000000))) \
             .withColumn("error_message", F.col("envelope_error"))
    dlq = to_dlq(env).first()
    keys = [h.key for h in dlq.headers]
    assert keys[:6] == ["x-error-type", "x-error-message", "x-original-topic", "x-retry-count",
                        "x-original-timestamp", "x-error-stage"]
    assert keys[6] == "x-error-type" and bytes(dlq.headers[6].value) == b"sink_error"
    assert bytes(dlq.headers[4].value) == b"2024-06-10 06:13:20"
    assert bytes(dlq.key) == b"k" and bytes(dlq.value) == b"\x00\x01"


def test_vectorized_codec_equals_scalar():
    import random

    import pyarrow as pa

    from eventide.functions import avro_vec
    random.seed(0)
    for sj in (SCHEMA_V1_JSON, SCHEMA_V2_JSON):
        fields = avro.parse_schema(sj)
        rows = [dict(EVENT, id=random.choice([0, -1, 2**40, -2**62]), title="é" * random.randrange(0, 300),
                     namespace=random.randrange(-2**31, 2**31), bot=random.random() < .5,
                     minor=random.randrange(0, 3), page_id=random.choice([None, 5, -7, 2**50]))
                for _ in range(300)]
        ref = [avro.encode_record(fields, r) for r in rows]
        assert avro_vec.encode_batch(pa.RecordBatch.from_pylist(rows), fields).to_pylist() == ref
        hdr = b"\x00\x00\x00\x00\x01"
        vals = pa.array([hdr + b for b in ref] + [hdr + ref[0][:-2], hdr + ref[1] + b"x"], type=pa.binary())
        out_fields = [pa.field(f.name, {"long": pa.int64(), "integer": pa.int32(), "string": pa.string(),
                                        "boolean": pa.bool_()}[f.dataType.typeName()])
                      for f in CHANGE_EVENT_V2.fields]
        cols, errs = avro_vec.decode_batch(vals, fields, out_fields)
        names = [f.name for f in out_fields]
        for i, b in enumerate(ref):
            d = avro.decode_record(fields, b)
            assert {k: cols[names.index(k)][i].as_py() for k in d} == d and errs[i] is None
        assert errs[-2:] == ["avro unmarshal: unexpected end of data", "avro unmarshal: trailing bytes"]


def test_encode_by_schema_matches_single_schema(spark):
    from eventide.sinks.wire import encode_wire_by
    df = spark.createDataFrame([tuple(dict(EVENT, id=i)[f.name] for f in CHANGE_EVENT_V1.fields)
                                for i in range(40)], CHANGE_EVENT_V1).withColumn(
        "_w", F.when(F.col("id") % 3 == 0, 2).otherwise(1))
    got = {r.id: bytes(r.value) for r in encode_wire_by(df, "_w", {1: SCHEMA_V1_JSON, 2: SCHEMA_V2_JSON})
           .select("id", "value").collect()}
    v1 = {r.id: bytes(r.value) for r in encode_wire(df.where("_w = 1").drop("_w"), 1, SCHEMA_V1_JSON).collect()}
    v2 = {r.id: bytes(r.value) for r in encode_wire(df.where("_w = 2").drop("_w"), 2, SCHEMA_V2_JSON).collect()}
    assert got == {**v1, **v2}


def test_headers_out_of_range_are_rejects(spark):
    from eventide.sources.wire import decode_all, registry_frame
    rows = [(bytearray.fromhex(h),) for h in ("00FFFFFFFF00", "FFFFFFFFFF00", "")] + [(None,)]
    df = spark.createDataFrame(rows, "value binary")
    got = sorted(r.error_message for r in decode_all(df, registry_frame(spark)).collect())
    assert got == ["bad magic byte: 0xff", "get schema 4294967295: schema not found",
                   "short message: 0 bytes", "short message: 0 bytes"]
