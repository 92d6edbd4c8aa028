"""Irregular inputs derived from the given tables (FIXTURES §3).

The tables have no duplicates, malformed payloads or broken wire messages,
so the registered queries derive them with fixed, repeatable rules.  Every
input row still flows through the operator under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_duplicates(ce: DataFrame) -> DataFrame:
    """Every tenth event is delivered twice, the copy 5 s later; ids divisible
    by 97 lose their identity (id = 0) and must never be merged."""
    dup = ce.where(F.col("id") % 10 == 0).withColumn("timestamp", F.col("timestamp") + 5)
    both = ce.unionByName(dup)
    return both.withColumn("id", F.when(F.col("id") % 97 == 0, F.lit(0).cast("long"))
                           .otherwise(F.col("id")))


def json_payloads(ce: DataFrame) -> DataFrame:
    """JSON text per event with five kinds of irregularity:
    id % 50 = 0 truncated text, 1 a string id, 2 no timestamp field,
    3 no wiki field, 4 no type field."""
    full = F.to_json(F.struct(*[F.col(c) for c in ce.columns if c != "parsed_timestamp"]))
    m = F.col("id") % 50
    payload = (F.when(m == 0, F.expr("substring(to_json(struct(id, type, wiki)), 1, 12)"))
               .when(m == 1, F.regexp_replace(full, r'^\{"id":[0-9]+', '{"id":"x"'))
               .when(m == 2, F.regexp_replace(full, r',"timestamp":[0-9]+', ""))
               .when(m == 3, F.regexp_replace(full, r',"wiki":"[^"]*"', ""))
               .when(m == 4, F.regexp_replace(full, r',"type":"[^"]*"', ""))
               .otherwise(full))
    return ce.select(F.col("id").alias("source_id"), payload.alias("payload"))


def sse_capture(ce: DataFrame) -> DataFrame:
    """Event-stream text, one frame per event (the text writer adds the final
    newline that ends each frame): ``event:`` and ``id:`` lines, the JSON on a
    ``data: `` line -- split over two ``data: `` lines when id % 25 = 0 --,
    and a comment-only heartbeat frame before every event with id % 30 = 0."""
    js = F.to_json(F.struct(*[F.col(c) for c in ce.columns if c != "parsed_timestamp"]))
    data = F.when(F.col("id") % 25 == 0,
                  F.concat(F.lit("data: "), js.substr(1, 10), F.lit("\n"),
                           F.lit("data: "), js.substr(11, 1 << 30)))
    data = data.otherwise(F.concat(F.lit("data: "), js))
    frame = F.concat(F.lit("event: message\nid: "), F.col("id").cast("string"), F.lit("\n"), data,
                     F.lit("\n"))
    beat = F.when(F.col("id") % 30 == 0, F.lit(": heartbeat\n\n")).otherwise(F.lit(""))
    return ce.select(F.concat(beat, frame).alias("value"))


TOPIC = "recentchanges"
WIKI_PARTITION = {"enwiki": 0, "dewiki": 1, "frwiki": 2, "wikidata": 3}


def wire_messages(ce: DataFrame) -> DataFrame:
    """Broker envelopes of every event, Avro-encoded: odd ids with writer
    schema 1 (v1), even ids with schema 2 (v2: minor = namespace % 2, page_id = id).  Damaged on purpose:
    id % 40 = 0 three bytes, 1 magic byte 0xFF, 2 unknown schema id 999,
    3 the body cut by 3 bytes.  Offset = id, partition by wiki, and messages
    with id % 80 = 0 already carry an older error header."""
    from eventide.functions.columns import event_key
    from eventide.sinks.wire import encode_wire_by, to_envelope
    from eventide.sources.wire import SCHEMA_V1_JSON, SCHEMA_V2_JSON

    versioned = (ce.withColumn("_writer", F.when(F.col("id") % 2 != 0, 1).otherwise(2))
                   .withColumn("minor", (F.col("namespace") % 2).cast("int")).withColumn("page_id", F.col("id")))
    enc = encode_wire_by(versioned, "_writer", {1: SCHEMA_V1_JSON, 2: SCHEMA_V2_JSON}).drop("_writer")
    m = F.col("id") % 40
    v = F.col("value")
    damaged = (F.when(m == 0, F.unhex(F.lit("000102")))
               .when(m == 1, F.concat(F.unhex(F.lit("FF")), F.expr("substring(value, 2)")))
               .when(m == 2, F.concat(F.unhex(F.lit("00000003E7")), F.expr("substring(value, 6)")))
               .when(m == 3, F.expr("substring(value, 1, octet_length(value) - 3)"))
               .otherwise(v))
    part = F.when(F.col("wiki") == "enwiki", 0).when(F.col("wiki") == "dewiki", 1) \
            .when(F.col("wiki") == "frwiki", 2).otherwise(3)
    env = to_envelope(enc.withColumn("value", damaged), TOPIC, event_key(),
                      partition=part, offset=F.col("id"),
                      timestamp=F.timestamp_seconds(F.col("timestamp")))
    old = F.array(F.struct(F.lit("x-error-type").alias("key"),
                           F.lit("sink_error").cast("binary").alias("value")))
    return env.withColumn("headers", F.when(F.col("offset") % 80 == 0, old)
                          .otherwise(F.col("headers")))


def redelivered_topic(ce: DataFrame) -> DataFrame:
    """Wire messages of every event, each delivered twice.  Message number n (the event id) has partition
    n % 4 and offset n / 4, as a broker counts.  n % 97 = 0: the event has no id (0).  Damaged:
    n % 40 = 3 the body cut by 3 bytes, 5 a time of Long.MAX, 6 a negative one, 7 one in milliseconds."""
    from eventide.functions.columns import event_key
    from eventide.sinks.wire import encode_wire, to_envelope
    from eventide.sources.wire import SCHEMA_V1_JSON
    m = F.col("_n") % 40
    late = (F.when(m == 5, F.lit((1 << 63) - 1)).when(m == 6, -F.col("timestamp")).when(m == 7, F.col("timestamp") * 1000)
            .otherwise(F.col("timestamp")))
    rows = (ce.withColumn("_n", F.col("id")).withColumn("_at", F.timestamp_seconds("timestamp"))
              .withColumn("id", F.when(F.col("_n") % 97 == 0, F.lit(0).cast("long")).otherwise(F.col("id")))
              .withColumn("timestamp", late.cast("long")))
    enc = encode_wire(rows, 1, SCHEMA_V1_JSON)
    cut = F.when(F.col("_n") % 40 == 3, F.expr("substring(value, 1, octet_length(value) - 3)")).otherwise(F.col("value"))
    env = to_envelope(enc.withColumn("value", cut), TOPIC, event_key(), partition=F.col("_n") % 4,
                      offset=F.floor(F.col("_n") / 4), timestamp=F.col("_at"))
    # Encoded once, sent twice.
    return env.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_delivery")).drop("_delivery")


def legacy_dlq(dlq: DataFrame) -> DataFrame:
    """Dead-letter rows from an older writer lack ``x-original-topic`` (offset % 80 = 3)."""
    stripped = F.filter("headers", lambda h: h["key"] != F.lit("x-original-topic"))
    return dlq.withColumn("headers", F.when(F.col("offset") % 80 == 3, stripped)
                          .otherwise(F.col("headers")))


def schema_versions(events: DataFrame) -> DataFrame:
    """A schema registry with one version per event, numbered by its id, below
    its user's subject.  By the id: field ``id`` is int, long or a union with
    null (n % 3); ``title`` is bytes (n % 5 = 0) or string; ``minor`` is there
    if n is even, with a default if n % 4 = 0; ``score`` is float (n % 7 = 1) or
    null-or-double with default null (n % 7 = 2), else missing; n % 50 = 7 is
    an enum, no record."""
    n = F.col("event_id")
    kind = F.when(n % 3 == 0, F.lit('"int"')).when(n % 3 == 1, F.lit('"long"')).otherwise(F.lit('["null","long"]'))
    title = F.when(n % 5 == 0, F.lit('"bytes"')).otherwise(F.lit('{"type":"string"}'))
    minor = F.when(n % 4 == 0, F.lit('{"name":"minor","type":"int","default":0}')) \
             .when(n % 4 == 2, F.lit('{"name":"minor","type":"int"}'))
    score = F.when(n % 7 == 1, F.lit('{"name":"score","type":"float"}')) \
             .when(n % 7 == 2, F.lit('{"name":"score","type":["null","double"],"default":null}'))
    fields = F.concat_ws(",", F.concat(F.lit('{"name":"id","type":'), kind, F.lit("}")),
                         F.concat(F.lit('{"name":"title","type":'), title, F.lit("}")), minor, score)
    record = F.concat(F.lit('{"type":"record","name":"Event","fields":['), fields, F.lit("]}"))
    enum = F.lit('{"type":"enum","name":"Event","symbols":["A"]}')
    return events.select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("subject"),
                         n.cast("int").alias("version"), F.when(n % 50 == 7, enum).otherwise(record).alias("schema"))
