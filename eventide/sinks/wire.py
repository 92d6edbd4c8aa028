"""Wire encoding, broker envelopes and dead-letter messages (K1, K2, K7).

``publish`` writes the envelope columns with Spark's Kafka sink when the
connector is on the classpath; tests and clusters without it write the
same columns to Parquet under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import avro
from eventide.functions import columns as C
from eventide.operators.joins import spread_for_python

# Partitions of a topic that is kept as a directory.
TOPIC_PARTITIONS = 12


def header_bytes(schema_id: int) -> bytes:
    """Magic byte 0x00 and the schema id as 4 big-endian bytes."""
    return b"\x00" + int(schema_id).to_bytes(4, "big", signed=False)


def encode_wire(df: DataFrame, schema_id: int, schema_json: str, out: str = "value") -> DataFrame:
    """K2: append ``out`` = wire message of each row under the given writer schema.

    Fields the row lacks are written as their zero value (v2's ``minor`` = 0,
    ``page_id`` = null).  The Avro body comes from an Arrow-batched task
    function; the 5-byte header is concatenated JVM-side.
    """
    fields = avro.parse_schema(schema_json)
    body_schema = T.StructType(df.schema.fields + [T.StructField("_body", T.BinaryType())])
    enc = spread_for_python(df).mapInArrow(avro.encoder(fields, "_body"), body_schema)
    return enc.withColumn(out, F.concat(F.lit(bytearray(header_bytes(schema_id))), F.col("_body"))) \
              .drop("_body")


def encode_wire_by(df: DataFrame, schema_id_col: str, schemas: dict, out: str = "value") -> DataFrame:
    """K2 with a writer schema per row: ``schema_id_col`` names the schema id
    (``schemas``: id -> schema JSON).  One pass; the header carries each row's id."""
    fields = {int(k): avro.parse_schema(v) for k, v in schemas.items()}
    body_schema = T.StructType(df.schema.fields + [T.StructField("_body", T.BinaryType())])
    enc = spread_for_python(df).mapInArrow(avro.encoder_by_schema(fields, schema_id_col, "_body"),
                                           body_schema)
    header = F.concat(F.unhex(F.lit("00")),
                      F.unhex(F.lpad(F.hex(F.col(schema_id_col).cast("long")), 8, "0")))
    return enc.withColumn(out, F.concat(header, F.col("_body"))).drop("_body")


def to_envelope(df: DataFrame, topic: str, key: Column, value: str = "value",
                partitions: int = TOPIC_PARTITIONS, partition: Column | None = None,
                offset: Column | None = None, timestamp: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """K1 shape: key, value, topic, partition, offset, timestamp, headers; and the columns ``keep``.

    Same key -> same partition (``pmod(hash(key), partitions)``) of a topic
    directory; a broker partitions by the key itself.  A broker also assigns
    real offsets, so callers that model a topic pass them in.
    """
    if partition is None:
        partition = F.pmod(F.hash(key), F.lit(partitions)).cast("int")
    return df.select(
        key.cast("binary").alias("key"),
        F.col(value).alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"),
        *keep,
    )


def kafka_available(spark) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def use_broker(spark, bootstrap_servers: str | None) -> bool:
    """Whether to write to a broker; one that is named but cannot be reached through Spark is an error."""
    if bootstrap_servers and not kafka_available(spark):
        raise ValueError("broker given, but Spark's Kafka connector is not on the classpath")
    return bool(bootstrap_servers)


def publish(df: DataFrame, topic: str | None = None, path: str | None = None,
            bootstrap_servers: str | None = None) -> None:
    """K1: write (key, value[, topic, headers]) to Kafka, or to Parquet at ``path``."""
    cols = [c for c in ("key", "value", "topic", "partition", "offset", "timestamp", "headers") if c in df.columns]
    out = df.select(*cols)
    if use_broker(df.sparkSession, bootstrap_servers):
        # The broker's partitioner hashes the key; offsets and times are the broker's.
        w = out.drop("partition", "offset", "timestamp").write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers) \
                     .option("kafka.acks", "all")
        if topic:
            w = w.option("topic", topic)
        w.save()
        return
    if not path:
        raise ValueError("no Kafka connector/servers: give a Parquet path")
    out.write.mode("append").parquet(path)


def dlq_headers(error_message: Column, original_topic: Column, original_ts: Column,
                stage: Column | str = "decode", retry_count: Column | int = 0) -> Column:
    """K7/D11 headers, newest first: type, message, topic, retry count, timestamp, stage."""
    def h(k, v):
        return F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
    stage_c = F.lit(stage) if isinstance(stage, str) else stage
    retry_c = F.lit(retry_count) if isinstance(retry_count, int) else retry_count
    return F.array(
        h(C.H_ERROR_TYPE, C.error_type(error_message)),
        h(C.H_ERROR_MESSAGE, error_message),
        h(C.H_ORIGINAL_TOPIC, original_topic),
        h(C.H_RETRY_COUNT, retry_c.cast("string")),
        h(C.H_ORIGINAL_TIMESTAMP, original_ts),
        h(C.H_ERROR_STAGE, stage_c),
    )


def to_dlq(rejected: DataFrame, dlq_topic: str = "recentchanges-dlq",
           stage: str = "decode", ts_col: str = "timestamp") -> DataFrame:
    """K7: rejected envelopes (with ``error_message``) -> dead-letter envelopes.

    Key and value are kept byte for byte; the error headers are prepended to
    the original headers, so the newest context is found first (P5).
    ``x-original-timestamp`` is the failed message's broker time in UTC (D11).
    """
    ts_text = F.date_format(C.ntz_from_epoch(F.unix_seconds(F.col(ts_col))), "yyyy-MM-dd HH:mm:ss")
    retry = F.col("retry_count") if "retry_count" in rejected.columns else F.lit(0)
    new = dlq_headers(F.col("error_message"), F.col("topic"), ts_text, stage, retry)
    old = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    return rejected.select(
        "key", "value", F.lit(dlq_topic).alias("topic"),
        F.col("partition"), F.col("offset"), F.col(ts_col).alias("timestamp"),
        F.concat(new, old).alias("headers"))
