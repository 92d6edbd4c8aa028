"""Streaming sources.

The broker source is Spark's Kafka connector when it is on the classpath.
Without it (tests, this image) the same envelope schema is read as a file
stream of Parquet files, one file per produced batch.  Rate limits map to
``maxOffsetsPerTrigger`` (Kafka) or ``maxFilesPerTrigger`` (files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.schema import ENVELOPE
from eventide.sinks.wire import kafka_available

# Fixed value: the source system's fetch size.
MAX_FETCH_BYTES = 10 * 1024 * 1024


def read_topic(spark: SparkSession, topic: str, path: str | None = None,
               bootstrap_servers: str | None = None, starting_offsets: str = "latest",
               max_offsets_per_trigger: int | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A topic as a streaming DataFrame of broker envelopes; without a
    limit a trigger takes all that is new."""
    if bootstrap_servers:
        if not kafka_available(spark):
            raise ValueError("broker given, but Spark's Kafka connector is not on the classpath")
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic)
             .option("startingOffsets", starting_offsets)
             .option("includeHeaders", "true")
             .option("kafka.max.partition.fetch.bytes", str(MAX_FETCH_BYTES)))
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
        return r.load()
    if not path:
        raise ValueError("no Kafka connector/servers: give the directory the topic is written to")
    r = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def read_event_files(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Stored events (or any fixed-schema files) as a stream, so many files per trigger."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.format(fmt).load(path)


def clock(spark: SparkSession, interval_seconds: float) -> DataFrame:
    """Ticks 0, 1, 2, ... (``value``), one in each micro-batch, whatever the triggers do."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
            .option("advanceMillisPerBatch", max(1, int(interval_seconds * 1000))).load())


def payloads_from_topic(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON payloads of a topic whose values are UTF-8 text (the windowing job's input)."""
    from pyspark.sql import functions as F
    return messages.select(F.col(value).cast("string").alias("payload"))


def read_dlq(spark: SparkSession, topic: str = "recentchanges-dlq", path: str | None = None,
             bootstrap_servers: str | None = None, starting_offsets: str = "latest") -> DataFrame:
    """The dead-letter topic as a stream (new messages only by default)."""
    return read_topic(spark, topic, path=path, bootstrap_servers=bootstrap_servers,
                      starting_offsets=starting_offsets, max_offsets_per_trigger=None)
