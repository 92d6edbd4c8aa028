"""The Kafka branches, as far as they can run without the connector: with the
connector reported present, readers and writers must ask Spark for the
``kafka`` source/sink (which then fails here because it is not installed)."""

import pytest

from eventide.schema import ENVELOPE


def _kafka_missing(e: Exception) -> bool:
    return "kafka" in str(e).lower()


def test_read_topic_uses_kafka_source(spark, monkeypatch):
    from eventide.streaming import sources
    monkeypatch.setattr(sources, "kafka_available", lambda s: True)
    with pytest.raises(Exception) as e:
        sources.read_topic(spark, "recentchanges", bootstrap_servers="broker:9092")
    assert _kafka_missing(e.value)


def test_publish_uses_kafka_sink(spark, monkeypatch):
    from eventide.sinks import wire
    monkeypatch.setattr(wire, "kafka_available", lambda s: True)
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v"), "t", 0, 1, None, [])], ENVELOPE)
    with pytest.raises(Exception) as e:
        wire.publish(df, "recentchanges", bootstrap_servers="broker:9092")
    assert _kafka_missing(e.value)


def test_without_connector_paths_are_required(spark):
    from eventide.sinks import wire
    from eventide.streaming import sources
    with pytest.raises(ValueError):
        sources.read_topic(spark, "recentchanges")
    df = spark.createDataFrame([], ENVELOPE)
    with pytest.raises(ValueError):
        wire.publish(df, "recentchanges")


def test_spark_avro_engine_is_requested_when_chosen(spark):
    """Without Spark's Avro module the engine switch must fail on the missing
    module (the default Arrow engine is the tested one)."""
    from eventide.sources.wire import avro_available, decode_all, registry_frame
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01\x02"),)], "value binary")
    assert avro_available(spark) is False
    with pytest.raises(Exception) as e:
        decode_all(df, registry_frame(spark), engine="spark-avro").collect()
    assert "avro" in str(e.value).lower()
    assert decode_all(df, registry_frame(spark), engine="auto").count() == 1
