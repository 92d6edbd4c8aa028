"""Scalar column functions (P1-P9, K5).  All are built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.schema import STRING_COLUMNS

# Error classification keywords, first matching group wins.
DECODE_KEYWORDS = ["decode", "unmarshal", "parse"]
SINK_KEYWORDS = ["write", "flush", "sink"]
DECODE_ERROR = "decode_error"
SINK_ERROR = "sink_error"
UNKNOWN_ERROR = "unknown"

# Dead-letter header names, in the order they are written.
H_ERROR_TYPE = "x-error-type"
H_ERROR_MESSAGE = "x-error-message"
H_ORIGINAL_TOPIC = "x-original-topic"
H_RETRY_COUNT = "x-retry-count"
H_ORIGINAL_TIMESTAMP = "x-original-timestamp"
H_ERROR_STAGE = "x-error-stage"

# Estimated in-memory size of a stored row: these strings plus a fixed 64.
SIZE_STRING_COLUMNS = ["type", "title", "title_url", "comment", "user", "server_url",
                       "server_name", "server_script_url", "wiki"]
ROW_OVERHEAD_BYTES = 64


# Epoch seconds that can be a time: from 1970 to the year 9999.  Milliseconds fall outside.
TS_MAX = 253_402_300_799
TS_RANGE_ERROR = "parse: timestamp is out of range"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_key(wiki="wiki", title="title") -> Column:
    """``wiki/title``; absent parts are the empty string."""
    return F.concat(F.coalesce(_c(wiki), F.lit("")), F.lit("/"), F.coalesce(_c(title), F.lit("")))


def zero_fill(df):
    """Absent strings become "" (the zero value), absent numbers 0, bool false."""
    fills = {c: "" for c in STRING_COLUMNS if c in df.columns}
    fills.update({c: 0 for c in ("id", "namespace", "timestamp") if c in df.columns})
    out = df.fillna(fills)
    if "bot" in df.columns:
        out = out.withColumn("bot", F.coalesce(F.col("bot"), F.lit(False)))
    return out


def epoch_to_utc(c="parsed_timestamp") -> Column:
    """P2 read side: epoch seconds -> timestamp (UTC instant)."""
    return F.timestamp_seconds(_c(c))


def utc_to_epoch(c) -> Column:
    """P2 write side: timestamp -> whole epoch seconds (sub-seconds truncated)."""
    return F.unix_seconds(_c(c))


def ntz_from_epoch(c="timestamp") -> Column:
    """Epoch seconds as a zone-less timestamp (wall clock in UTC), so that
    formatting does not depend on the session time zone; NULL if they are no event time."""
    at = F.when(_c(c).between(0, TS_MAX), _c(c))
    return F.timestamp_add("SECOND", at, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_text(c="parsed_timestamp") -> Column:
    """Epoch seconds rendered as ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return F.date_format(ntz_from_epoch(c), "yyyy-MM-dd HH:mm:ss")


def error_type(message="error_message") -> Column:
    """Classify an error message; case-sensitive substring tests, first match wins."""
    m = _c(message)
    decode = None
    for k in DECODE_KEYWORDS:
        decode = m.contains(k) if decode is None else decode | m.contains(k)
    sink = None
    for k in SINK_KEYWORDS:
        sink = m.contains(k) if sink is None else sink | m.contains(k)
    return (F.when(decode, F.lit(DECODE_ERROR))
            .when(sink, F.lit(SINK_ERROR))
            .otherwise(F.lit(UNKNOWN_ERROR)))


def should_dlq(retry_count="retry_count", max_retries=3) -> Column:
    """Route to the dead-letter queue once the count reaches the maximum."""
    mr = max_retries if isinstance(max_retries, Column) else F.lit(max_retries)
    return _c(retry_count) >= mr


def header(key: str, headers="headers") -> Column:
    """P5: value of the first header named ``key`` as a string, "" if absent."""
    first = F.get(F.filter(_c(headers), lambda h: h["key"] == F.lit(key)), 0)
    return F.coalesce(first["value"].cast("string"), F.lit(""))


def dt_col(ts_seconds="timestamp") -> Column:
    """``yyyy-MM-dd`` of an epoch-seconds column in UTC."""
    return F.date_format(ntz_from_epoch(ts_seconds), "yyyy-MM-dd")


def hour_col(ts_seconds="timestamp") -> Column:
    """Two-digit UTC hour of an epoch-seconds column."""
    return F.date_format(ntz_from_epoch(ts_seconds), "HH")


def event_time(ts_seconds="timestamp") -> Column:
    """Event time as TimestampType (watermarks need a zoned timestamp); NULL if it is none."""
    return F.timestamp_seconds(F.when(_c(ts_seconds).between(0, TS_MAX), _c(ts_seconds)))


def estimated_bytes(*cols: str) -> Column:
    """K5: UTF-8 byte length of the nine string columns plus a fixed overhead."""
    cols = cols or tuple(SIZE_STRING_COLUMNS)
    total = F.lit(ROW_OVERHEAD_BYTES).cast("long")
    for c in cols:
        total = total + F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long")
    return total


def window_start_ms(ts_seconds="timestamp", width_seconds: int = 60) -> Column:
    """Epoch-aligned tumbling window start, in epoch milliseconds."""
    ts = _c(ts_seconds).cast("long")
    return (ts - F.pmod(ts, F.lit(width_seconds).cast("long"))) * F.lit(1000).cast("long")
