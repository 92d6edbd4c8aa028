"""Server-sent-event captures and JSON change events.

S1 splits a capture into frames with Spark's own text reader (the record
separator is the blank line), so a large capture is split across tasks
like any text file.  S2 is ``from_json`` in PERMISSIVE mode with a corrupt
record column: the JVM parser does all the work, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import TS_MAX, TS_RANGE_ERROR
from eventide.schema import CHANGE_EVENT_COLUMNS, JSON_PAYLOAD, STRING_COLUMNS

CORRUPT = "_corrupt"
DATA_PREFIX = "data: "
PARSE_ERROR = "json unmarshal: payload is not a valid change event"
MISSING_TS_ERROR = "parse: timestamp field is missing"
UNKNOWN = "unknown"


def frames_to_payloads(frames: DataFrame, col: str = "value") -> DataFrame:
    """Payload of each frame that has one: its ``data: `` lines, prefix removed,
    joined with no separator.  Lines may have any length."""
    lines = F.split(F.col(col), "\r?\n")
    data = F.filter(lines, lambda l: l.startswith(DATA_PREFIX))
    payload = F.array_join(F.transform(data, lambda l: F.substring(l, len(DATA_PREFIX) + 1, 1 << 30)), "")
    return frames.select(payload.alias("payload")).where(F.length("payload") > 0)


def sse_frames(spark: SparkSession, path: str, line_sep: str = "\n\n") -> DataFrame:
    """Captured event-stream text -> one row per frame payload."""
    return frames_to_payloads(spark.read.option("lineSep", line_sep).text(path))


def sse_frames_stream(spark: SparkSession, path: str, line_sep: str = "\n\n",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over a directory that receives new capture files."""
    r = spark.readStream.option("lineSep", line_sep)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return frames_to_payloads(r.text(path))


def _parsed(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return df.withColumn("_j", F.from_json(F.col(payload), with_corrupt,
                                            {"mode": "PERMISSIVE",
                                             "columnNameOfCorruptRecord": CORRUPT}))


def parse_change_event_all(df: DataFrame, payload: str = "payload",
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """S2 in one pass: every non-empty payload -> ``keep`` + payload + the 14
    change-event columns (NULL for a reject) + ``error_message`` (NULL when valid).

    Absent or null fields take the zero value ("" / 0 / false); the parse
    time column ``parsed_timestamp`` equals ``timestamp``.  Malformed text or
    a wrong type rejects the row with an error message (classified
    ``decode_error`` by P3); so does a timestamp that is no epoch second.  An empty payload is no event at all.
    """
    p = _parsed(df, payload, JSON_PAYLOAD)
    whole = F.col(f"_j.{CORRUPT}").isNull()
    ok = whole & F.coalesce(F.col("_j.timestamp"), F.lit(0)).between(0, TS_MAX)
    zero = {"id": F.lit(0).cast("long"), "namespace": F.lit(0), "timestamp": F.lit(0).cast("long"),
            "bot": F.lit(False)}
    cols = []
    for c in CHANGE_EVENT_COLUMNS:
        if c == "parsed_timestamp":
            v = F.coalesce(F.col("_j.timestamp"), zero["timestamp"])
        elif c in STRING_COLUMNS:
            v = F.coalesce(F.col(f"_j.{c}"), F.lit(""))
        else:
            v = F.coalesce(F.col(f"_j.{c}"), zero[c])
        cols.append(F.when(ok, v).alias(c))
    return (p.where(F.col("_j").isNotNull())
             .select(*keep, F.col(payload), *cols,
                     F.when(ok, F.lit(None).cast("string")).when(whole, F.lit(TS_RANGE_ERROR))
                      .otherwise(F.lit(PARSE_ERROR))
                     .alias("error_message")))


def parse_change_event(df: DataFrame, payload: str = "payload",
                       keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """JSON payloads -> (valid change events, rejected payloads); see
    ``parse_change_event_all``, of which these are the two halves."""
    a = parse_change_event_all(df, payload, keep)
    valid = a.where(F.col("error_message").isNull()).select(*keep, *CHANGE_EVENT_COLUMNS)
    rejected = a.where(F.col("error_message").isNotNull()).select(*keep, payload, "error_message")
    return valid, rejected


TRANSFORM_FIELDS = T.StructType([
    T.StructField("wiki", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])


def parse_defaults_all(df: DataFrame, payload: str = "payload",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """P6 in one pass: the windowing job's parse.  Absent ``wiki``/``type`` ->
    "unknown"; an absent ``timestamp`` rejects the row (D6) instead of
    stamping it with now.  ``error_message`` is NULL for a valid row."""
    p = _parsed(df, payload, TRANSFORM_FIELDS)
    bad = F.col(f"_j.{CORRUPT}").isNotNull() | F.col("_j").isNull()
    no_ts = F.col("_j.timestamp").isNull()
    in_range = F.col("_j.timestamp").between(0, TS_MAX)
    ok = ~bad & ~no_ts & in_range
    return p.select(
        *keep, F.col(payload),
        F.when(ok, F.coalesce(F.col("_j.wiki"), F.lit(UNKNOWN))).alias("wiki"),
        F.when(ok, F.coalesce(F.col("_j.type"), F.lit(UNKNOWN))).alias("type"),
        F.when(ok, F.col("_j.timestamp")).alias("timestamp"),
        F.when(bad, F.lit(PARSE_ERROR)).when(no_ts, F.lit(MISSING_TS_ERROR))
         .when(~in_range, F.lit(TS_RANGE_ERROR)).alias("error_message"))


def parse_defaults(df: DataFrame, payload: str = "payload",
                   keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """P6 as (valid rows, rejects); see ``parse_defaults_all``."""
    a = parse_defaults_all(df, payload, keep)
    valid = a.where(F.col("error_message").isNull()).select(*keep, "wiki", "type", "timestamp")
    rejected = a.where(F.col("error_message").isNotNull()).select(*keep, payload, "error_message")
    return valid, rejected
