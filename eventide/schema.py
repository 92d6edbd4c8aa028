"""Fixed schemas of the change-event data model and schema alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The change-event record, version 1, in field order.
CHANGE_EVENT_FIELDS_V1 = [
    ("id", T.LongType()),
    ("type", T.StringType()),
    ("namespace", T.IntegerType()),
    ("title", T.StringType()),
    ("title_url", T.StringType()),
    ("comment", T.StringType()),
    ("timestamp", T.LongType()),
    ("user", T.StringType()),
    ("bot", T.BooleanType()),
    ("server_url", T.StringType()),
    ("server_name", T.StringType()),
    ("server_script_url", T.StringType()),
    ("wiki", T.StringType()),
    ("parsed_timestamp", T.LongType()),
]
# Version 2 adds these two fields with defaults 0 and null.
CHANGE_EVENT_FIELDS_V2_EXTRA = [
    ("minor", T.IntegerType()),
    ("page_id", T.LongType()),
]
V2_DEFAULTS = {"minor": 0, "page_id": None}

CHANGE_EVENT_V1 = T.StructType([T.StructField(n, t, True) for n, t in CHANGE_EVENT_FIELDS_V1])
CHANGE_EVENT_V2 = T.StructType(
    [T.StructField(n, t, True) for n, t in CHANGE_EVENT_FIELDS_V1 + CHANGE_EVENT_FIELDS_V2_EXTRA])
CHANGE_EVENT_COLUMNS = [n for n, _ in CHANGE_EVENT_FIELDS_V1]

# The JSON payload carries the first 13 fields; parsed_timestamp is derived.
JSON_PAYLOAD = T.StructType([f for f in CHANGE_EVENT_V1.fields if f.name != "parsed_timestamp"])

# String columns that get "" when absent (zero values of the source record).
STRING_COLUMNS = [n for n, t in CHANGE_EVENT_FIELDS_V1 if isinstance(t, T.StringType)]

# Broker message envelope (the shape of Spark's Kafka source).
HEADER = T.StructType([T.StructField("key", T.StringType()),
                       T.StructField("value", T.BinaryType())])
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(HEADER)),
])

# Schema registry as a small dimension table.
REGISTRY = T.StructType([
    T.StructField("schema_id", T.IntegerType()),
    T.StructField("subject", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("schema", T.StringType()),
])


class SchemaMismatch(ValueError):
    """Raised when data cannot be read under a target schema."""


# Widening casts that are always safe (source -> allowed targets).
_WIDENING = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def _compatible(src: T.DataType, dst: T.DataType) -> bool:
    if type(src) is type(dst):
        return True
    return isinstance(dst, _WIDENING.get(type(src), ()))


def align_schema(df: DataFrame, target: T.StructType,
                 defaults: dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``target``.

    Missing fields take their default (E1); a missing field without a default
    or a narrowing type change raises :class:`SchemaMismatch` (E3); extra
    fields are dropped (E2) -- the projection prunes them from the scan.
    Fields present but NULL in some files (mixed-version Parquet read under
    the target schema) get the default as well.  ``keep`` columns are
    passed through in front.
    """
    defaults = dict(V2_DEFAULTS if defaults is None else defaults)
    present = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for f in target.fields:
        if f.name in present:
            if not _compatible(present[f.name], f.dataType):
                raise SchemaMismatch(
                    f"field {f.name}: {present[f.name].simpleString()} cannot be read as "
                    f"{f.dataType.simpleString()}")
            c = F.col(f.name).cast(f.dataType)
            if f.name in defaults and defaults[f.name] is not None:
                c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
            cols.append(c.alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            raise SchemaMismatch(f"field {f.name} is missing and has no default")
    return df.select(*keep, *cols)
