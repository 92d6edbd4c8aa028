"""Compatibility of consecutive Avro schema versions.

A new version is backward compatible if it can read what the version before
it wrote, forward compatible if that version can read what the new one
writes.  Record fields are resolved by name or by an alias of the reader's: a
field that the writer lacks needs a default, one that the reader lacks is
skipped, and every branch of the writer's type must be read, as itself or
promoted, by a branch of the reader's.

All of it is SQL expressions over the parsed schemas.  Each version meets
only the next one of its subject, by an equi-join, so a subject with very many
versions is spread over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import next_in_order

# The promotions of the Avro specification, writer type -> reader types.
PROMOTIONS = {"int": ["long", "float", "double"], "long": ["float", "double"], "float": ["double"],
              "string": ["bytes"], "bytes": ["string"]}

RECORD = "struct<type:string, name:string, fields:array<map<string,string>>>"


def _branches(kind: Column) -> Column:
    """The branches of a type in JSON text; nested types stay text."""
    one = F.when(kind.startswith("{"), F.get_json_object(kind, "$.type")).otherwise(kind)
    # A primitive type may be written as an object, {"type": "long", ...}.
    primitive = one.isin("null", "boolean", "int", "long", "float", "double", "bytes", "string")
    return F.when(kind.startswith("["), F.from_json(kind, "array<string>")) \
            .otherwise(F.array(F.when(primitive, one).otherwise(kind)))


def parsed_fields(schema: Column) -> Column:
    """The fields of a record schema in JSON text: name, branches, whether it
    has a default (null counts), aliases.  NULL if it is no record."""
    record = F.from_json(schema, RECORD)
    fields = F.transform(record["fields"], lambda f: F.struct(
        f["name"].alias("name"), _branches(f["type"]).alias("branches"),
        F.map_contains_key(f, "default").alias("has_default"),
        F.coalesce(F.from_json(f["aliases"], "array<string>"), F.array().cast("array<string>")).alias("aliases")))
    return F.when(record["type"] == F.lit("record"), fields)


def _reads(reader: Column, writer: Column) -> Column:
    promoted = F.lit(False)
    for source, targets in PROMOTIONS.items():
        promoted = promoted | ((writer == F.lit(source)) & reader.isin(targets))
    return (reader == writer) | promoted


def problems(reader: Column, writer: Column) -> Column:
    """What keeps ``reader`` (fields of ``parsed_fields``) from reading rows of
    ``writer``, by field in the reader's order; empty if nothing does."""
    def of_field(f: Column) -> Column:
        same = F.coalesce(
            F.get(F.filter(writer, lambda g: g["name"] == f["name"]), 0),
            F.get(F.filter(writer, lambda g: F.array_contains(f["aliases"], g["name"])), 0))
        unread = F.filter(same["branches"], lambda w: ~F.exists(f["branches"], lambda r: _reads(r, w)))
        return (F.when(same.isNull(), F.when(~f["has_default"], F.concat(f["name"], F.lit(": missing, no default"))))
                 .when(F.size(unread) > 0, F.concat(f["name"], F.lit(": cannot read "), F.array_join(unread, "|"))))

    return F.filter(F.transform(reader, of_field), lambda p: p.isNotNull())


def compatibility(registry: DataFrame) -> DataFrame:
    """Each version of a registry (subject, version, schema) against the one
    before it: subject, version, previous_version, ``backward``, ``forward``
    and ``full``, and the problems of both directions as text arrays.

    The first version of a subject is compatible with everything, as there is
    nothing before it.  A schema that is null or no record is compatible with
    nothing, either way round; its arrays hold ``not a record``.  Rows
    without subject or version are left out, of repeated (subject, version)
    rows the one with the greatest schema text counts.  Extra columns are not looked at.
    """
    known = (registry.where(F.col("subject").isNotNull() & F.col("version").isNotNull())
                     .groupBy("subject", F.col("version").cast("long").alias("version"))
                     .agg(F.max("schema").alias("schema")))
    order = next_in_order(known.select("subject", "version"), ["subject"], "version", "next_version")
    before = (known.join(order.where("next_version is not null"), ["subject", "version"])
                   .select("subject", F.col("next_version").alias("version"), F.col("version").alias("previous_version"),
                           parsed_fields(F.col("schema")).alias("_old")))
    pairs = (known.select("subject", "version", parsed_fields(F.col("schema")).alias("_new"))
                  .join(before, ["subject", "version"], "left"))

    def found(reader: str, writer: str) -> Column:
        none = F.array().cast("array<string>")
        broken = F.col("_new").isNull() | F.col("_old").isNull()
        return (F.when(F.col("previous_version").isNull(), none)
                 .when(broken, F.array(F.lit("not a record")))
                 .otherwise(problems(F.col(reader), F.col(writer))))

    out = pairs.select("subject", "version", "previous_version", found("_new", "_old").alias("backward_problems"),
                       found("_old", "_new").alias("forward_problems"))
    backward, forward = F.size("backward_problems") == 0, F.size("forward_problems") == 0
    return out.select("subject", "version", "previous_version", backward.alias("backward"), forward.alias("forward"),
                      (backward & forward).alias("full"), "backward_problems", "forward_problems")
