"""Compatibility of schema versions (E3): cases of the Avro resolution rules."""

import json

import pytest

from eventide.operators.compatibility import compatibility
from eventide.sources.wire import registry_frame


def record(*fields):
    return json.dumps({"type": "record", "name": "R", "fields": [
        {"name": n, "type": t, **({"default": d[0]} if d else {})} for n, t, *d in fields]})


CASES = {
    "same": (record(("a", "int")), record(("a", "int")), True, True),
    "removed without default": (record(("a", "int"), ("b", "string")), record(("a", "int")), True, False),
    "removed with default": (record(("a", "int"), ("b", "string", "")), record(("a", "int")), True, True),
    "added without default": (record(("a", "int")), record(("a", "int"), ("b", "string")), False, True),
    "added with null default": (record(("a", "int")), record(("a", "int"), ("b", ["null", "string"], None)), True, True),
    "widened": (record(("a", "int")), record(("a", "double")), True, False),
    "narrowed": (record(("a", "long")), record(("a", "int")), False, True),
    "string and bytes": (record(("a", "string")), record(("a", "bytes")), True, True),
    "into a union": (record(("a", "int")), record(("a", ["null", "long"])), True, False),
    "union narrowed": (record(("a", ["null", "int", "string"])), record(("a", ["null", "string"])), False, True),
    "primitive as object": (record(("a", "long")), record(("a", {"type": "long", "logicalType": "time-micros"})), True, True),
    "nested types equal": (record(("a", {"type": "array", "items": "int"})), record(("a", {"type": "array", "items": "int"})), True, True),
    "nested types differ": (record(("a", {"type": "array", "items": "int"})), record(("a", {"type": "map", "values": "int"})), False, False),
    "fields swapped": (record(("a", "int"), ("b", "string")), record(("b", "string"), ("a", "int")), True, True),
    "no record": (record(("a", "int")), '"string"', False, False),
    "damaged": ("{", record(("a", "int")), False, False),
    "null": (None, record(("a", "int")), False, False),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(name, v, s, "x") for name, (old, new, *_) in CASES.items() for v, s in ((3, old), (8, new))]
    rows += [("twice", 1, record(("a", "int")), "y"), ("twice", 1, record(("a", "int")), "y"),
             (None, 1, record(("a", "int")), "y"), ("no version", None, record(("a", "int")), "y")]
    df = spark.createDataFrame(rows, "subject string, version int, schema string, backward string")
    return compatibility(df).collect(), df


def test_resolution_rules(found):
    got = {r.subject: (r.previous_version, r.backward, r.forward, r.full) for r in found[0] if r.version == 8}
    assert got == {n: (3, b, f, b and f) for n, (_, _, b, f) in CASES.items()}


def test_first_versions_repeats_and_nulls(found):
    first = {r.subject: (r.previous_version, r.full) for r in found[0] if r.version != 8}
    assert first == {n: (None, True) for n in [*CASES, "twice"]}
    assert len(found[0]) == 2 * len(CASES) + 1
    assert compatibility(found[1].limit(0)).count() == 0


def test_renamed_by_alias(spark):
    new = '{"type":"record","name":"R","fields":[{"name":"b","aliases":["a"],"type":"int"}]}'
    df = spark.createDataFrame([("s", 1, record(("a", "int"))), ("s", 2, new)], "subject string, version int, schema string")
    r = compatibility(df).where("version = 2").first()
    assert r.backward and not r.forward and r.forward_problems == ["a: missing, no default"]


def test_registry_of_the_library(spark):
    got = {r.version: (r.backward, r.forward) for r in compatibility(registry_frame(spark)).collect()}
    assert got == {1: (True, True), 2: (True, True)}
