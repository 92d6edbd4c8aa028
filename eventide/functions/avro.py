"""Avro binary bodies for the wire format.

Spark's Avro data source is not available, so record bodies are encoded and
decoded in Arrow batches by ``mapInArrow``: Spark partitions the messages,
each task walks its batch with the small codec below.  Only the Avro types
the change-event schemas use are supported: long, int, string, bytes,
boolean, double, float and unions with null.  The wire header (magic byte
and schema id) is built and checked with Spark SQL expressions elsewhere.
"""

from __future__ import annotations

import json
import struct

import pyarrow as pa

_U64 = (1 << 64) - 1


def parse_schema(text: str) -> list[tuple[str, object]]:
    """Avro record schema JSON -> [(field name, type spec)]."""
    doc = json.loads(text)
    if doc.get("type") != "record":
        raise ValueError("only record schemas are supported")
    out = []
    for f in doc["fields"]:
        t = f["type"]
        if isinstance(t, list):
            t = ("union", tuple(x if isinstance(x, str) else x["type"] for x in t))
        elif isinstance(t, dict):
            t = t["type"]
        out.append((f["name"], t))
    return out


# ---- encoding -----------------------------------------------------------------------------

def _varint(out: bytearray, n: int) -> None:
    z = ((n << 1) ^ (n >> 63)) & _U64
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)


def _write(out: bytearray, t, v) -> None:
    if isinstance(t, tuple):
        branches = t[1]
        if v is None:
            _varint(out, branches.index("null"))
            return
        idx = next(i for i, b in enumerate(branches) if b != "null")
        _varint(out, idx)
        _write(out, branches[idx], v)
    elif t in ("long", "int"):
        _varint(out, int(v or 0))
    elif t == "string":
        b = (v or "").encode("utf-8")
        _varint(out, len(b))
        out += b
    elif t == "bytes":
        b = bytes(v or b"")
        _varint(out, len(b))
        out += b
    elif t == "boolean":
        out.append(1 if v else 0)
    elif t == "double":
        out += struct.pack("<d", float(v or 0.0))
    elif t == "float":
        out += struct.pack("<f", float(v or 0.0))
    else:
        raise ValueError(f"unsupported Avro type {t!r}")


def encode_record(fields, row: dict) -> bytes:
    out = bytearray()
    for name, t in fields:
        _write(out, t, row.get(name))
    return bytes(out)


# ---- decoding -----------------------------------------------------------------------------

class AvroError(ValueError):
    pass


def _read_varint(buf: bytes, pos: int) -> tuple[int, int]:
    shift = z = 0
    while True:
        if pos >= len(buf):
            raise AvroError("unexpected end of data")
        b = buf[pos]
        pos += 1
        z |= (b & 0x7F) << shift
        if not b & 0x80:
            break
        shift += 7
        if shift > 63:
            raise AvroError("varint too long")
    return (z >> 1) ^ -(z & 1), pos


def _read(buf: bytes, pos: int, t):
    if isinstance(t, tuple):
        idx, pos = _read_varint(buf, pos)
        if not 0 <= idx < len(t[1]):
            raise AvroError(f"union index {idx} out of range")
        b = t[1][idx]
        return (None, pos) if b == "null" else _read(buf, pos, b)
    if t in ("long", "int"):
        v, pos = _read_varint(buf, pos)
        if t == "int" and not -(1 << 31) <= v < (1 << 31):
            raise AvroError("int out of range")
        return v, pos
    if t in ("string", "bytes"):
        n, pos = _read_varint(buf, pos)
        if n < 0 or pos + n > len(buf):
            raise AvroError("unexpected end of data")
        raw = buf[pos:pos + n]
        if t == "bytes":
            return raw, pos + n
        try:
            return raw.decode("utf-8"), pos + n
        except UnicodeDecodeError as e:
            raise AvroError("invalid UTF-8 in string") from e
    if t == "boolean":
        if pos >= len(buf):
            raise AvroError("unexpected end of data")
        return buf[pos] != 0, pos + 1
    if t in ("double", "float"):
        size, fmt = (8, "<d") if t == "double" else (4, "<f")
        if pos + size > len(buf):
            raise AvroError("unexpected end of data")
        return struct.unpack_from(fmt, buf, pos)[0], pos + size
    raise AvroError(f"unsupported Avro type {t!r}")


def decode_record(fields, buf: bytes, start: int = 0) -> dict:
    pos = start
    row = {}
    for name, t in fields:
        row[name], pos = _read(buf, pos, t)
    if pos != len(buf):
        raise AvroError("trailing bytes")
    return row


# ---- Arrow batch functions for mapInArrow ---------------------------------------------------

def encoder(fields, out_col: str = "body"):
    """``mapInArrow`` function appending the Avro body of each row."""
    from eventide.functions import avro_vec

    def scalar(rb):
        cols = {n: rb.column(n).to_pylist() for n, _ in fields if n in rb.schema.names}
        return pa.array([encode_record(fields, {k: v[i] for k, v in cols.items()})
                         for i in range(rb.num_rows)], type=pa.binary())

    def run(batches):
        for rb in batches:
            try:
                body = avro_vec.encode_batch(rb, fields)
            except (TypeError, ValueError, pa.ArrowException):
                body = scalar(rb)
            yield rb.append_column(out_col, body)
    return run


def encoder_by_schema(schemas: dict, id_col: str, out_col: str = "body"):
    """``mapInArrow`` function appending the Avro body of each row under the
    writer schema named by its ``id_col`` (schema id -> field list)."""
    import numpy as np

    from eventide.functions import avro_vec

    def body(rb, fields):
        try:
            return avro_vec.encode_batch(rb, fields)
        except (TypeError, ValueError, pa.ArrowException):
            cols = {n: rb.column(n).to_pylist() for n, _ in fields if n in rb.schema.names}
            return pa.array([encode_record(fields, {k: v[i] for k, v in cols.items()})
                             for i in range(rb.num_rows)], type=pa.binary())

    def run(batches):
        for rb in batches:
            ids = np.asarray(rb.column(id_col).to_numpy(zero_copy_only=False))
            uniq = np.unique(ids)
            if len(uniq) == 1:
                yield rb.append_column(out_col, body(rb, schemas[int(uniq[0])]))
                continue
            order = np.argsort(ids, kind="stable")
            parts = [body(rb.take(pa.array(order[ids[order] == u])), schemas[int(u)]) for u in uniq]
            inverse = np.argsort(np.concatenate([order[ids[order] == u] for u in uniq]))
            yield rb.append_column(out_col, pa.concat_arrays(parts).take(pa.array(inverse)))
    return run


def _decode_scalar(values, ids, fields_for, names):
    out = {n: [] for n in names}
    errors = []
    for v, sid in zip(values.to_pylist(), ids):
        try:
            row = decode_record(fields_for(sid), v, 5)
            err = None
        except (AvroError, ValueError, KeyError, TypeError) as e:
            row, err = {}, f"avro unmarshal: {e}"
        for n in names:
            out[n].append(row.get(n))
        errors.append(err)
    return out, errors


def decoder(schemas: dict, out_fields, value_col: str = "value", id_col: str = "schema_id",
            keep=(), err_col: str | None = None):
    """``mapInArrow`` function decoding bodies (after the 5-byte header).

    ``schemas`` maps schema id -> schema JSON (a broadcast value);
    ``out_fields`` is the Arrow schema of the decoded columns.  A body that
    does not decode yields NULL fields and an ``error_message``; rows whose
    ``err_col`` is already set (envelope errors) pass through undecoded with
    that message.  Rows are decoded column-at-a-time per schema id
    (``avro_vec``); a batch the fast path cannot handle is decoded row by row.
    """
    import numpy as np

    from eventide.functions import avro_vec

    parsed: dict = {}

    def fields_for(sid):
        if sid not in parsed:
            parsed[sid] = parse_schema(schemas[sid])
        return parsed[sid]

    names = [f.name for f in out_fields]

    def one_schema(values, sid):
        try:
            if sid not in schemas:
                raise TypeError("unknown schema")
            return avro_vec.decode_batch(values, fields_for(sid), out_fields)
        except (TypeError, ValueError, pa.ArrowException):
            out, errors = _decode_scalar(values, [sid] * len(values), fields_for, names)
            return [pa.array(out[f.name], type=f.type) for f in out_fields], errors

    def scatter(n, parts):
        """parts: [(row indices, columns, errors)] -> full columns/errors in row order."""
        mapping = np.full(n, -1, dtype=np.int64)
        errors = [None] * n
        base = 0
        for rows, _, errs in parts:
            mapping[rows] = base + np.arange(len(rows))
            for i, e in zip(rows, errs):
                errors[i] = e
            base += len(rows)
        mapping[mapping < 0] = base           # -> the trailing null row
        cols = []
        for k, f in enumerate(out_fields):
            pieces = [p[1][k].cast(f.type) for p in parts] + [pa.nulls(1, f.type)]
            cols.append(pa.concat_arrays(pieces).take(pa.array(mapping)))
        return cols, errors

    def run(batches):
        for rb in batches:
            n = rb.num_rows
            values = rb.column(value_col)
            ids = np.array([-1 if i is None else i for i in rb.column(id_col).to_pylist()], dtype=np.int64)
            pre = rb.column(err_col).to_pylist() if err_col else [None] * n
            todo = np.array([i for i in range(n) if pre[i] is None], dtype=np.int64)
            parts = []
            for sid in np.unique(ids[todo]) if len(todo) else []:
                rows = todo[ids[todo] == sid]
                sub = values if len(rows) == n else values.take(pa.array(rows))
                c, e = one_schema(sub, int(sid))
                parts.append((rows, c, e))
            if len(parts) == 1 and len(parts[0][0]) == n:
                cols, errors = [c.cast(f.type) for c, f in zip(parts[0][1], out_fields)], parts[0][2]
            else:
                cols, errors = scatter(n, parts)
            errors = [pre[i] if pre[i] is not None else errors[i] for i in range(n)]
            arrays = [rb.column(k) for k in keep] + cols
            arrays.append(pa.array(errors, type=pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=list(keep) + names + ["error_message"])
    return run
