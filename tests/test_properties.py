"""Property tests: the vectorized codec against the scalar one on random records,
and the error classifier against its definition."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.functions import avro, avro_vec
from eventide.functions import columns as C
from eventide.schema import CHANGE_EVENT_V2
from eventide.sources.wire import SCHEMA_V1_JSON, SCHEMA_V2_JSON

LONG = st.integers(min_value=-(2**63), max_value=2**63 - 1)
INT = st.integers(min_value=-(2**31), max_value=2**31 - 1)
TEXT = st.text(max_size=40)
ROW = st.fixed_dictionaries({
    "id": LONG, "type": TEXT, "namespace": INT, "title": TEXT, "title_url": TEXT, "comment": TEXT,
    "timestamp": LONG, "user": TEXT, "bot": st.booleans(), "server_url": TEXT, "server_name": TEXT,
    "server_script_url": TEXT, "wiki": TEXT, "parsed_timestamp": LONG,
    "minor": INT, "page_id": st.one_of(st.none(), LONG)})
OUT = [pa.field(f.name, {"long": pa.int64(), "integer": pa.int32(), "string": pa.string(),
                         "boolean": pa.bool_()}[f.dataType.typeName()]) for f in CHANGE_EVENT_V2.fields]


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=30), st.sampled_from([SCHEMA_V1_JSON, SCHEMA_V2_JSON]),
       st.data())
def test_codec_vectorized_equals_scalar(rows, schema_json, data):
    fields = avro.parse_schema(schema_json)
    ref = [avro.encode_record(fields, r) for r in rows]
    assert avro_vec.encode_batch(pa.RecordBatch.from_pylist(rows), fields).to_pylist() == ref
    # corrupt some bodies: cut or extend them; both paths must agree on every row
    bodies = []
    for b in ref:
        cut = data.draw(st.integers(min_value=-3, max_value=len(b)))
        bodies.append(b[:cut] if cut >= 0 else b + b"\x01" * -cut)
    hdr = b"\x00\x00\x00\x00\x01"
    cols, errs = avro_vec.decode_batch(pa.array([hdr + b for b in bodies], type=pa.binary()), fields, OUT)
    names = [f.name for f in OUT]
    for i, b in enumerate(bodies):
        try:
            want, werr = avro.decode_record(fields, b), None
        except avro.AvroError:
            want, werr = None, True
        if werr:
            assert errs[i] is not None and all(c[i].as_py() is None for c in cols)
        else:
            assert errs[i] is None
            assert {k: cols[names.index(k)][i].as_py() for k in want} == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="decodunmarshlpswitfkxy :", max_size=25), min_size=1, max_size=20))
def test_error_type_matches_definition(spark, messages):
    df = spark.createDataFrame([(m,) for m in messages], "error_message string")
    got = [r[0] for r in df.select(C.error_type()).collect()]

    def ref(m):
        if any(k in m for k in C.DECODE_KEYWORDS):
            return C.DECODE_ERROR
        if any(k in m for k in C.SINK_KEYWORDS):
            return C.SINK_ERROR
        return C.UNKNOWN_ERROR
    assert got == [ref(m) for m in messages]


ATTEMPTS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.booleans()), min_size=1, max_size=60)


@settings(max_examples=25, deadline=None)
@given(ATTEMPTS, st.integers(min_value=1, max_value=9), st.integers(min_value=1, max_value=5))
def test_retry_route_matches_loop(spark, seq, chunk, max_retries):
    from eventide.operators.reliability import retry_route
    rows = [(p, i, f) for i, (p, f) in enumerate(seq)]
    state, want = {}, {}
    for p, i, failed in rows:
        n = state.get(p, 0)
        if failed:
            want[i] = (n, n >= max_retries)
            state[p] = 0 if n >= max_retries else n + 1
        else:
            state[p] = 0
    df = spark.createDataFrame(rows, "part string, attempt long, failed boolean")
    got = retry_route(df, ["part"], "attempt", "failed", max_retries=max_retries, chunk_width=chunk)
    assert {r.attempt: (r.retry_count, r.to_dlq) for r in got.collect()} == want


EVENTS = st.lists(st.tuples(st.sampled_from(["enwiki", "dewiki"]), st.integers(min_value=0, max_value=6),
                            st.integers(min_value=0, max_value=5), st.sampled_from(["x", "y"])),
                  min_size=1, max_size=40)


@settings(max_examples=25, deadline=None)
@given(EVENTS)
def test_dedup_matches_loop(spark, events):
    from eventide.operators.dedup import dedup_events
    rows = [(i, w, ts, t, "u", "c") for w, i, ts, t in events]
    df = spark.createDataFrame(rows, "id long, wiki string, timestamp long, title string, user string, "
                                     "comment string")
    best, keep = {}, []
    for r in rows:
        if r[0] == 0:
            keep.append(r)
            continue
        k = (r[1], r[0])
        if k not in best or (r[2], r[3], r[4], r[5]) < (best[k][2], best[k][3], best[k][4], best[k][5]):
            best[k] = r
    got = sorted(tuple(r) for r in dedup_events(df).collect())
    assert got == sorted(keep + list(best.values()))


def _hist_quantile_ref(values, bounds, q):
    """Cumulative-bucket quantile, written directly from the rule."""
    total = len(values)
    cum = [sum(1 for v in values if v <= b) for b in bounds]
    rank = q * total
    for i, c in enumerate(cum):
        if c >= rank:
            if i == 0 and bounds[0] <= 0:
                return bounds[0]
            start = 0.0 if i == 0 else bounds[i - 1]
            prev = 0 if i == 0 else cum[i - 1]
            return start + (bounds[i] - start) * (rank - prev) / (c - prev)
    return bounds[-1]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=15, allow_nan=False), min_size=1, max_size=50),
       st.sampled_from([0.5, 0.9, 0.95, 0.99, 1.0]))
def test_histogram_quantile_matches_rule(spark, values, q):
    from eventide.operators import metrics
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = metrics.histogram_quantiles(df, "v", [q]).first().value
    want = _hist_quantile_ref(values, [b for _, b in metrics.DEFAULT_BUCKETS], q)
    assert abs(got - round(want, 6)) < 1e-6


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g", "h"]), st.integers(min_value=0, max_value=8)),
                min_size=1, max_size=60),
       st.floats(min_value=0.5, max_value=4.0))
def test_exact_quantiles_with_ties(spark, rows, width):
    import numpy as np

    from eventide.operators.quantiles import exact_quantiles
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, v double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.q): r.v for r in exact_quantiles(df, ["g"], "v", qs, fine=1 + int(width)).collect()}
    for g in {g for g, _ in rows}:
        x = np.array([v for gg, v in rows if gg == g], dtype=float)
        for q in qs:
            assert abs(got[(g, q)] - np.quantile(x, q)) < 1e-9
