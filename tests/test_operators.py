import random

import numpy as np
from pyspark.sql import functions as F

from eventide.operators import features, metrics, reliability
from eventide.operators.generate import amplify, dense_index
from eventide.operators.quantiles import exact_quantiles
from eventide.operators.scan import running_sums
from eventide.sources.tables import ce_columns, change_events, read_table
from tests.conftest import SF001


def test_retry_literal_scenario(spark):
    # four failures of one message, then a success, then a failure; another message fails once
    rows = [("m", 1, True), ("m", 2, True), ("m", 3, True), ("m", 4, True), ("m", 5, False), ("m", 6, True),
            ("o", 7, True)]
    df = spark.createDataFrame(rows, "part string, attempt long, failed boolean")
    out = {r.attempt: (r.retry_count, r.to_dlq) for r in
           reliability.retry_route(df, ["part"], "attempt", "failed").collect()}
    assert out == {1: (0, False), 2: (1, False), 3: (2, False), 4: (3, True), 6: (0, False), 7: (0, False)}


def _retry_brute(rows, max_retries=3):
    state, out = {}, {}
    for part, attempt, failed in sorted(rows, key=lambda r: (r[0], r[1])):
        n = state.get(part, 0)
        if failed:
            out[attempt] = (n, n >= max_retries)
            state[part] = 0 if n >= max_retries else n + 1
        else:
            state[part] = 0
    return out


def test_retry_matches_brute_force_small_chunks(spark):
    ev = read_table(spark, SF001, "events").select(
        F.col("user_id").alias("part"), F.col("event_id").alias("attempt"),
        F.col("event_type").isin("error", "view").alias("failed"))
    want = _retry_brute([tuple(r) for r in ev.collect()])
    for width, mat in ((7, False), (1 << 20, False), (7, True)):   # many chunks per key, one; materialized
        got = reliability.retry_route(ev, ["part"], "attempt", "failed", chunk_width=width, materialize_runs=mat)
        assert {r.attempt: (r.retry_count, r.to_dlq) for r in got.collect()} == want


def test_running_sums_chunked(spark):
    rows = [("a", i, i % 3) for i in range(50)] + [("b", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.s for r in running_sums(df, ["k"], "o", {"s": F.col("v")}, chunk_width=4).collect()}
    acc = {}
    for k, o, v in rows:
        acc[k] = acc.get(k, 0) + v
        assert got[(k, o)] == acc[k]


def test_asof_join_brute_force(spark):
    random.seed(3)
    right = [("a", t, t * 10) for t in sorted(random.sample(range(0, 20000), 40))] + \
            [("b", t, -t) for t in (100, 5000)]
    left = [(i, random.choice("abc"), random.randrange(0, 25000)) for i in range(400)]
    r = spark.createDataFrame(right, "k string, fts long, val long")
    l_ = spark.createDataFrame(left, "id long, k string, ts long")
    for ttl, chunk in ((None, None), (700, None), (700, 900), (None, 301)):   # small chunks: many per key
        got = {x.id: (x.fts, x.val) for x in
               features.asof_join(l_, r, ["k"], "ts", "fts", ttl=ttl, bucket=300, chunk_width=chunk).collect()}
        for i, k, ts in left:
            cands = [(f, v) for kk, f, v in right if kk == k and f <= ts and (ttl is None or ts - f <= ttl)]
            best = max(cands) if cands else None
            assert got[i] == (best if best else (None, None)), (i, k, ts)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(50, 3000), 3)
    groups = rng.integers(0, 3, 3000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    got = {(r.g, r.q): r.v for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 0.95, 0.99, 1.0],
                                                     fine=7).collect()}
    for g in range(3):
        x = vals[groups == g]
        for q in (0.0, 0.5, 0.95, 0.99, 1.0):
            assert abs(got[(g, q)] - np.quantile(x, q)) < 1e-9


def test_histogram_quantile_rules(spark):
    df = spark.createDataFrame([(0.3,), (0.3,), (0.7,), (20.0,)], "v double")
    b = [("0.5", 0.5), ("1", 1.0)]
    got = {r.q: r.value for r in metrics.histogram_quantiles(df, "v", [0.25, 0.6, 0.99], b).collect()}
    assert abs(got[0.25] - 0.25) < 1e-9          # inside the first bucket, from 0
    assert abs(got[0.6] - 0.7) < 1e-9            # second bucket: 0.5 + 0.5 * (2.4 - 2) / 1
    assert got[0.99] == 1.0                      # only +Inf reaches it: last finite bound


def test_dense_index_and_amplify(spark):
    seed = ce_columns(change_events(spark, SF001))
    idx = dense_index(seed, ["id"])
    ids = sorted((r.id, r._idx) for r in idx.collect())
    assert [i for _, i in ids] == list(range(len(ids)))
    out = amplify(seed, 2500).collect()
    assert len(out) == 2500
    assert sorted(r.id for r in out) == list(range(1000001, 1002501))
    r0 = [r for r in out if r.id == 1000001][0]
    assert r0.title == "LoadTest_Page_1" and r0.title_url == r0.title and r0.user.startswith("loadtester_")
    assert {r.user for r in out} <= {f"loadtester_{i}" for i in range(100)}


def test_edit_stats_approximate_users_close_to_exact(spark):
    ce = change_events(spark, SF001)
    exact = {(r.wiki, r.feature_ts): r.unique_users_last_hour for r in features.edit_stats(ce).collect()}
    approx = {(r.wiki, r.feature_ts): r.unique_users_last_hour
              for r in features.edit_stats(ce, approx_users=0.01).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(1, 0.05 * v) for k, v in exact.items())


def test_slo_report_approx_close_to_exact(spark):
    ce = change_events(spark, SF001, with_duration=True).select(
        "wiki", "timestamp", (F.col("duration_s") * 1000.0).alias("latency_ms"),
        (F.col("type") == "error").alias("is_error"))
    exact = {r.wiki: r for r in metrics.slo_report(ce, ["wiki"], "latency_ms", "is_error", "timestamp").collect()}
    approx = {r.wiki: r for r in metrics.slo_report(ce, ["wiki"], "latency_ms", "is_error", "timestamp",
                                                     approx_accuracy=10000).collect()}
    assert exact.keys() == approx.keys()
    for w in exact:
        assert abs(exact[w].p50_ms - approx[w].p50_ms) <= 0.05 * exact[w].p50_ms + 60
        assert exact[w].error_rate == approx[w].error_rate


def test_dense_index_over_many_partitions(spark):
    seed = ce_columns(change_events(spark, SF001)).repartition(9)
    from pyspark.sql import Window
    idx = dense_index(seed, ["id"])
    ranked = idx.withColumn("want", F.row_number().over(Window.orderBy("id")) - 1)
    assert ranked.where("_idx <> want").count() == 0
    out = amplify(seed, 3000)
    assert out.select("id").distinct().count() == 3000
    assert out.agg(F.max("id")).first()[0] == 1003000


def test_histogram_leaves_nulls_out_and_takes_quantile_zero(spark):
    df = spark.createDataFrame([(0.3,), (None,)], "v double")
    b = [("0.5", 0.5), ("1", 1.0)]
    assert {r["le"]: r["count"] for r in metrics.histogram(df, "v", b).collect()} == {"0.5": 1, "1": 1, "+Inf": 1}
    got = {r.q: r.value for r in metrics.histogram_quantiles(df, "v", [0.0, 1.0], b).collect()}
    assert got == {0.0: 0.0, 1.0: 0.5}
