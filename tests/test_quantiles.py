"""Exact quantiles by selection (M5, M8)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.operators.quantiles import exact_quantiles

QS = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("buckets,fine", [(64, 20), (1024, 10_000)])
def test_quantiles_match_numpy(spark, buckets, fine):
    rng = random.Random(fine)
    rows = [("wide", rng.uniform(-1e6, 1e6)) for _ in range(500)]
    rows += [("crowded", rng.choice([1.0, 1.5, 2.0 + rng.random() * 1e-6])) for _ in range(500)] + [("crowded", 1e300), ("crowded", -1e308)]
    rows += [("one", 7.0)] * 40 + [(None, float(i)) for i in range(100)] + [("none", None)] * 3 + [("single", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.q): r.v for r in exact_quantiles(df, ["g"], "v", QS, buckets=buckets, fine=fine).collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == {(g, q) for g in by for q in QS}
    for (g, q), v in got.items():
        s = sorted(by[g])
        lo, hi = s[int(np.floor(q * (len(s) - 1)))], s[int(np.ceil(q * (len(s) - 1)))]
        assert v == pytest.approx(lo + (q * (len(s) - 1) % 1) * (hi - lo), rel=1e-9), (g, q)
    whole = exact_quantiles(df.where("g = 'wide'"), [], "v", [0.5], buckets=buckets, fine=fine).collect()
    assert [r.v for r in whole] == [pytest.approx(float(np.median(by["wide"])))]
    assert exact_quantiles(df.limit(0), ["g"], "v", QS).count() == 0


def test_a_crowded_range_is_spread_over_tasks(spark):
    """All latencies of one wiki within 50 ms: no window partition holds more than ``fine`` of its values."""
    df = spark.range(60_000).select(F.lit("w").alias("g"), (F.col("id") / 60_000 * 50).alias("v"))
    got = exact_quantiles(df, ["g"], "v", [0.5, 0.99], fine=500).collect()
    assert {r.q: round(r.v, 6) for r in got} == {0.5: round(59_999 / 2 / 60_000 * 50, 6), 0.99: round(59_999 * 0.99 / 60_000 * 50, 6)}
