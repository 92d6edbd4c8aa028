"""As-of values by carrying them along, the feature service and incremental materialization."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators.carry import asof_carry
from eventide.operators.features import edit_stats, latest_per_key
from eventide.plans import feature_store
from eventide.schema import CHANGE_EVENT_V1
from eventide.sinks.parquet import with_partitions, write_events

T0 = 1718000000 // 3600 * 3600


@pytest.mark.parametrize("ttl,chunk", [(None, 50), (120, 50), (120, 7), (10**9, 100_000)])
def test_asof_carry_matches_brute_force(spark, ttl, chunk):
    rng = random.Random(chunk)
    right = [(rng.choice("abc"), rng.randint(0, 900), rng.randint(0, 9)) for _ in range(80)] + [(None, 5, 1), ("a", None, 2)]
    left = [(i, rng.choice("abcd") if rng.random() < 0.5 else "a", rng.randint(-50, 1500)) for i in range(300)]
    left += [(300, None, 10), (301, "a", None), (1, left[1][1], left[1][2])]
    got = asof_carry(spark.createDataFrame(left, "n int, k string, at long"),
                     spark.createDataFrame(right, "k string, ts long, v int"), ["k"], "at", "ts", ttl, chunk)
    assert got.columns == ["n", "k", "at", "ts", "v"]

    def best(k, at):
        ok = [(t, v) for kk, t, v in right if kk == k and None not in (k, t, at) and t <= at and (ttl is None or at - t <= ttl)]
        newest = max((t for kk, t, v in right if kk == k and None not in (k, t, at) and t <= at), default=None)
        return max([x for x in ok if x[0] == newest], default=(None, None))

    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((n, k, at, *best(k, at))) for n, k, at in left)


def test_asof_carry_does_not_depend_on_the_ttl(spark):
    left = spark.range(50).select(F.col("id"), F.lit("a").alias("k"), (F.col("id") * 86400 * 7).alias("at"))
    right = spark.createDataFrame([("a", 0, 1), ("a", 86400, 2)], "k string, ts long, v int")
    got = asof_carry(left, right, ["k"], "at", "ts", ttl=365 * 86400)
    assert got.where("v = 2").count() == 49 and "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def _events(spark, rows):
    full = [(i, "edit", 0, f"T{i}", "", "", t, u, u == "bot", "s", "n", "w", wiki, t) for i, wiki, t, u in rows]
    return spark.createDataFrame(full, CHANGE_EVENT_V1)


def test_incremental_runs_equal_one_full_run(spark, tmp):
    rng = random.Random(7)
    events, store = os.path.join(tmp, "events"), os.path.join(tmp, "store")
    rows, per_run = [], []
    for n in range(3):
        new = [(1000 * n + i, rng.choice(["enwiki", "enwiki", "dewiki"]), T0 + 86400 * 3 * n + rng.randint(0, 3 * 86400), rng.choice(["x", "y", "bot"]))
               for i in range(60)]
        if n:                       # a late one, and one that meets the newest hour again
            new += [(1000 * n + 90, "frwiki", T0 + 5, "x"), (1000 * n + 91, rows[-1][1], rows[-1][2], "z")]
        rows += new
        part = _events(spark, new)
        write_events(part, events, batch_id=f"run-{n:010d}")
        feature_store.commit_partitions(with_partitions(part), events, "run", n)
        per_run.append(feature_store.materialize_incremental(spark, events, store))
        want = edit_stats(_events(spark, rows))
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, feature_store.read_grid(spark, store).collect())) == sorted(map(key, want.collect()))
        newest = latest_per_key(want, ["wiki"], "feature_ts").select(*feature_store.LATEST.fieldNames())
        assert sorted(map(key, feature_store.read_latest(spark, store).collect())) == sorted(map(key, newest.collect()))
    assert feature_store.materialize_incremental(spark, events, store) == 0          # nothing new
    assert all(n <= 62 for n in per_run)                                             # only the touched hours
    feature_store.commit_partitions(with_partitions(part.limit(1)), events, "run", 2)
    assert feature_store.materialize_incremental(spark, events, store) == 0          # a batch that ran again is in
    late = _events(spark, [(9000, "enwiki", T0 + 7, "x")])
    write_events(late, events, batch_id="other-0000000000")
    feature_store.commit_partitions(with_partitions(late), events, "other", 0)
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(store, "grid")) for f in fs}
    assert feature_store.materialize_incremental(spark, events, store) == 1
    after = {f for d, _, fs in os.walk(os.path.join(store, "grid")) for f in fs}
    assert len(set(before) & after) > len(before) / 2                                # other days' files untouched
