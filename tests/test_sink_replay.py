import os

import pytest
from pyspark.sql import functions as F

from eventide.operators.dedup import anti_join_existing, dedup_events
from eventide.plans import inject
from eventide.sinks.parquet import write_events
from eventide.sources.replay import read_events, replay_totals
from eventide.sources.tables import ce_columns, change_events
from tests.conftest import SF001


def test_write_partitioned_and_pruned_read(spark, tmp):
    ce = ce_columns(change_events(spark, SF001))
    path = os.path.join(tmp, "events")
    write_events(ce, path)
    assert read_events(spark, path).count() == ce.count()
    day = read_events(spark, path, "2024-01-03", "2024-01-03")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan
    want = ce.where(F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd") == "2024-01-03").count()
    assert day.count() == want
    t = replay_totals(day).first()
    assert t.events == want and t.files >= 1


def test_max_records_per_file(spark, tmp):
    ce = ce_columns(change_events(spark, SF001))
    path = os.path.join(tmp, "small")
    write_events(ce, path, max_records_per_file=10)
    per_file = read_events(spark, path).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 10
    assert per_file.agg(F.sum("count")).first()[0] == ce.count()


def test_batch_rewrite_is_idempotent(spark, tmp):
    ce = ce_columns(change_events(spark, SF001))
    path = os.path.join(tmp, "idem")
    write_events(ce, path, batch_id=7)
    write_events(ce, path, batch_id=7)          # replayed batch
    write_events(ce.limit(5), path, batch_id=8)
    assert read_events(spark, path).count() == ce.count() + 5


def test_range_checks(spark, tmp):
    with pytest.raises(ValueError):
        read_events(spark, tmp, "2024-01-05", "2024-01-01")
    with pytest.raises(ValueError):
        read_events(spark, tmp, "2024-01-05", None)
    with pytest.raises(ValueError):
        read_events(spark, tmp, "05/01/2024", "2024-01-06")


def test_missing_path_errors(spark, tmp):
    with pytest.raises(Exception):
        read_events(spark, os.path.join(tmp, "nope")).count()


def test_dedup_matches_brute_force(spark):
    df = inject.with_duplicates(change_events(spark, SF001))
    rows = df.collect()
    best = {}
    keep = []
    for r in rows:
        if r.id == 0:
            keep.append(r)
            continue
        k = (r.wiki, r.id)
        o = (r.timestamp, r.title, r.user, r.comment)
        if k not in best or o < best[k][0]:
            best[k] = (o, r)
    want = sorted((r.id, r.wiki, r.timestamp) for r in keep + [v[1] for v in best.values()])
    got = sorted((r.id, r.wiki, r.timestamp) for r in dedup_events(df).collect())
    assert got == want


def test_anti_join_existing(spark):
    ce = ce_columns(change_events(spark, SF001))
    new = ce.withColumn("id", F.when(F.col("id") < 10, F.lit(0)).otherwise(F.col("id")))
    out = anti_join_existing(new, ce.where(F.col("id") < 500))
    assert out.where(F.col("id") == 0).count() == 10
    assert out.where((F.col("id") > 0) & (F.col("id") < 500)).count() == 0


def _events(spark, ids, ts0=1718000000):
    from eventide.schema import CHANGE_EVENT_V1
    rows = [(i, "edit" if i % 2 else "new", 0, f"T{i}", f"T{i}", "", ts0 + i, "u", bool(i % 2), "s", "n", "w",
             "enwiki", ts0 + i) for i in ids]
    return spark.createDataFrame(rows, CHANGE_EVENT_V1)


def test_flush_limits_keep_every_row(spark, tmp):
    for n, limit in ((35, 10), (5, 100), (1, 1000)):
        path = os.path.join(tmp, f"b{n}")
        write_events(_events(spark, range(n)), path, max_records_per_file=limit)
        back = read_events(spark, path)
        assert back.count() == n
        per_file = back.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
        assert per_file <= limit


def test_read_back_empty_and_100_rows(spark, tmp):
    empty = os.path.join(tmp, "empty")
    write_events(_events(spark, []), empty)
    assert read_events(spark, empty).count() == 0
    hundred = os.path.join(tmp, "hundred")
    write_events(_events(spark, range(1000, 1100)), hundred)
    back = read_events(spark, hundred)
    assert sorted(r.id for r in back.select("id").collect()) == list(range(1000, 1100))
    assert back.drop("dt", "hour").orderBy("id").collect() == _events(spark, range(1000, 1100)).orderBy("id").collect()


def test_rows_without_identity_are_kept(spark):
    from eventide.operators.dedup import dedup_events
    one = _events(spark, [0, 0, 7])
    df = one.unionByName(one).unionByName(one.limit(1).withColumn("id", F.lit(None).cast("long")))
    got = sorted((r.id is None, r.id or 0) for r in dedup_events(df).collect())
    assert got == [(False, 0)] * 4 + [(False, 7), (True, 0)]


def test_range_reads_only_its_days(spark, tmp):
    write_events(_events(spark, range(1, 5), ts0=1718000000), tmp)
    write_events(_events(spark, range(5, 9), ts0=1718000000 + 3 * 86400), tmp)
    back = read_events(spark, tmp, "2024-06-10", "2024-06-12")
    assert sorted(r.id for r in back.collect()) == [1, 2, 3, 4]
    assert all("dt=2024-06-10" in f for f in back.inputFiles())
    assert read_events(spark, tmp, "2023-01-01", "2023-01-02").count() == 0


def test_touched_partitions_beyond_the_path_limit(spark, tmp, monkeypatch):
    from eventide.plans import jobs
    stored = _events(spark, range(1, 5))
    write_events(stored, tmp, batch_id="a")
    new = _events(spark, range(3, 8))
    for limit in (1000, 0):
        monkeypatch.setattr(jobs, "READ_BY_PATH", limit)
        assert sorted(r.id for r in jobs.drop_stored(new, tmp, "b").collect()) == [5, 6, 7]
        assert sorted(r.id for r in jobs.drop_stored(new, tmp, "a").collect()) == [3, 4, 5, 6, 7]


def test_same_key_same_partition(spark):
    from eventide.sinks.wire import to_envelope
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"), F.lit(b"v").alias("value"))
    rows = to_envelope(df, "t", F.col("k")).groupBy("key").agg(F.collect_set("partition").alias("p")).collect()
    assert all(len(r.p) == 1 for r in rows) and len({r.p[0] for r in rows}) > 1
