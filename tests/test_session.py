from eventide.session import ensure_checkpoint_dir, recommended_confs, scratch_path
from eventide.sinks.parquet import write_events
from eventide.sources.replay import read_events
from eventide.sources.tables import ce_columns, change_events
from tests.conftest import SF001


def test_checkpoint_dir_is_reused_and_scratch_is_unique(spark):
    a = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == a
    p, q = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p != q and p.startswith(a) and q.startswith(a)


def test_recommended_confs_scale():
    c = recommended_confs(8000, 100 * 10**12)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert recommended_confs(8, 10**6)["spark.sql.shuffle.partitions"] == "24"


def test_partition_by_ingest_time(spark, tmp):
    from pyspark.sql import functions as F
    ce = ce_columns(change_events(spark, SF001)).withColumn("ingest_ts", F.lit(1718000000).cast("long"))
    path = tmp + "/ingest"
    write_events(ce, path, by="ingest", ingest_col="ingest_ts")
    back = read_events(spark, path)
    assert {(r.dt, r.hour) for r in back.select("dt", "hour").distinct().collect()} == {("2024-06-10", "06")}
    assert "ingest_ts" not in back.columns and back.count() == ce.count()
