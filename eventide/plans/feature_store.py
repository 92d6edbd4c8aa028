"""The feature store as Spark jobs: retrieval over both views (F7) and
incremental materialization (F8).

A store is a folder:

* ``hours/dt=``          per key and hour the counts that the statistics are made of;
* ``grid/dt=``           the statistics on their hourly grid, by day of ``feature_ts``;
* ``latest/version=N``   the newest statistics of each key;
* ``bookmark/version=N`` per run of the store job the last batch that is in.

The store job leaves beside the events which (day, hour) partitions each batch
touched (``commit_partitions``).  A materialization reads those of the batches
after the bookmark, counts only these hours anew from the stored events, and
recomputes only the 24 grid hours that each of them feeds; the other hours of
these days are carried over as they are.  The bookmark moves
last: a run that is lost repeats the same hours and overwrites the same files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.carry import asof_carry
from eventide.operators.features import (DAY, EDIT_STATS_TTL, EVENT_FEATURES_TTL, HOUR, grid_of_hours,
                                         hour_counts)
from eventide.operators.joins import materialize
from eventide.operators.offsets import _fs
from eventide.sources.replay import STORED, read_partitions

COMMITS_DIR = "_commits"
COMMITS = "dt string, hour string, run string, batch long"
PLACE = [T.StructField("dt", T.StringType())]
HOURS = T.StructType([T.StructField("wiki", T.StringType()), T.StructField("hr", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("u", T.LongType()), T.StructField("b", T.LongType()), *PLACE])
GRID = T.StructType([T.StructField("wiki", T.StringType()), T.StructField("feature_ts", T.LongType()),
                     T.StructField("edits_last_hour", T.LongType()), T.StructField("edits_last_24h", T.LongType()),
                     T.StructField("unique_users_last_hour", T.LongType()), T.StructField("bot_fraction", T.DoubleType()),
                     T.StructField("avg_edits_per_user", T.DoubleType()), *PLACE])

LATEST = T.StructType([f for f in GRID.fields if f.name != "dt"])


# --- retrieval --------------------------------------------------------------------------

def feature_service(entities: DataFrame, events: DataFrame, stats: DataFrame, at: str = "request_ts",
                    event_ttl: int = EVENT_FEATURES_TTL, stats_ttl: int = EDIT_STATS_TTL) -> DataFrame:
    """each row of ``entities`` (event_id, wiki, ``at``) with the features of
    both views as of its time: the event's own by ``event_id``, the edit
    statistics of its wiki, each NULL beyond the view's time to live.

    ``events`` is ``feature_events``, ``stats`` is ``edit_stats``.  Of several
    versions of one event the newest that is not after the request counts.
    """
    own = events.drop("wiki").withColumnRenamed("feature_ts", "event_feature_ts")
    own = own.withColumnRenamed("timestamp", "event_timestamp")
    found = asof_carry(entities, own, ["event_id"], at, "event_feature_ts", event_ttl, chunk=30 * DAY)
    return asof_carry(found, stats.withColumnRenamed("feature_ts", "stats_feature_ts"), ["wiki"], at, "stats_feature_ts", stats_ttl)


# --- what the store job leaves behind -----------------------------------------------------

def commit_partitions(places: DataFrame, events_dir: str, run: str, batch: int) -> None:
    """Note the (dt, hour) partitions that ``batch`` of ``run`` touched."""
    path = f"{events_dir.rstrip('/')}/{COMMITS_DIR}/run={run}/batch={batch:010d}"
    places.select("dt", "hour").distinct().coalesce(1).write.mode("overwrite").parquet(path)


def touched_after(spark: SparkSession, events_dir: str, seen: DataFrame | None) -> DataFrame:
    """(dt, hour, run, batch) of the batches after those of ``seen`` (run, batch)."""
    root = f"{events_dir.rstrip('/')}/{COMMITS_DIR}"
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return spark.createDataFrame([], COMMITS)
    every = spark.read.schema(COMMITS).parquet(root)
    if seen is None:
        return every
    done = seen.select("run", F.col("batch").alias("_done"))
    return every.join(F.broadcast(done), "run", "left").where("_done is null or batch > _done").drop("_done")  # a row per run


# --- materialization --------------------------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    make = spark._jvm.org.apache.hadoop.fs.Path
    there = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("version=")]
    return sorted(int(x.getName()[8:]) for x in there if fs.exists(make(x, "_SUCCESS")))


def _last(spark: SparkSession, path: str, schema) -> DataFrame | None:
    n = _versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/version={n[-1]}") if n else None


def _write_version(df: DataFrame, path: str, n: int) -> None:
    """Version ``n``; the one before stays for readers, older ones go."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/version={n}")
    for old in _versions(spark, path)[:-2]:
        fs, p = _fs(spark, f"{path}/version={old}")
        fs.delete(p, True)


def _utc(hr: int) -> _dt.datetime:
    return _dt.datetime.fromtimestamp(hr * HOUR, _dt.timezone.utc)


def _days(hours: list[int]) -> list[str]:
    return sorted({f"dt={_utc(h):%Y-%m-%d}" for h in hours})


def _read(spark: SparkSession, path: str, hours: list[int], schema: T.StructType) -> DataFrame:
    """The rows of the days of these hours; only their folders are listed."""
    fs, p = _fs(spark, path)
    return read_partitions(spark, path, _days(hours), schema) if fs.exists(p) else spark.createDataFrame([], schema)


def _replace_hours(new: DataFrame, hr, path: str, hours: list[int], schema: T.StructType) -> DataFrame:
    """Put ``new`` in place of the rows of ``hours``; of their days the other
    rows stay.  Other days are neither read nor written.  Returns ``new``, written."""
    spark = new.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(h,) for h in hours], "_hr long"))       # a number per touched hour
    day = F.date_format(F.timestamp_add("HOUR", hr.cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")), "yyyy-MM-dd")
    new = materialize(new.join(wanted, hr == F.col("_hr"), "left_semi").withColumn("dt", day).select(*schema.fieldNames()))
    other = _read(spark, path, hours, schema).join(wanted, hr == F.col("_hr"), "left_anti")
    days = materialize(new.unionByName(other))          # before its files are overwritten
    (days.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt").parquet(path))
    return new


def materialize_incremental(spark: SparkSession, events_dir: str, store: str, window: int = 24) -> int:
    """F8: bring ``store`` up to date with the batches stored in ``events_dir``
    since the last time; returns how many hours were counted anew.

    The work follows the hours that the new batches touched, however much is
    stored besides; their list is all that the driver sees (a string per hour).
    """
    store = store.rstrip("/")
    seen = _last(spark, f"{store}/bookmark", "run string, batch long")
    new = materialize(touched_after(spark, events_dir, seen))
    places = new.select("dt", "hour").distinct().collect()
    if not places:
        return 0
    at = [_dt.datetime.fromisoformat(f"{r.dt}T{r.hour}:00:00+00:00") for r in places]
    hours = sorted(int(t.timestamp()) // HOUR for t in at)
    # Hours: counted from all stored events of the touched ones.
    paths = [f"dt={_utc(h):%Y-%m-%d}/hour={_utc(h):%H}" for h in hours]
    counted = hour_counts(read_partitions(spark, events_dir, paths, STORED))
    _replace_hours(counted, F.col("hr"), f"{store}/hours", hours, HOURS)
    # Grid: the hours that these feed, each from the ``window`` hours up to it.
    fed = sorted({h + k for h in hours for k in range(window)})
    needed = sorted({h - k for h in fed for k in range(window)})
    base = _read(spark, f"{store}/hours", needed, HOURS).drop("dt")
    grid = _replace_hours(grid_of_hours(base, window=window), F.col("feature_ts") / HOUR, f"{store}/grid",
                          [h + 1 for h in fed], GRID).drop("dt")
    # Latest: of what was there and what changed, the newest; at the same time the changed one.
    cols = [c for c in GRID.fieldNames() if c not in ("wiki", "feature_ts", "dt")]
    before = _last(spark, f"{store}/latest", LATEST)
    both = grid.withColumn("_new", F.lit(1))
    if before is not None:
        both = both.unionByName(before.withColumn("_new", F.lit(0)))
    newest = both.groupBy("wiki").agg(F.max(F.struct("feature_ts", "_new", *cols)).alias("_b"))
    n = (_versions(spark, f"{store}/bookmark") or [0])[-1] + 1
    _write_version(newest.select("wiki", *[F.col(f"_b.{c}").alias(c) for c in ["feature_ts", *cols]]), f"{store}/latest", n)
    marks = new.select("run", "batch")
    if seen is not None:
        marks = marks.unionByName(seen)
    _write_version(marks.groupBy("run").agg(F.max("batch").alias("batch")).coalesce(1), f"{store}/bookmark", n)
    return len(hours)


def read_grid(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(GRID).parquet(f"{store.rstrip('/')}/grid").drop("dt")


def read_latest(spark: SparkSession, store: str) -> DataFrame:
    found = _last(spark, f"{store.rstrip('/')}/latest", LATEST)
    return found if found is not None else spark.createDataFrame([], LATEST)
