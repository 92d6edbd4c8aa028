"""Feature views and point-in-time retrieval.

Edit statistics live on an hourly grid per wiki: the row at ``feature_ts``
summarises ``[feature_ts - 1h, feature_ts)`` and ``[feature_ts - 24h,
feature_ts)``, so it uses nothing at or after its own timestamp and the
as-of join cannot leak future data.

The as-of join is an equi-join: every feature row is valid on the interval
up to the next row of its key (capped by the TTL), the interval is cut into
fixed buckets, and events join on (key, bucket) plus a range predicate.
Each event matches at most one interval, a hot key is spread over its
buckets, and the exploded side is bounded by keys x buckets in the time span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.joins import broadcast_if_small
from eventide.operators.scan import next_in_order

HOUR = 3600
DAY = 24 * HOUR
# Time-to-live of the two feature views (90 and 365 days).
EVENT_FEATURES_TTL = 90 * DAY
EDIT_STATS_TTL = 365 * DAY


def feature_events(ce: DataFrame) -> DataFrame:
    """the raw-event feature view keyed by ``event_id``."""
    return ce.select(
        F.col("id").alias("event_id"), "wiki", "type", F.col("namespace").cast("int").alias("namespace"),
        "title", "user", F.col("bot").cast("int").alias("bot"), "timestamp", "server_name", "comment",
        F.col("timestamp").alias("feature_ts"))


def edit_stats(ce: DataFrame, key: str = "wiki", user: str = "user",
               approx_users: float | None = None, start: int | None = None,
               end: int | None = None) -> DataFrame:
    """F2-F6 on the hourly grid.

    One aggregate per (key, hour) -- partial aggregation first, so a hot key
    is reduced per task -- then each hourly row is fanned out to the 24 grid
    hours it feeds (a fixed factor) and summed: one scan, no join.  Rows exist for every hour
    with ``edits_last_24h > 0``; quiet hours give 0 counts and NULL ratios.
    ``start`` and ``end`` keep the rows with ``start <= feature_ts < end``; only
    the events that they look back on are read.
    """
    if start is not None:
        ce = ce.where(F.col("timestamp") >= F.lit(start - DAY))
    if end is not None:
        ce = ce.where(F.col("timestamp") < F.lit(end))
    g = grid_of_hours(hour_counts(ce, key, user, approx_users), key)
    at = F.col("feature_ts")
    if start is not None:
        g = g.where(at >= F.lit(start))
    if end is not None:
        g = g.where(at < F.lit(end))
    return g


def hour_counts(ce: DataFrame, key: str = "wiki", user: str = "user", approx_users: float | None = None) -> DataFrame:
    """(key, hr, n, u, b): events, distinct users and bot events per key and hour since 1970."""
    hr = F.floor(F.col("timestamp") / F.lit(HOUR)).cast("long")
    return (ce.select(key, user, "bot", hr.alias("hr"))
              .groupBy(key, "hr")
              .agg(F.count(F.lit(1)).alias("n"),
                   (F.approx_count_distinct(user, approx_users) if approx_users
                    else F.count_distinct(user)).alias("u"),
                   F.sum(F.col("bot").cast("int")).cast("long").alias("b")))


def grid_of_hours(h: DataFrame, key: str = "wiki", window: int = 24) -> DataFrame:
    """The statistics at the end of each hour that ``hour_counts`` rows feed."""
    # fan each hourly row out to the grid hours it feeds; offset 0 also
    # carries the hour's own counts, so one aggregate yields both windows
    k = F.col("_k")
    fan = h.select(key, "hr", "n", "u", "b", F.explode(F.sequence(F.lit(0), F.lit(window - 1))).alias("_k")) \
           .select(key, (F.col("hr") + k).alias("hr"), "n",
                   F.when(k == 0, F.col("n")).alias("n1"), F.when(k == 0, F.col("u")).alias("u1"),
                   F.when(k == 0, F.col("b")).alias("b1"))
    g = fan.groupBy(key, "hr").agg(F.sum("n").cast("long").alias("n24"), F.max("n1").alias("n1"),
                                   F.max("u1").alias("u1"), F.max("b1").alias("b1"))
    return g.select(
        key,
        ((F.col("hr") + 1) * HOUR).cast("long").alias("feature_ts"),
        F.coalesce(F.col("n1"), F.lit(0)).cast("long").alias("edits_last_hour"),
        F.col("n24").alias("edits_last_24h"),
        F.coalesce(F.col("u1"), F.lit(0)).cast("long").alias("unique_users_last_hour"),
        F.round(F.col("b1") / F.col("n1"), 6).alias("bot_fraction"),
        F.round(F.col("n1") / F.col("u1"), 6).alias("avg_edits_per_user"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str,
              ttl: int | None = None, bucket: int = HOUR, chunk_width: int | None = None) -> DataFrame:
    """left join each left row to the newest right row of the same ``by`` key
    with ``right_ts <= left_ts`` and, with ``ttl``, ``left_ts - right_ts <= ttl``.

    ``right`` must have unique (by, right_ts).  Its other columns are added
    (NULL when there is no match).  Implemented as interval explode + equi-join;
    the next right row per key comes from ``next_in_order`` (chunked, so a
    key with very many right rows is not one task).
    """
    iv = next_in_order(right, by, right_ts, out="_nxt", chunk_width=chunk_width or bucket * 1024)
    nxt = F.col("_nxt")
    end = nxt
    if ttl is not None:
        cap = F.col(right_ts) + F.lit(ttl + 1)
        end = F.least(F.coalesce(nxt, cap), cap)
    iv = iv.withColumn("_end", end).drop("_nxt")
    if ttl is None:
        # open-ended last interval: bucket it up to the newest left timestamp
        hi = left.agg(F.max(left_ts)).first()[0]
        iv = iv.withColumn("_end", F.coalesce(F.col("_end"), F.lit(int(hi or 0) + 1)))
    b = F.lit(bucket)
    iv = iv.withColumn("_bucket", F.explode(F.sequence(
        F.floor(F.col(right_ts) / b).cast("long"),
        F.floor((F.col("_end") - 1) / b).cast("long"))))
    rcols = [c for c in right.columns if c not in by]
    iv = iv.select(*[F.col(c).alias(f"_r_{c}") for c in by], "_bucket", "_end",
                   *[F.col(c).alias(f"_r_{c}") for c in rcols])
    lb = left.withColumn("_bucket", F.floor(F.col(left_ts) / b).cast("long"))
    cond = [lb[c] == iv[f"_r_{c}"] for c in by] + [lb["_bucket"] == iv["_bucket"],
                                                   iv[f"_r_{right_ts}"] <= lb[left_ts],
                                                   lb[left_ts] < iv["_end"]]
    j = lb.join(broadcast_if_small(iv), on=cond, how="left")
    return j.select(*[lb[c] for c in left.columns],
                    *[F.col(f"_r_{c}").alias(c) for c in rcols])


def latest_per_key(df: DataFrame, key: list[str], ts: str, start: int | None = None,
                   end: int | None = None) -> DataFrame:
    """F8: newest row per key with ``start <= ts < end`` (materialize incremental).

    ``max_by`` over a struct is a partial aggregate: one row per key per task
    crosses the shuffle, however many rows a key has.  Of rows with the same
    time the one with the largest other columns, in their order, is the newest.
    """
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end))
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max(F.struct(ts, *(c for c in rest if c != ts))).alias("_b"))
    return best.select(*key, *[F.col(f"_b.{c}").alias(c) for c in rest])


def feature_source(spark, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The feature file source -- stored dt/hour Parquet read back (partition
    pruned by day) with its event time as the feature timestamp (D7)."""
    from eventide.sources.replay import read_events
    return feature_events(read_events(spark, path, date_from, date_to))
