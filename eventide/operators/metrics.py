"""Operational metrics as aggregate queries (M1-M8).

Counters, cumulative histograms and rates are single-pass aggregates with
map-side partial aggregation.  Histogram quantiles work on the (tiny)
histogram table; exact latency quantiles use ``exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import error_type, window_start_ms
from eventide.operators.joins import materialize
from eventide.operators.quantiles import exact_quantiles

# Default latency bucket bounds in seconds (upper bounds, "le").
DEFAULT_BUCKETS = [("0.005", 0.005), ("0.01", 0.01), ("0.025", 0.025), ("0.05", 0.05),
                   ("0.1", 0.1), ("0.25", 0.25), ("0.5", 0.5), ("1", 1.0), ("2.5", 2.5),
                   ("5", 5.0), ("10", 10.0)]


def linear_buckets(start: float, width: float, count: int) -> list[tuple[str, float]]:
    """``count`` bounds start, start+width, ... (the batch-size histogram uses 10, 100, 20)."""
    out = []
    for i in range(count):
        b = start + i * width
        out.append((str(int(b)) if float(b).is_integer() else repr(b), float(b)))
    return out


BATCH_SIZE_BUCKETS = linear_buckets(10, 100, 20)
# Service-level thresholds (ms, fraction, events per second).
SLO_P50_MS, SLO_P95_MS, SLO_P99_MS = 50.0, 200.0, 500.0
SLO_ERROR_RATE = 0.01
SLO_WRITE_RATE = 100.0


def counters(outcomes: DataFrame, topic: str, error: str = "error_message") -> DataFrame:
    """M1: published / consumed / failed totals (failed by error type) in one pass.

    ``outcomes`` holds one row per message with its error (NULL when it was
    consumed).  Each row feeds two counters -- published, and consumed or
    failed -- through one explode and one partial aggregate.
    """
    failed = F.struct(F.lit("events_failed_total").alias("metric"), error_type(F.col(error)).alias("type"))
    consumed = F.struct(F.lit("events_consumed_total").alias("metric"), F.lit("").alias("type"))
    published = F.struct(F.lit("events_published_total").alias("metric"), F.lit("").alias("type"))
    outcome = F.when(F.col(error).isNull(), consumed).otherwise(failed)
    return (outcomes.select(F.explode(F.array(published, outcome)).alias("c"))
            .groupBy(F.col("c.metric").alias("metric"), F.lit(topic).alias("topic"), F.col("c.type").alias("type"))
            .agg(F.count(F.lit(1)).alias("value")))


def histogram(df: DataFrame, value: str, buckets=DEFAULT_BUCKETS, group: list[str] = ()) -> DataFrame:
    """M2: cumulative ``le`` buckets, one pass: (group..., le, count)."""
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"_b{i}") for i, (_, b) in enumerate(buckets)]
    aggs.append(F.count(v).alias("_inf"))      # NULL is no observation
    h = df.groupBy(*group).agg(*aggs)
    pairs = [F.struct(F.lit(s).alias("le"), F.col(f"_b{i}").alias("count"))
             for i, (s, _) in enumerate(buckets)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("_inf").alias("count")))
    return h.select(*group, F.explode(F.array(*pairs)).alias("_p")) \
            .select(*group, "_p.le", F.col("_p.count").cast("long").alias("count"))


def histogram_quantiles(df: DataFrame, value: str, qs: list[float], buckets=DEFAULT_BUCKETS,
                        group: list[str] = ()) -> DataFrame:
    """M5: quantiles estimated from cumulative buckets, linear inside a bucket.

    The first bucket whose cumulative count reaches ``q * total`` is
    interpolated from the previous bound (0 below the first); when only the
    ``+Inf`` bucket reaches it, the last finite bound is returned.
    """
    v = F.col(value)
    bounds = F.array(*[F.lit(b) for _, b in buckets])
    h = df.groupBy(*group).agg(
        F.array(*[F.count_if(v <= F.lit(b)).cast("double") for _, b in buckets]).alias("cum"),
        F.count(v).cast("double").alias("total")).where("total > 0")
    h = h.select(*group, "cum", "total", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    rank = F.col("q") * F.col("total")
    b = F.array_position(F.transform("cum", lambda c: c >= rank), True)  # 1-based, 0 = none
    prev_cum = F.when(b > 1, F.element_at("cum", (b - 1).cast("int"))).otherwise(F.lit(0.0))
    start = F.when(b > 1, F.element_at(bounds, (b - 1).cast("int"))).otherwise(F.lit(0.0))
    end = F.element_at(bounds, b.cast("int"))
    cnt = F.element_at("cum", b.cast("int")) - prev_cum
    interp = F.when(cnt > 0, start + (end - start) * (rank - prev_cum) / cnt).otherwise(start)
    last = F.lit(buckets[-1][1])
    first_nonpos = (b == 1) & (F.lit(buckets[0][1]) <= 0)
    est = (F.when(b == 0, last)
           .when(first_nonpos, F.lit(buckets[0][1]))
           .otherwise(interp))
    return h.select(*group, "q", F.round(est, 6).alias("value"))


def rate_per_second(df: DataFrame, ts: str, group: list[str], width_seconds: int = 60) -> DataFrame:
    """M3/M4: increase per aligned window divided by its length."""
    start = window_start_ms(ts, width_seconds).alias("window_start")
    return (df.groupBy(start, *group)
              .agg(F.round(F.count(F.lit(1)) / F.lit(float(width_seconds)), 6).alias("rate")))


def consumer_lag(latest: DataFrame, committed: DataFrame, key: list[str]) -> DataFrame:
    """M6: per partition, latest offset minus committed offset."""
    return lag_of(latest.join(committed, on=key, how="left"), key)


def lag_of(offsets: DataFrame, key: list[str]) -> DataFrame:
    """M6 where one row per partition has both offsets: nothing committed counts as 0."""
    done = F.coalesce(F.col("committed_offset"), F.lit(0)).cast("long")
    return offsets.select(*key, "end_offset", done.alias("committed_offset"),
                          (F.col("end_offset") - done).cast("long").alias("lag"))


def flush_batch_sizes(df: DataFrame, ts: str, group: list[str], interval_seconds: int = 30,
                      max_rows: int = 1000) -> DataFrame:
    """M7 input: rows per flushed batch when a buffer flushes every ``interval``
    seconds or at ``max_rows`` rows, whichever comes first."""
    t = F.col(ts).cast("long")
    per = df.groupBy(*group, (t - F.pmod(t, F.lit(interval_seconds))).alias("_slot")) \
            .agg(F.count(F.lit(1)).alias("_n"))
    k = F.explode(F.sequence(F.lit(1).cast("long"),
                             F.ceil(F.col("_n") / F.lit(max_rows)).cast("long"))).alias("_k")
    return per.select(*group, "_slot", "_n", k) \
              .select(*group, "_slot",
                      F.least(F.lit(max_rows).cast("long"),
                              F.col("_n") - (F.col("_k") - 1) * max_rows).alias("batch_size"))


def slo_report(df: DataFrame, group: list[str], latency_ms: str, is_error: str, ts: str,
               approx_accuracy: int | None = None) -> DataFrame:
    """M8: latency percentiles, error rate and write rate against the thresholds.

    Percentiles are exact by default (``exact_quantiles``); ``approx_accuracy``
    switches to ``percentile_approx`` (a mergeable sketch, relative rank error
    about 1/accuracy) for very high-cardinality latencies.
    """
    if approx_accuracy:
        qs = F.percentile_approx(latency_ms, [0.5, 0.95, 0.99], approx_accuracy)
        q = df.groupBy(*group).agg(qs.alias("_q")).select(
            *group, F.explode(F.arrays_zip(F.array(*[F.lit(x) for x in (0.5, 0.95, 0.99)]).alias("q"),
                                           F.col("_q").alias("v"))).alias("_z")) \
            .select(*group, F.col("_z.q").alias("q"), F.col("_z.v").alias(latency_ms))
        r = df.groupBy(*group).agg(
            F.avg(F.col(is_error).cast("double")).alias("error_rate"),
            (F.count(F.lit(1)) / (F.max(ts) - F.min(ts) + 1).cast("double")).alias("write_rate"))
    else:
        # one compact pre-aggregate per (group, latency), materialized once, feeds both
        # the quantiles and the rates: the input is scanned a single time
        vc = materialize(df.groupBy(*group, latency_ms).agg(
            F.count(F.lit(1)).alias("_c"), F.sum(F.col(is_error).cast("long")).alias("_e"),
            F.min(ts).alias("_tmin"), F.max(ts).alias("_tmax")))
        q = exact_quantiles(None, group, latency_ms, [0.5, 0.95, 0.99],
                            counts=vc.where(F.col(latency_ms).isNotNull()).select(*group, latency_ms, "_c"))
        r = vc.groupBy(*group).agg(
            (F.sum("_e") / F.sum("_c")).alias("error_rate"),
            (F.sum("_c") / (F.max("_tmax") - F.min("_tmin") + 1).cast("double")).alias("write_rate"))
    p = q.groupBy(*group).agg(
        *[F.max(F.when(F.col("q") == F.lit(x), F.col(latency_ms))).alias(n)
          for x, n in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))])
    j = p.join(r, on=group, how="inner")
    return j.select(
        *group,
        *[F.round(c, 6).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms", "error_rate", "write_rate")],
        ((F.col("p50_ms") < SLO_P50_MS) & (F.col("p95_ms") < SLO_P95_MS)
         & (F.col("p99_ms") < SLO_P99_MS)).alias("latency_ok"),
        (F.col("error_rate") < SLO_ERROR_RATE).alias("error_rate_ok"),
        (F.col("write_rate") > SLO_WRITE_RATE).alias("write_rate_ok"))
