"""Exact quantiles by selection: histograms of ever narrower ranges (M5, M8).

Rows are first reduced to (group, value, count).  A wanted rank is then found
as in a search: the range of its group's values is cut into equal buckets,
whose counts -- a partial aggregate over all tasks -- tell the bucket that
holds it; only that bucket's own range is cut again.  Once a range holds few
values they are put in order and counted through.  No task ever holds more
than that, wherever the values crowd.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.joins import broadcast_if_small, materialize

BUCKETS = 1024
# Distinct values of a range that one task may put in order.
FINE = 10_000


def exact_quantiles(df: DataFrame | None, group: list[str], value: str, qs: list[float],
                    counts: DataFrame | None = None, buckets: int = BUCKETS, fine: int = FINE) -> DataFrame:
    """-> (group..., q, value) with the exact continuous quantile of ``value``,
    interpolated between the two ranks around ``q * (n - 1)`` as SQL's
    ``percentile_cont`` does.  NULL values do not count; NULL groups do.

    The (group, value) -> count table is read a few times, so it is
    materialized once (a reliable checkpoint in the shared folder).  Callers
    that already hold it (column ``_c``) pass it as ``counts``.  ``buckets``
    and ``fine`` never affect the result.
    """
    fine = max(1, int(fine))
    rows = counts if counts is not None else materialize(
        df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c")))
    ends = rows.groupBy(*group).agg(F.sum("_c").alias("_n"), F.min(value).alias("_a"), F.max(value).alias("_b"),
                                    F.count(F.lit(1)).alias("_d"))
    pos = F.col("q") * (F.col("_n") - 1)
    ranks = F.array(F.struct(F.lit(0).alias("k"), F.floor(pos).cast("long").alias("r")),
                    F.struct(F.lit(1).alias("k"), F.ceil(pos).cast("long").alias("r")))
    targets = materialize(
        ends.select(*group, "_n", "_a", "_b", "_d", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
            .select(*group, "_a", "_b", "_d", "q", (pos - F.floor(pos)).alias("_frac"), F.explode(ranks).alias("_t"))
            .select(*group, "_a", "_b", "_d", "q", "_frac", F.col("_t.k").alias("_k"), F.col("_t.r").alias("_r")))
    cell = [*group, "_a", "_b"]
    wide = targets.where(F.col("_d") > fine)
    while wide.take(1):
        rows = materialize(_inside(rows, targets, group, value, fine))       # few values are left after the first time
        own = rows.where(F.col("_wide")).withColumn("_bucket", _bucket(F.col(value), buckets))
        hist = own.groupBy(*cell, "_bucket").agg(F.sum("_c").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
                                                 F.count(F.lit(1)).alias("_m"))
        moved = _holding(hist, wide, cell, "_bucket").select(
            *group, F.col("_lo").alias("_a"), F.col("_hi").alias("_b"), F.col("_m").alias("_d"), "q", "_frac", "_k",
            (F.col("_r") - F.col("_before")).alias("_r"))
        targets = materialize(moved.unionByName(targets.where(F.col("_d") <= fine)))
        rows, wide = rows.select(*group, value, "_c").distinct(), targets.where(F.col("_d") > fine)
    last = _inside(rows, targets, group, value, fine).withColumnRenamed("_c", "_n")
    found = _holding(last, targets, cell, value).groupBy(*group, "q", "_frac").agg(
        F.max(F.when(F.col("_k") == 0, F.col(value))).alias("_low"), F.max(F.when(F.col("_k") == 1, F.col(value))).alias("_high"))
    return found.select(*group, "q", (F.col("_low") + F.col("_frac") * (F.col("_high") - F.col("_low"))).alias(value))


def _bucket(v, buckets: int):
    """Never falls as ``v`` grows; the ends of the range never share one.  Equal
    steps of the logarithm, so that an outlier does not take the buckets of the rest."""
    scaled = lambda x: F.signum(x) * F.log1p(F.abs(x))
    low, high = scaled(F.col("_a")), scaled(F.col("_b"))
    at = F.floor((scaled(v) - low) / (high - low) * buckets).cast("int")
    return (F.when(v == F.col("_a"), F.lit(0)).when(v == F.col("_b"), F.lit(buckets - 1))
            .otherwise(F.greatest(F.lit(0), F.least(F.lit(buckets - 1), F.coalesce(at, F.lit(0))))))


def _inside(rows: DataFrame, targets: DataFrame, group: list[str], value: str, fine: int = FINE) -> DataFrame:
    """The rows of the ranges that hold a target, with their range and whether it is to be cut again."""
    ranges = targets.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_a", "_b", (F.col("_d") > fine).alias("_wide")).distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col(value) >= F.col("_a"), F.col(value) <= F.col("_b")]
    if not group:
        ranges, rows, same = ranges.withColumn("_g", F.lit(0)), rows.withColumn("_h", F.lit(0)), [F.col("_g") == F.col("_h"), *same]
    return rows.join(broadcast_if_small(ranges), same).select(*group, value, "_c", "_a", "_b", "_wide")


def _holding(parts: DataFrame, targets: DataFrame, cell: list[str], order: str) -> DataFrame:
    """Each target with the part of its range (in ``order``, of ``_n`` rows) that holds its rank."""
    w = Window.partitionBy(*cell).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = parts.withColumn("_cum", F.sum("_n").over(w)).withColumn("_before", F.col("_cum") - F.col("_n"))
    t = targets.select(*[F.col(c).alias(f"_t{c}") for c in cell], "q", "_frac", "_k", "_r")
    same = [F.col(c).eqNullSafe(F.col(f"_t{c}")) for c in cell] + [F.col("_before") <= F.col("_r"), F.col("_r") < F.col("_cum")]
    return upto.join(broadcast_if_small(t), same).drop(*[f"_t{c}" for c in cell])
