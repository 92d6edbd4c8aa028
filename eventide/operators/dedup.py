"""Event deduplication (D1, for K6/T6 in batch).

Identity is ``(wiki, id)``; rows with ``id = 0`` or no id carry no identity
and are kept, unless broker coordinates show two to be one delivery (K6).  Among copies the row with the smallest
``(timestamp, title, user, comment, ...)`` wins, so the result is repeatable.
``min(struct)`` is an ordinary partial aggregate: a key with very many
copies is reduced on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["wiki", "id"]
ORDER = ["timestamp", "title", "user", "comment"]


def dedup_events(df: DataFrame, key=KEY, order=ORDER, delivery=()) -> DataFrame:
    """One pass: rows with an identity group by ``key``; a row without one groups
    by all its columns, and comes back as often as it was there -- but once if
    the columns ``delivery`` name its message.  Group values
    come from the row alone, so a retried task makes the same groups."""
    cols = df.columns
    rest = [c for c in cols if c not in key and c not in order]
    row = F.struct(*[F.col(c) for c in order + rest])
    nameless = F.coalesce(F.col("id"), F.lit(0)) == 0
    named = F.lit(bool(delivery))
    for c in delivery:
        named = named & F.col(f"_solo.{c}").isNotNull()
    # Groups are sorted: by the id first, which settles most comparisons as a number.
    by = sorted(key, key=lambda c: c != "id")
    best = (df.withColumn("_solo", F.when(nameless, row))
              .groupBy(*by, "_solo")
              .agg(F.min(row).alias("_b"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_copies", F.when(F.col("_solo").isNull() | named, F.lit(1)).otherwise(F.col("_n")))
              .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
              .select(*key, *[F.col(f"_b.{c}").alias(c) for c in order + rest]))
    return best.select(*cols)


def anti_join_existing(new: DataFrame, existing: DataFrame, key=KEY) -> DataFrame:
    """Drop rows already present in the target (replays of old days, §7.4).

    ``existing`` should be read with a partition filter on the days being
    replayed, so only those directories are scanned.
    """
    ids = existing.select(*key).where(F.col("id") != 0).distinct()
    return new.join(ids, on=list(key), how="left_anti")
