"""As-of values by carrying the last one along, in chunks of time.

Both sides are laid into one order per key; each left row takes the last right
row before it.  Keys are cut into chunks of time: within a chunk a window
carries the values, and the last right row of the chunks before comes from a
small table with one row per key and chunk.  Nothing is repeated per hour of
validity, so the work does not depend on the time to live, and a key with a
third of all rows is spread over its chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.joins import broadcast_if_small

CHUNK_SECONDS = 6 * 3600


def asof_carry(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str,
               ttl: int | None = None, chunk: int = CHUNK_SECONDS) -> DataFrame:
    """Each row of ``left`` with the columns of the newest row of ``right`` of
    the same ``by`` whose ``right_ts`` is not after ``left_ts`` and, with
    ``ttl``, at most ``ttl`` seconds before it; NULL where there is none.

    Of right rows with the same key and time the one with the largest other
    columns, in their order, counts.  Rows of ``left`` with a NULL key or time
    match nothing and stay; repeated rows stay each.
    """
    names = [c for c in right.columns if c not in by]
    value = F.struct(*([F.col(right_ts)] + [F.col(c) for c in names if c != right_ts]))
    r = right.where(F.col(right_ts).isNotNull())
    r = r.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col(right_ts).cast("long").alias("_t"),
                 F.lit(0).alias("_side"), value.alias("_value"))
    # One right row per key and time; a partial aggregate.
    keys = [f"_k{i}" for i in range(len(by))]
    r = r.groupBy(*keys, "_t", "_side").agg(F.max("_value").alias("_value"))
    r = r.select("*", F.lit(None).cast(left.schema).alias("_row"))
    l = left.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(left_ts).cast("long").alias("_t"), F.lit(1).alias("_side"),
                    F.lit(None).cast(r.schema["_value"].dataType).alias("_value"), F.struct(*left.columns).alias("_row"))
    both = r.unionByName(l).withColumn("_chunk", F.floor(F.col("_t") / F.lit(chunk)).cast("long"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("_local", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")
    # The last right row of each chunk, carried over the key's later chunks.
    ends = both.groupBy(*keys, "_chunk").agg(F.max("_value").alias("_end"))
    over = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_chunk", F.last("_end", ignorenulls=True).over(over).alias("_carried")) \
                  .where("_carried is not null")
    carried = broadcast_if_small(carried.select(*[F.col(k).alias(f"_c{k}") for k in keys], F.col("_chunk").alias("_c_chunk"), "_carried"))
    same = [local[k] == carried[f"_c{k}"] for k in keys] + [local["_chunk"] == carried["_c_chunk"]]
    found = local.join(carried, same, "left").withColumn("_found", F.coalesce("_local", "_carried"))
    nameless = F.lit(False)
    for k in keys:
        nameless = nameless | F.col(k).isNull()
    usable = F.col("_found").isNotNull() & F.col("_t").isNotNull() & ~nameless
    if ttl is not None:
        usable = usable & (F.col("_t") - F.col(f"_found.{right_ts}") <= F.lit(ttl))
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in left.columns],
                        *[F.when(usable, F.col(f"_found.{c}")).alias(c) for c in names])
