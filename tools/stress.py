"""Stress the skew-sensitive operators on amplified data with a hot key.

    python tools/stress.py [rows] [sf_dir]

The load generator (G1) amplifies the ``events`` change-event view to
``rows`` rows, written once to the shared scratch folder.  Then one key gets
a large share of all rows: wiki ``enwiki`` (about half) and retry message
``hot`` (a third).  The operators that partition by those keys run
over the whole table and are timed; results are sanity-checked.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from eventide.operators import features, metrics, windows
    from eventide.operators.dedup import dedup_events
    from eventide.operators.generate import amplify
    from eventide.operators.reliability import retry_route
    from eventide.session import get_session, scratch_path
    from eventide.sources.tables import ce_columns, change_events

    spark = get_session("local[8]", shuffle_partitions=64, app="eventide-stress", driver_memory="16g")
    span = 30 * 86400
    seed = ce_columns(change_events(spark, sf_dir))
    path = scratch_path(spark, "stress")
    t0 = time.perf_counter()
    gen = amplify(seed, rows, rate=max(1, rows // span), partitions=32)
    gen = (gen.withColumn("wiki", F.when(F.col("id") % 3 == 0, F.lit("enwiki")).otherwise(F.col("wiki")))
              .withColumn("duration_s", (F.pmod(F.xxhash64("id"), F.lit(20000)) / 1000.0)))
    gen.write.parquet(path)
    out = {"rows": rows, "generate_sec": round(time.perf_counter() - t0, 2)}
    ev = spark.read.parquet(path)
    hot_share = ev.where(F.col("wiki") == "enwiki").count() / rows

    def timed(name, df, check=None):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t, 2)
        if check:
            out[name + "_check"] = check()

    timed("window_counts_union", windows.window_counts_union(ev))
    dup = ev.unionByName(ev.where(F.col("id") % 10 == 0).withColumn("timestamp", F.col("timestamp") + 5))
    timed("dedup", dedup_events(dup.drop("duration_s")),
          lambda: dedup_events(dup.drop("duration_s")).count() == rows)
    att = ev.select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("user")).alias("part"),
                    F.col("id").alias("attempt"), (F.pmod(F.col("id"), F.lit(7)) < 3).alias("failed"))
    timed("retry_route", retry_route(att, ["part"], "attempt", "failed", chunk_width=1 << 16))
    from eventide.operators.joins import materialize
    t = time.perf_counter()
    stats = materialize(features.edit_stats(ev))      # computed and written once, read by the as-of join
    out["edit_stats"] = round(time.perf_counter() - t, 2)
    timed("asof_join", features.asof_join(ev.select("id", "wiki", "timestamp"), stats, ["wiki"],
                                          "timestamp", "feature_ts", ttl=7200),
          lambda: features.asof_join(ev.select("id", "wiki", "timestamp"), stats, ["wiki"],
                                     "timestamp", "feature_ts", ttl=7200).count() == rows)
    lat = ev.select("wiki", (F.col("duration_s") * 1000).alias("latency_ms"),
                    (F.col("type") == "error").alias("is_error"), "timestamp")
    t = time.perf_counter()      # slo_report materializes its count table when called: time that too
    metrics.slo_report(lat, ["wiki"], "latency_ms", "is_error", "timestamp") \
        .write.format("noop").mode("overwrite").save()
    out["slo_report"] = round(time.perf_counter() - t, 2)
    out["hot_key_share"] = round(hot_share, 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
