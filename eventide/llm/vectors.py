"""Vectors of a table in shards, for searches that visit every shard.

Equal vectors are one class with their smallest ids, so a vector that many
rows repeat takes one place in an index and no hot group arises.  Shards have
a bounded size; queries come in blocks, and one row of a search is a shard's
index with a block of queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize

QUERY_BLOCK = 512


def usable(table: DataFrame, component, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and components that are
    all present and finite.  ``component`` maps one as a double.  Exact
    repeats of a row count once."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
                .withColumn("v", F.transform("v", component)).distinct())


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector with its k + 1 smallest ids.  Ties go to
    smaller ids and a query leaves out only its own, so no answer needs more."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return vectors.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("v") \
                  .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def shards(found: DataFrame, size: int) -> DataFrame:
    """``found`` dealt into shards of about ``size`` rows, by length of the vector."""
    n = max(1, -(-found.count() // size))
    return found.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v", F.lit("shard")), F.lit(n)).cast("int"))


def build(dealt: DataFrame, make: Callable[[np.ndarray], list[np.ndarray]], parts: list[str], name: str) -> DataFrame:
    """One written row per shard: its vectors and ids, and the arrays that
    ``make`` returns for the vectors, as bytes."""
    def run(rows: pa.Table) -> pa.Table:
        v = np.array(rows.column("v").to_pylist(), np.float64)
        ids = rows.column("ids").to_pylist()
        order = np.lexsort((np.array([i[0] for i in ids]),))     # a fixed order whatever the shuffle delivers
        v, ids = v[order], [ids[i] for i in order]
        count = np.array([len(i) for i in ids], np.int32)
        flat = np.concatenate([np.array(i, np.int64) for i in ids])
        arrays = [v, count, flat, *make(v)]
        return pa.table({"dim": pa.array([v.shape[1]], pa.int32()), "shard": rows.column("shard").slice(0, 1).combine_chunks(),
                         **{c: pa.array([a.tobytes()], pa.binary()) for c, a in zip(["v", "count", "ids", *parts], arrays)}})

    schema = "dim int, shard int, " + ", ".join(f"{c} binary" for c in ["v", "count", "ids", *parts])
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(run, schema), name)


def query_blocks(queries: DataFrame, by: list[str]) -> DataFrame:
    """Queries (vec_id, v, ...) in lists of about ``QUERY_BLOCK`` per value of ``by``."""
    n = max(1, -(-queries.count() // QUERY_BLOCK))
    item = F.struct(*(c for c in queries.columns if c not in by))
    return (queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(n)).cast("int"))
                   .groupBy(*by, "block").agg(F.collect_list(item).alias("queries")))


def search(rows: DataFrame, parts: dict[str, type], visit: Callable, kind: str, name: str) -> DataFrame:
    """(query_id, vec_id, score) that ``visit(vectors, starts, ids, arrays,
    queries)`` yields for each row of ``rows``: a shard's index beside a list
    of queries.  Written, so that no search runs twice."""
    columns = ["dim", "v", "count", "ids", *parts, "queries"]
    width = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(width, "dim", "shard", "block").select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(n)[i].as_py() for n, c in enumerate(columns)}
                v = np.frombuffer(row["v"], np.float64).reshape(-1, row["dim"])
                starts = np.concatenate([[0], np.cumsum(np.frombuffer(row["count"], np.int32))])
                arrays = {c: np.frombuffer(row[c], t) for c, t in parts.items()}
                found = visit(v, starts, np.frombuffer(row["ids"], np.int64), arrays, row["queries"])
                query, ids, score = ([x[n] for x in found] for n in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(ids, pa.int64()),
                     pa.array(score, pa.int64() if kind == "long" else pa.float64())], names=["query_id", "vec_id", "score"])

    conf = rows.sparkSession.conf
    usual = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")     # one row is a whole shard
    try:
        return materialize(rows.mapInArrow(run, f"query_id long, vec_id long, score {kind}"), name)
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, larger scores first, ties to smaller ids."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
