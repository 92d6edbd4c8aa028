"""Exact top-k by inner product, over KD-trees.

Each shard holds a tree of median splits on the widest side, every node with
the tight box of its vectors.  A query takes nodes best first: the box's
corner that suits the query bounds every score below it, and the search ends
when no open box can beat the k-th best score.  That score is propagated: a
query first searches one shard, and its k-th best there bounds the search of
all others.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import vectors
from eventide.llm.common import materialize

SHARD_VECTORS = 4096
LEAF = 64
EXACT = float(1 << 53)
LONG_MAX = (1 << 63) - 1
LOWEST = -(1 << 63)


def build_tree(v: np.ndarray) -> list[np.ndarray]:
    """[order, node]: vectors in the order of the leaves, and for each node
    (start, stop, left child, right child), children -1 for leaves.  Boxes are
    the bounds of the rows from start to stop."""
    order, nodes = np.arange(len(v)), []

    def split(start: int, stop: int) -> int:
        at = len(nodes)
        nodes.append([start, stop, -1, -1])
        if stop - start > LEAF:
            own = v[order[start:stop]]
            axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
            mid = (stop - start) // 2
            order[start:stop] = order[start:stop][np.argpartition(own[:, axis], mid, kind="introselect")]
            nodes[at][2] = split(start, start + mid)
            nodes[at][3] = split(start + mid, stop)
        return at

    split(0, len(v))
    return [order.astype(np.int32), np.array(nodes, np.int32)]


def product(a: np.ndarray, q: np.ndarray, small: bool):
    """Exact integer products of each row with ``q``."""
    if small:
        return (a @ q).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(row, q)) for row in a], object)


def visit_tree(v, starts, ids, arrays, queries, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of one shard's k best for each query that can beat
    its bound; scores beyond the range of a long are its ends."""
    order, nodes = arrays["order"], arrays["node"].reshape(-1, 4)
    v = v[order]
    low = np.array([v[s:e].min(axis=0) for s, e, _, _ in nodes])
    high = np.array([v[s:e].max(axis=0) for s, e, _, _ in nodes])
    largest, out = np.abs(v).max(initial=0.0), []
    for x in queries:
        q = np.array(x["v"], np.float64)
        small = largest * np.abs(q).max() * len(q) < EXACT      # products and sums are whole doubles
        # Where products are no whole doubles the bound is rounded up generously.
        up = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        if not small:
            up = up + 1e-9 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T) + 1
        floor = x["bound"] if x["bound"] is not None else None
        best: list = []             # min-heap of (score, -id)
        open_ = [(-up[0], 0)]
        while open_:
            bound, at = heapq.heappop(open_)
            kth = best[0][0] if len(best) == k else None
            limit = max((b for b in (kth, floor) if b is not None), default=None)
            if limit is not None and -bound < limit:
                break                # a box equal to the k-th score may still hold a smaller id
            start, stop, left, right = nodes[at]
            if left >= 0:
                heapq.heappush(open_, (-up[left], left))
                heapq.heappush(open_, (-up[right], right))
                continue
            scores = product(v[start:stop], q, small)
            for j in np.flatnonzero(scores >= limit) if limit is not None else range(stop - start):
                c = order[start + j]
                for i in ids[starts[c]:starts[c + 1]]:
                    if i != x["vec_id"]:
                        one = (int(scores[j]), -int(i))
                        if len(best) < k:
                            heapq.heappush(best, one)
                        elif one > best[0]:
                            heapq.heapreplace(best, one)
        out += [(x["vec_id"], -i, max(LOWEST, min(LONG_MAX, s))) for s, i in best]
    return out


def top_by_product(table: DataFrame, every: int = 50, k: int = 5, scale: int = 256,
                   shard_vectors: int = SHARD_VECTORS, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every``
    the ``k`` rows with another id of the highest inner product, where each
    component x counts as floor(``scale`` * x).

    Rows without id, without a vector, or with a null or non-finite component
    take no part; only vectors of one length are compared.  Exact repeats of a
    row count once; of several different vectors under one id each counts.
    Fewer candidates than ``k`` are all returned; an empty table gives no rows.
    """
    rows = vectors.usable(table, lambda x: F.floor(F.lit(float(scale)) * x).cast("double"), id_col, vector_col)
    rows = materialize(rows, "tree-vectors")
    found = materialize(vectors.classes(rows, k), "tree-classes")
    dealt = vectors.shards(found, shard_vectors)
    index = vectors.build(dealt, build_tree, ["order", "node"], "tree-index")
    shape = index.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))   # a few numbers per length
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("v"))
    home = F.element_at("shards", (F.pmod(F.xxhash64("vec_id"), F.size("shards")) + 1).cast("int"))
    queries = materialize(queries.join(shape, "dim").withColumn("home", home).drop("shards"), "tree-queries")
    kinds, visit = {"order": np.int32, "node": np.int32}, partial(visit_tree, k=k)

    first = vectors.query_blocks(queries.withColumn("bound", F.lit(None).cast("long")), ["dim", "home"])
    near = vectors.search(index.join(first.withColumnRenamed("home", "shard"), ["dim", "shard"]), kinds, visit,
                          "long", "tree-home")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    kth = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    bounded = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    rest = vectors.query_blocks(bounded, ["dim"])
    others = index.join(rest, "dim").withColumn("queries", F.filter("queries", lambda x: x["home"] != F.col("shard"))) \
                  .where(F.size("queries") > 0)
    far = vectors.search(others, kinds, visit, "long", "tree-others")
    both = near.union(far).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return vectors.nearest(both, k)
