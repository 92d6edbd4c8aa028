"""Approximate nearest neighbours by cosine, over robust-pruned graphs.

Each shard holds a directed graph on its unit vectors.  Greedy searches from
the most central vector propose a vector's neighbours; pruning keeps the
nearest and drops those much nearer to a kept one than to the vector itself
(``ALPHA`` relaxes this), so edges stay diverse.  Queries walk each shard's
graph with a beam, and the best of all shards are scored on the original
vectors in double precision.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import vectors
from eventide.llm.common import materialize

SHARD_VECTORS = 4096
DEGREE = 32
SLACK = 48            # a vector may gather so many edges before it is pruned again
BUILD_BEAM = 64
QUERY_BEAM = 128
ALPHA = 1.2
WIDTH = 4             # vectors that a beam expands at a time
BUILD_BATCH = 256


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest points of each query that a beam finds, with their squared
    distances; -1 and inf where it found fewer.  All queries step together."""
    m, rows = len(queries), np.arange(len(queries))[:, None]
    best = np.full((m, beam), -1, np.int64)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.zeros((m, beam), bool)
    seen = np.zeros((m, len(points) + 1), bool)      # the last column stands for "none"
    best[:, 0], dist[:, 0] = entry, ((queries - points[entry]) ** 2).sum(axis=1)
    seen[:, entry] = seen[:, -1] = True
    while True:
        waiting = np.where(done | (best < 0), np.inf, dist)
        pick = np.argsort(waiting, axis=1, kind="stable")[:, :WIDTH]
        open_ = np.isfinite(np.take_along_axis(waiting, pick, 1))
        if not open_.any():
            return best, dist
        np.put_along_axis(done, pick, np.take_along_axis(done, pick, 1) | open_, 1)
        at = np.where(open_, np.take_along_axis(best, pick, 1), -1)
        near = np.where(at[:, :, None] >= 0, edges[at], -1).reshape(m, -1)
        near[seen[rows, near]] = -1
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[rows, near] = True
        d = 2.0 - 2.0 * np.einsum("ijk,ik->ij", points[near], queries, optimize=False)
        d[near < 0] = np.inf
        all_d, all_i = np.concatenate([dist, d], 1), np.concatenate([best, near], 1)
        all_done = np.concatenate([done, np.zeros_like(near, bool)], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        best, dist, done = (np.take_along_axis(x, order, 1) for x in (all_i, all_d, all_done))


def robust_prune(points: np.ndarray, own: np.ndarray, near: np.ndarray, alpha: float) -> np.ndarray:
    """At most ``DEGREE`` diverse neighbours of each of ``own`` out of its
    candidates ``near`` (-1: none)."""
    near = np.where(near == own[:, None], -1, near)
    d = 2.0 - 2.0 * np.einsum("ijk,ik->ij", points[near], points[own], optimize=False)
    d[near < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
    close = points[near]
    between = 2.0 - 2.0 * np.matmul(close, close.transpose(0, 2, 1))
    alive, rows = near >= 0, np.arange(len(own))
    out = np.full((len(own), DEGREE), -1, np.int64)
    for k in range(DEGREE):
        pick = alive.argmax(axis=1)
        has = alive[rows, pick]
        if not has.any():
            break
        out[has, k] = near[rows, pick][has]
        # Squared distances: alpha counts twice.
        alive &= ~(has[:, None] & (alpha * alpha * between[rows, pick] <= d))
        alive[rows, pick] = False
    return out


def build_graph(v: np.ndarray) -> list[np.ndarray]:
    """[edges, entry]: the graph of one shard, as int32."""
    points = unit(v).astype(np.float32)
    n = len(points)
    rng = np.random.default_rng(n)
    edges = np.full((n, SLACK), -1, np.int64)
    if n > 1:
        edges[:, :DEGREE] = (np.arange(n)[:, None] + 1 + rng.integers(0, n - 1, (n, DEGREE))) % n
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for i in range(0, n, BUILD_BATCH):
            own = order[i:i + BUILD_BATCH]
            found, _ = beam_search(points, edges, entry, points[own], BUILD_BEAM)
            kept = robust_prune(points, own, np.concatenate([found, edges[own]], 1), alpha)
            edges[own] = -1
            edges[own, :DEGREE] = kept
            _add_back(points, edges, own, kept, alpha)
    return [edges.astype(np.int32), np.array([entry], np.int32)]


def _add_back(points: np.ndarray, edges: np.ndarray, own: np.ndarray, kept: np.ndarray, alpha: float) -> None:
    """Add the edges to ``own`` at the neighbours' side; prune where they overflow."""
    target, source = kept.ravel(), np.repeat(own, kept.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    fresh = ~(edges[target] == source[:, None]).any(axis=1)
    order = np.argsort(target[fresh], kind="stable")
    target, source = target[fresh][order], source[fresh][order]
    if not len(target):
        return
    names, first, counts = np.unique(target, return_index=True, return_counts=True)
    degree = (edges[names] >= 0).sum(axis=1)
    fits = degree + counts <= SLACK
    slot = np.arange(len(target)) - np.repeat(first, counts) + np.repeat(degree, counts)
    simple = np.repeat(fits, counts)
    edges[target[simple], slot[simple]] = source[simple]
    full = np.flatnonzero(~fits)
    full = full[np.argsort(counts[full], kind="stable")]
    for i in range(0, len(full), 64):
        part = full[i:i + 64]
        near = np.full((len(part), SLACK + counts[part].max()), -1, np.int64)
        near[:, :SLACK] = edges[names[part]]
        for r, t in enumerate(part):
            near[r, SLACK:SLACK + counts[t]] = source[first[t]:first[t] + counts[t]]
        edges[names[part]] = -1
        edges[names[part], :DEGREE] = robust_prune(points, names[part], near, alpha)


def visit_graph(v, starts, ids, arrays, queries, k: int, beam: int) -> list[tuple[int, int, float]]:
    """(query, id, cosine) of the best that the beam finds in one shard."""
    edges = arrays["edges"].reshape(len(v), SLACK).astype(np.int64)
    exact = unit(v)
    q = unit(np.array([x["v"] for x in queries], np.float64))
    found, _ = beam_search(exact.astype(np.float32), edges, int(arrays["entry"][0]), q.astype(np.float32),
                           max(beam, k + 1))
    out = []
    for x, own, near in zip(queries, q, found):
        near = near[near >= 0]
        score = exact[near] @ own
        for j in np.argsort(-score, kind="stable")[:2 * k + 2]:
            c = near[j]
            out += [(x["vec_id"], int(i), float(score[j])) for i in ids[starts[c]:starts[c + 1]] if i != x["vec_id"]]
    return out


def nearest_by_cosine(table: DataFrame, every: int = 50, k: int = 5, shard_vectors: int = SHARD_VECTORS,
                      beam: int = QUERY_BEAM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every``
    the ``k`` nearest rows with another id that the graphs give, by cosine.

    Rows without id, without a vector, or with a zero vector or a null or
    non-finite component take no part; only vectors of one length are
    compared.  Exact repeats of a row count once.  Fewer candidates than ``k``
    are all returned; an empty table gives no rows.
    """
    rows = vectors.usable(table, lambda x: x, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    rows = materialize(rows, "graph-vectors")
    found = materialize(vectors.classes(rows, k), "graph-classes")
    index = vectors.build(vectors.shards(found, shard_vectors), build_graph, ["edges", "entry"], "graph-index")
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("v"))
    tasks = index.join(vectors.query_blocks(queries, ["dim"]), "dim")
    hits = vectors.search(tasks, {"edges": np.int32, "entry": np.int32}, partial(visit_graph, k=k, beam=beam),
                          "double", "graph-hits")
    return vectors.nearest(hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)
