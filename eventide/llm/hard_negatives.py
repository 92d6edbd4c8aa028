"""Hard-negative mining by inner product, over STR-packed R-trees.

Each shard holds vectors of one label in an R-tree packed by sort-tile-recursive:
the vectors are sorted on the widest component and cut into slabs, each slab on
the next widest, until a tile fills a leaf; runs of neighbouring tiles make the
nodes above.  A node's minimum bounding box gives per component the interval of
its product with the anchor's, and their sums the interval of the scores below
it.  A best-first queue takes nodes by the upper end of it; boxes that end below
the score window or begin above it are pruned, and those strictly below the k-th
best score of the shard (an equal box may hold a smaller id).

Anchors search the shards of their own label for positives, and the other shards
for the negatives of each positive's window.  Blocks of searches are dealt to
the shards they need, so the join of the two is by shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize
from eventide.operators.joins import broadcast_if_small

SHARD_VECTORS = 4096
LEAF = 128
FANOUT = 8
QUERY_BLOCK = 1024
EXACT = 1 << 53
LONG = (1 << 63) - 1
NO_WINDOW = {"positive_id": None, "positive_score": None}


# --- the tree -----------------------------------------------------------------

def str_order(v: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[int]]:
    """Sort-tile-recursive: an order of the rows of ``v``, and where its tiles begin."""
    axes = np.argsort(v.min(axis=0) - v.max(axis=0), kind="stable")
    order, starts = [], []

    def tile(rows: np.ndarray, depth: int, tiles_left: int) -> None:
        if len(rows) <= leaf or depth == len(axes):
            for s in range(0, len(rows), leaf):
                starts.append(sum(map(len, order)))
                order.append(rows[s:s + leaf])
            return
        # As many slabs on each of the axes still of use, so that their product is the number of tiles.
        axes_left = max(1, min(len(axes) - depth, int(np.ceil(np.log2(max(2, tiles_left))))))
        slabs = int(np.ceil(round(tiles_left ** (1 / axes_left), 9)))
        rows = rows[np.argsort(v[rows, axes[depth]], kind="stable")]
        width = -(-len(rows) // slabs)
        for s in range(0, len(rows), width):
            tile(rows[s:s + width], depth + 1, -(-tiles_left // slabs))

    tile(np.arange(len(v)), 0, -(-len(v) // leaf))
    return np.concatenate(order), starts


def pack(v: np.ndarray, starts: list[int], fanout: int = FANOUT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, low, high) over rows in tile order, leaves first and the root
    last: a leaf's node is (first row, end row, 1), any other (first node, end node, 0)."""
    ends = [*starts[1:], len(v)]
    nodes = [(s, e, 1) for s, e in zip(starts, ends)]
    low, high = [v[s:e].min(axis=0) for s, e in zip(starts, ends)], [v[s:e].max(axis=0) for s, e in zip(starts, ends)]
    level = (0, len(nodes))
    while level[1] - level[0] > 1:
        for s in range(*level, fanout):
            e = min(s + fanout, level[1])
            nodes.append((s, e, 0))
            low.append(np.min(low[s:e], axis=0))
            high.append(np.max(high[s:e], axis=0))
        level = (level[1], len(nodes))
    return np.array(nodes, np.int64), np.array(low), np.array(high)


class Tree:
    """An R-tree of a shard with the ids of each distinct vector."""

    def __init__(self, v: np.ndarray, ids: list[list[int]]):
        order, starts = str_order(v)
        self.v, self.ids = v[order], [ids[i] for i in order]
        self.nodes, self.low, self.high = pack(self.v, starts)
        self.largest = float(np.abs(v).max(initial=0.0))

    def intervals(self, q: np.ndarray):
        """(lower, upper) end of the scores below each node: sums of the per-component intervals.
        Rounded outwards where products are no whole doubles."""
        more, less = np.maximum(q, 0), np.minimum(q, 0)
        upper, lower = self.high @ more + self.low @ less, self.low @ more + self.high @ less
        if not self.exact(q):
            slack = 1e-9 * (np.maximum(np.abs(self.low), np.abs(self.high)) @ np.abs(q)) + 1
            upper, lower = upper + slack, lower - slack
        return lower, upper

    def exact(self, q: np.ndarray) -> bool:
        return self.largest * float(np.abs(q).max()) * len(q) < EXACT

    def scores(self, start: int, end: int, q: np.ndarray):
        if self.exact(q):
            return (self.v[start:end] @ q).astype(np.int64)
        return np.array([sum(int(x) * int(y) for x, y in zip(row, q)) for row in self.v[start:end]], object)

    def best(self, q: np.ndarray, own: int, k: int, windows: list) -> list[list[tuple[int, int]]]:
        """For each of ``windows``, (least, most) with None for no bound, the k
        best (score, id) within it but for the id ``own``, by one traversal."""
        lower, upper = self.intervals(q)
        found: list[list] = [[] for _ in windows]          # min-heaps of (score, -id)
        need = [-np.inf if least is None else least for least, _ in windows]     # below it nothing is of use
        most = [np.inf if top is None else top for _, top in windows]
        floor, ceiling = min(need), max(most)
        queue = [(-upper[-1], len(upper) - 1)]
        while queue:
            top, at = heapq.heappop(queue)
            if -top < floor:
                break                            # the queue's best upper end: no open box can hold more
            if lower[at] > ceiling or not any(n <= -top and lower[at] <= m for n, m in zip(need, most)):
                continue
            start, end, leaf = self.nodes[at]
            if not leaf:
                for child in range(start, end):
                    if upper[child] >= floor:
                        heapq.heappush(queue, (-upper[child], child))
                continue
            scores = self.scores(start, end, q)
            hits = np.flatnonzero((scores >= floor) & (scores <= ceiling))
            if not len(hits):
                continue
            scores = scores[hits]
            for heap, w in zip(found, range(len(windows))):
                ok = (scores >= need[w]) & (scores <= most[w])
                if ok.sum() > k + 1:                       # with ``own`` k + 1 rows may be wanted, and their ties
                    ok &= scores >= np.sort(scores[ok])[-k - 1]
                for i in np.flatnonzero(ok):
                    for one in self.ids[start + hits[i]]:
                        if one != own:
                            if len(heap) < k:
                                heapq.heappush(heap, (int(scores[i]), -one))
                            elif (scores[i], -one) > heap[0]:
                                heapq.heapreplace(heap, (int(scores[i]), -one))
                if len(heap) == k:
                    need[w] = max(need[w], heap[0][0])
            floor = min(need)
        return [[(s, -i) for s, i in heap] for heap in found]


# --- shards and searches ----------------------------------------------------------

def labelled(table: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, exact repeats once."""
    rows = table.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite)
                .withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("double"))).distinct())


def shards(rows: DataFrame, k: int, size: int) -> DataFrame:
    """(dim, label, shard, vectors): a written row per shard of about ``size``
    distinct vectors of one label, each with its k + 1 smallest ids.  Ties go
    to smaller ids and a search leaves out one id, so no answer needs more."""
    rank = F.row_number().over(Window.partitionBy("label", "v").orderBy("vec_id"))
    classes = (rows.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("label", "v")
                   .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v")))
    classes = materialize(classes, "negative-classes")
    sizes = classes.groupBy("dim", "label").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("n"))
    dealt = classes.join(sizes, ["dim", "label"]).withColumn("shard", F.pmod(F.xxhash64("v"), F.col("n")))
    return materialize(dealt.groupBy("dim", "label", "shard").agg(
        F.sort_array(F.collect_list(F.struct(F.element_at("ids", 1).alias("first"), "v", "ids"))).alias("vectors"))
        .withColumn("key", F.xxhash64("dim", "label", "shard")), "negative-shards")


def dealt_blocks(searches: DataFrame, index: DataFrame, same_label: bool, block: int) -> DataFrame:
    """(key, block, queries): the searches (vec_id, label, dim, v, ...) of each
    block beside every shard that they need; no join has fewer keys than shards."""
    each = F.struct("vec_id", "v", "wanted")
    n = max(1, -(-searches.count() // block))
    grouped = (searches.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n))).groupBy("dim", "label", "block")
                       .agg(F.sort_array(F.collect_list(each)).alias("queries")))
    grouped = materialize(grouped, "negative-blocks")
    there = index.select("dim", F.col("label").alias("other"), "key")
    there = there.groupBy("dim").agg(F.collect_list(F.struct("other", "key")).alias("there"))    # two numbers a shard
    match = (lambda s: s["other"] == F.col("label")) if same_label else (lambda s: s["other"] != F.col("label"))
    return grouped.join(broadcast_if_small(there), "dim").select(F.explode(F.filter("there", match)["key"]).alias("key"), "queries")


def visit(blocks: DataFrame, index: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """(anchor_id, positive_id, positive_score, vec_id, score) of what each
    search finds in each shard.  A search lists in ``wanted`` the positives
    (id, score) whose windows it asks for; none for the best scores of all."""
    conf = index.sparkSession.conf
    width = max(1, int(conf.get("spark.sql.shuffle.partitions")))        # small rows, long searches: not to be merged
    rows = (blocks.repartition(width, "key").join(index.select("key", "vectors").repartition(width, "key"), "key")
                  .select("key", "vectors", "queries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if tree is None or batch.column(0)[i].as_py() != key:
                    key, part = batch.column(0)[i].as_py(), batch.column(1)[i].values
                    _, v, ids = part.flatten()
                    tree = Tree(v.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1), ids.to_pylist())
                out: list[tuple] = []
                for x in batch.column(2)[i].as_py():
                    asked = [p for p in x["wanted"] or [NO_WINDOW] if p["positive_score"] is None or p["positive_score"] >= 0]
                    windows = [(None, None) if p["positive_score"] is None else
                               (-(-percent * p["positive_score"] // 100), p["positive_score"]) for p in asked]
                    if windows:
                        found = tree.best(np.array(x["v"], np.float64), x["vec_id"], k, windows)
                        out += [(x["vec_id"], *p.values(), j, s) for p, some in zip(asked, found) for s, j in some]
                columns = list(zip(*out)) or [()] * 5
                clip = lambda c: [None if s is None else max(-LONG - 1, min(LONG, s)) for s in c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(clip(c), pa.int64()) for c in columns],
                    names=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    usual = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")     # one row is a whole shard
    try:
        return materialize(rows.mapInArrow(
            run, "anchor_id long, positive_id long, positive_score long, vec_id long, score long"), name)
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each search, larger scores first, ties to smaller ids; an id with several vectors counts by its best."""
    one = found.groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(table: DataFrame, every: int = 100, k: int = 5, percent: int = 80, scale: int = 256,
         shard_vectors: int = SHARD_VECTORS, block: int = QUERY_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each row whose vec_id is divisible by ``every`` and each of its ``k``
    best other rows of its label (its positives), the ``k`` best rows of other
    labels whose score is within ``percent`` per cent of the positive's and not
    above it.  Scores are integer inner products of floor(``scale`` * x).

    Fewer candidates than ``k`` are all returned; a positive of negative score
    has an empty window.  Ties go to smaller ids.  Rows without id, label or
    vector, or with a null or non-finite component take no part; only vectors of
    one length are compared.  Exact repeats of a row count once; of different
    rows under one id each searches and is searched, and an id counts by its best score.
    Other columns are not read.  An empty table gives no rows.
    """
    rows = materialize(labelled(table, scale), "negative-rows")
    index = shards(rows, k, shard_vectors)
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("v"))
    window = "array<struct<positive_id: long, positive_score: long>>"
    searches = anchors.withColumn("wanted", F.lit(None).cast(window))
    near = visit(dealt_blocks(searches, index, True, block), index, k, percent, "positives")
    positives = first(near.select("anchor_id", "vec_id", "score"), ["anchor_id"], k)
    asked = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("wanted"))
    searches = anchors.join(asked.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    far = visit(dealt_blocks(searches, index, False, block), index, k, percent, "negatives")
    return (first(far, ["anchor_id", "positive_id", "positive_score"], k)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


# The same by brute force.
HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT DISTINCT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON len(a.e) = len(c.e) AND a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, max(score) AS positive_score FROM s WHERE same GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY positive_score DESC, positive_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, max(s.score) AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
  GROUP BY ALL)
SELECT anchor_id, positive_id, CAST(row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
  negative_id, positive_score, negative_score
FROM n QUALIFY rank <= 5
"""
