"""SimHash near-duplicates through a byte-position inverted index.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of
their 8 bytes, so they share at least 4 bytes at the same positions: the
guaranteed minimum.  The index lists fingerprints under (positions, bytes)
for groups of positions chosen so that any 4 shared positions contain one
group; pairs that meet in a list are tallied over all 8 positions, kept from
the minimum on, and verified by their distance.

Long lists are cut into blocks, and each pair of blocks is one bounded row.
A list gives back a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import map_batches, materialize
from eventide.llm.components import connected_components

BYTES = 8
BLOCK = 512             # fingerprints of a posting list that meet in one row: at most twice as many
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, k: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 sums of all ``k``-word shingles, repeats included."""
    words = text.encode().lower().split()      # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    line = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [*(s - 1 for s in starts[k:]), len(line)] if len(words) >= k else [len(line)]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for i in range(0, n, SHINGLES_AT_ONCE):
        sums = b"".join([digest(line[s:e], seed) for s, e in zip(starts[i:i + SHINGLES_AT_ONCE],
                                                               ends[i:i + SHINGLES_AT_ONCE])])
        bits = np.unpackbits(np.frombuffer(sums, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 4, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long; a
    null text has no words, like an empty one."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, k, seed) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def position_groups(shared: int) -> list[tuple[int, ...]]:
    """Groups of ``shared - 1`` byte positions such that any ``shared``
    positions contain one of them (a single group of none if ``shared`` < 2
    would list everything together, so at least 1 position is used).

    Positions are dealt over three circles; groups of three inside a circle,
    or two in one and one in the next, meet every four positions: 20 groups.
    Other sizes take all combinations."""
    if shared == 4:
        circle = [0, 0, 0, 1, 1, 1, 2, 2]
        keep = []
        for g in combinations(range(BYTES), 3):
            c = sorted(circle[p] for p in g)
            times = [c.count(x) for x in range(3)]
            if 3 in times or any(times[x] == 2 and times[(x + 1) % 3] == 1 for x in range(3)):
                keep.append(g)
        return keep
    return list(combinations(range(BYTES), max(1, shared - 1)))


def _forest(fp: np.ndarray, max_bits: int, shared: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the links among the fingerprints of one list row."""
    n = len(fp)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    for i in range(n - 1):
        differ = fp[i + 1:] ^ fp[i]
        tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        near = np.flatnonzero(tally >= shared)
        near = near[np.bitwise_count(differ[near]) <= max_bits]
        for j in near.tolist():
            a, b = root(i), root(i + 1 + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + 1 + j)
    return left, right


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` of ``nodes``
    that connect all that differ in at most ``max_bits`` bits."""
    shared = BYTES - max_bits
    if not 1 <= shared <= BYTES:
        raise ValueError("the byte index needs 0 to 7 differing bits")

    def key(n: int, group: tuple[int, ...]):
        picked = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in group]
        value = picked[0]
        for p in picked[1:]:
            value = F.shiftleft(value, 8).bitwiseOR(p)
        return F.struct(F.lit(n).alias("g"), value.alias("v"))

    groups = position_groups(shared)
    listed = nodes.select("fp", F.explode(F.array(*(key(n, g) for n, g in enumerate(groups)))).alias("k"))
    sizes = (listed.groupBy("k.g", "k.v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")))
    sizes = materialize(sizes, "simhash-lists")
    posted = (listed.select("fp", "k.g", "k.v").join(sizes, ["g", "v"])
                    .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
                    .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    rows = (posted.groupBy("g", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
                  .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = batch.column(0)
        values, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
        a, b = [], []
        for s, e in zip(at[:-1], at[1:]):
            fp = values[s:e].view(np.uint64)
            left, right = _forest(fp, max_bits, shared)
            a.append(values[s:e][left])
            b.append(values[s:e][right])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return map_batches(rows, run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 4, max_bits: int = 4, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint and its component, the smallest
    document id reachable over links of at most ``max_bits`` differing bits.

    Null and wordless texts have fingerprint zero and link like any other.
    Repeated rows give one row each.  A document without id belongs to the
    component of its fingerprint; the component is null only if no document
    of it has an id.  Extra columns are not looked at.
    """
    prints = materialize(fingerprints(docs, k, seed, id_col, text_col), "simhash-prints")
    return prints.join(_named(prints, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of rows (doc_id,
    fp), written: the root is a fingerprint, one for each component."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    parts = materialize(connected_components(links(nodes, max_bits)), "simhash-components")
    of_node = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left") \
                   .withColumn("root", F.coalesce("root", "fp"))
    least = of_node.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return materialize(of_node.join(least, "root").select("fp", "root", "component_id"), "simhash-named")


def keep_one(docs: DataFrame, k: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with
    its smallest id, of several such the one with the least text (null counts
    as empty).  Components are told apart by their fingerprints, so an id that
    occurs with different texts stands for each of them.  Documents without id
    cannot be named as members and stay."""
    number = next(c for c in ("_row", *(f"_row{i}" for i in range(len(docs.columns)))) if c not in docs.columns)
    # The row numbers are written with the rows, so they stay what they are.
    stored = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "simhash-rows")
    both = stored.select(F.struct("doc_id", F.col(number).alias("row")).alias("doc_id"), "text")
    prints = materialize(fingerprints(both, k).select("doc_id.doc_id", "doc_id.row", "fp"), "simhash-prints")
    named = _named(prints, max_bits)
    # Kept rows grow with the corpus, so they are always merged, never broadcast.
    least = (prints.join(named.hint("merge"), "fp").where("doc_id = component_id")
                   .groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row")))
    least = materialize(least, "simhash-kept")
    kept = least.select(F.col("row").alias(number))
    repeated = least.where("n > 1").select("root")
    if repeated.take(1):
        rows = (prints.join(named.hint("merge"), "fp").where("doc_id = component_id")
                      .join(repeated.hint("merge"), "root").select("root", F.col("row").alias(number)))
        texts = stored.select(number, F.coalesce("text", F.lit("")).alias("text"))
        chosen = (texts.join(rows.hint("merge"), number).groupBy("root")
                       .agg(F.min_by(number, F.struct("text", number)).alias(number)).select(number))
        kept = least.where("n = 1").select(F.col("row").alias(number)).unionByName(chosen)
    single = stored.join(kept.hint("merge"), number, "left_semi")
    return single.unionByName(stored.where("doc_id is null")).select(*docs.columns)
