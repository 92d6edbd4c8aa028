"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces go, longest first, into the open bin that they fill best.  If none has
room, a bin opens.  Each permitted capacity is then filled on trial with the
pieces still to come, longest first, and shrunk to what it got; the one with
the least cost per token it holds opens.  Where hardly any piece fits the rest
of a large bin, a smaller one wins.  At the end each bin shrinks to the
smallest capacity that holds its contents.

A trial does not see what older bins will still take.  So a shard is also
packed with each capacity as the least one opened, and the cheapest packing
stays: several lengths together never cost more than the best one alone.

Pieces are dealt evenly into shards of bounded size, which are packed side by
side; each shard leaves at most a few bins unfilled.
"""

from __future__ import annotations

import gc
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.bpe import default_path
from eventide.llm.bpe_lexicon import STEP_BYTES, encoder, steps
from eventide.llm.common import map_batches, materialize

CAPACITIES = (512, 1024, 2048, 4096, 8192)
BIN_OVERHEAD = 64          # cost of a sequence besides its capacity, in tokens
SHARD_PIECES = 20_000


def trial_fill(falling: list[int], after: int, gap: int) -> int:
    """Tokens that a gap takes of the pieces from ``after`` on, longest first.
    ``falling`` holds the negated lengths, longest piece first."""
    left, at = gap, after
    while left:
        at = bisect_left(falling, -left, at)           # the first piece that fits
        if at == len(falling):
            break
        left += falling[at]
        at += 1
    return gap - left


def least_cost_capacity(falling: list[int], at: int, capacities: tuple[int, ...], overhead: int) -> int:
    """The capacity for a new bin that begins with piece ``at``: the least cost
    for each token that a trial fill gets into it, the larger one on ties."""
    def cost(capacity: int) -> float:
        held = -falling[at] + trial_fill(falling, at + 1, capacity + falling[at])
        return (capacities[bisect_left(capacities, held)] + overhead) / held

    return min((c for c in capacities if c >= -falling[at]), key=lambda c: (cost(c), -c))


def _packed(falling: list[int], capacities: tuple[int, ...], opens) -> tuple[list[int], list[int], list[int]]:
    """Best fit of the pieces in their order: bin and offset of each, and the
    tokens of each bin; ``opens`` gives the capacity of a new bin for a piece."""
    where, offset, used = [0] * len(falling), [0] * len(falling), []
    room: list[tuple[int, int]] = []           # open bins by free tokens, then by age
    for i, negated in enumerate(falling):
        n = -negated
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            b = len(used)
            used.append(0)
            free = opens(i)
        where[i], offset[i] = b, used[b]
        used[b] += n
        if free > n:
            insort(room, (free - n, b))
    return where, offset, used


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES,
         overhead: int = BIN_OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset) of each piece, in the given order, and each bin's final
    capacity.  No piece may exceed the largest capacity."""
    capacities = tuple(sorted(set(capacities)))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    falling = [-lengths[i] for i in order]

    def shrunk(used: list[int]) -> list[int]:
        return [capacities[bisect_left(capacities, u)] for u in used]

    rules = [lambda i: least_cost_capacity(falling, i, capacities, overhead)]
    rules += [lambda i, least=c: capacities[bisect_left(capacities, max(least, -falling[i]))] for c in capacities]
    best = min((_packed(falling, capacities, rule) for rule in rules),
               key=lambda p: sum(shrunk(p[2])) + overhead * len(p[2]))
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i, b, o in zip(order, best[0], best[1]):
        where[i], offset[i] = b, o
    return where, offset, shrunk(best[2])


def with_token_lengths(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id and n: the tokens of each whole text in the vocabulary file
    ``path``, and one end mark; a null text holds only the end mark."""
    path = path or default_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        gc.disable()          # many small objects and no cycles
        n = np.concatenate([encoder(path).count(texts) for texts in steps(batch.column(1))])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + 1, pa.int64())], names=["doc_id", "n"])

    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long", STEP_BYTES)


def word_tokens(text_col: str = "text"):
    """A ``length`` for callers without a vocabulary: the words of a text
    between ASCII white space, and one end mark."""
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + F.lit(1)


def best_fit(docs: DataFrame, length=None, capacities: tuple[int, ...] = CAPACITIES, overhead: int = BIN_OVERHEAD,
             shard_pieces: int = SHARD_PIECES, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence.

    ``length`` is the token count of a row (default: ``with_token_lengths`` of
    the vocabulary file ``path``, and of ``text``).  A
    document longer than the largest capacity is cut into full sequences and
    a rest; nothing is truncated.  Result: doc_id, piece (from 0), first_token
    and n_tokens of the piece, bin_id, capacity (after downsizing), bin_tokens,
    and offset in the bin.  Null and empty texts hold only the end mark.  Each
    row, repeated or without id, is packed by itself; a length of null or less
    than 1 packs nothing.  An empty table gives no rows.
    """
    capacities = tuple(sorted(set(capacities)))
    longest = capacities[-1]
    sized = (with_token_lengths(docs, path, id_col) if length is None
             else docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("n")).where("n > 0"))
    sized = materialize(sized, "packing-lengths")
    pieces = (sized.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / longest).cast("int"))))
                   .withColumn("first_token", F.col("piece").cast("long") * longest)
                   .withColumn("n_tokens", F.least(F.col("n") - F.col("first_token"), F.lit(longest)))
                   .drop("n"))
    total = sized.agg(F.coalesce(F.sum(F.ceil(F.col("n") / longest)), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_pieces))
    # Written rows have a fixed order, so their running numbers are repeatable, and no value decides the shard.
    dealt = (pieces.withColumn("row", F.monotonically_increasing_id())
                   .withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")))
    id_type = sized.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece int, first_token long, n_tokens long, bin_id string, capacity int, "
              "bin_tokens long, offset long")

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", kind="stable")
        lengths = group["n_tokens"].tolist()
        where, offset, final = pack(lengths, capacities, overhead)
        held = [0] * len(final)
        for b, n in zip(where, lengths):
            held[b] += n
        return pd.DataFrame({
            "doc_id": group["doc_id"], "piece": group["piece"], "first_token": group["first_token"],
            "n_tokens": group["n_tokens"], "bin_id": [f"{key[0]}-{b}" for b in where],
            "capacity": [final[b] for b in where], "bin_tokens": [held[b] for b in where], "offset": offset})

    return dealt.groupBy("shard").applyInPandas(run, schema)
