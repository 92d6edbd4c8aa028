"""Language-model scores by online logistic context mixing.

Text is coded bit by bit: each byte takes a path in a prefix tree over bytes
(frequent bytes have short ones), and an end symbol closes the text.  For
every bit, one predictor per context order looks up its context: the last
bytes of the current word and the place in the tree.  What follows each
context is counted exactly over all training documents, in a table that grows
with them.  The most frequent contexts are broadcast, as many as fit a fixed
table; all others are joined to the texts that have them, so that where a
context is kept never changes a score.  The predictions are mixed in the
logistic domain by weights that the longest known context gates; an adaptive
table then refines the mixed probability.  Weights and refinement start alike
for each document and learn from what it has shown so far, so the score is a
probability of the whole text and depends on nothing but it and the tables.

The base score is a smoothed unigram model of whole words.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import BATCH_ROWS, batch_rows, discard, in_fold, map_batches, materialize, shuffles_removed

ORDERS = (1, 2, 3, 5)
TABLE_BITS = 20               # slots an order of the table that is broadcast; contexts beyond it are joined
LOAD = 0.6                    # part of its slots that is filled at most
EMPTY = np.uint64(2 ** 64 - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 2_000_000        # bits of grams whose predictions a worker remembers
FREQUENT_WORDS = 100_000      # words whose counts are broadcast; all others are joined
TOGETHER = 1 << 20            # bytes of text whose grams are sorted together
FLUSH_GRAMS, FLUSH_WORDS = 2_000_000, 300_000
FOLDS, HELD_OUT = 7, 2
END = 255                     # a byte that UTF-8 never uses closes each text
MARK = bytes([END])
SPACE = 32
UNSEEN = -32768
UNIT = 1024.0                 # of a stored stretched probability
STEP = 1024                   # bits after which weights and refinement learn, at most:
FIRST_STEPS = (0, 16, 32, 64, 128, 256, 512)   # a text begins with shorter steps, so that short ones learn too
SEGMENT = 1 << 18             # bytes of one text that are laid out at once, and
GROUP = 3 << 18               # of texts that step together, about
BLOCK = 2 << 20               # bytes of text that ask for their contexts together, about
# A block is one row: few of them are held before they are written, or read at once.
FEW_ROWS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 4, "parquet.page.size.row.check.min": 1}
GROUPED = 10_000              # contexts of a block that are sent to its task at a time
GATE_OF = (0, 1, 1, 2)        # by the longest known order; weights are kept for each gate
GATES = 3
ONE, NONE = 4, 8             # beside the gate of a bit: it is a one; there is no bit
RATE, DAMP = 2.0, 48.0
REFINE_COUNT, BUCKETS = 160.0, 32


@dataclass
class Code:
    """Paths of the 256 symbols in the prefix tree, flat."""

    starts: np.ndarray
    lengths: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray


def prefix_code(counts: list[int]) -> Code:
    """The least-cost prefix tree for the symbol counts (each taken as one more)."""
    heap = [(n + 1, s, (s,)) for s, n in enumerate(counts)]
    heapq.heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    node = len(counts)
    while len(heap) > 1:
        a, _, left = heapq.heappop(heap)
        b, _, right = heapq.heappop(heap)
        for bit, own in ((0, left), (1, right)):
            for s in own:
                paths[s].append((node, bit))
        heapq.heappush(heap, (a + b, node, left + right))
        node += 1
    lengths = np.array([len(p) for p in paths])
    flat = [x for p in paths for x in reversed(p)]
    return Code(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths,
                np.array([n - len(counts) for n, _ in flat], np.uint8), np.array([b for _, b in flat], np.int8))


def grams_of(raw: np.ndarray) -> np.ndarray:
    """The gram of each byte of closed texts that follow each other: the byte
    itself below the bytes before it in its unit, the nearest one lowest, zero
    where none is.  A unit ends with a space or an end mark."""
    grams = np.zeros((len(raw), 8), np.uint8)
    grams[:, 0] = raw
    inner = np.where((raw == SPACE) | (raw == END), 0, 255).astype(np.uint8)
    within = np.full(len(raw), 255, np.uint8)
    for back in range(1, max(ORDERS) + 1):
        within[:back] = 0
        within[back:] &= inner[:-back]
        grams[back:, back] = raw[:-back] & within[back:]
    return grams.view("<u8").ravel()


def closed(texts: list[bytes]) -> np.ndarray:
    """The bytes of all texts, each with its end mark."""
    return np.frombuffer(MARK.join([*texts, b""]), np.uint8)


def context_keys(grams: np.ndarray, k: int) -> np.ndarray:
    """The contexts of the grams for the ``k``-th order, exactly: 40 bits under the order."""
    return (grams >> np.uint64(8)) & np.uint64((1 << 8 * ORDERS[k]) - 1) | np.uint64(k << 8 * max(ORDERS))


def bits_along(symbols: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, bit, bits of each symbol) on the paths of the symbols."""
    lengths = code.lengths[symbols]
    through = np.cumsum(lengths)
    at = np.arange(through[-1] if len(symbols) else 0) + np.repeat(code.starts[symbols] - (through - lengths), lengths)
    return code.nodes[at], code.bits[at], lengths


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(c[order], first) if len(keys) else c for c in counts)


def predictions(contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(key, value) of each context and tree node, from rows (context, symbol
    that follows, count): the stretched probability of a one as multiples of
    1 / UNIT.  Keys are in order."""
    nodes, bits, lengths = bits_along(symbols, code)
    n = np.repeat(counts.astype(np.int64), lengths)
    keys = np.repeat(contexts.astype(np.uint64) << np.uint64(8), lengths) | nodes
    keys, n0, n1 = summed(keys, np.where(bits == 0, n, 0), np.where(bits == 1, n, 0))
    return keys, np.rint(UNIT * np.log((n1 + 0.2) / (n0 + 0.2))).astype(np.int16)


def counted_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts in order, and how often each is met."""
    grams = grams_of(closed(texts))
    grams.sort()
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(first, append=len(grams))


def cut(text: bytes) -> list[bytes]:
    """The units of a text, its end mark included: after each space a new one begins."""
    parts = text.split(b" ")
    last = parts.pop() + MARK
    units = [p + b" " for p in parts]
    units.append(last)
    return units


def byte_counts(docs: DataFrame, text_col: str) -> list[int]:
    """Counts of all bytes, ends included, over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
                total[END] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(total)], names=["s", "n"])

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(run, "s int, n long") \
               .groupBy("s").agg(F.sum("n").alias("n")).collect()
    of = {r["s"]: r["n"] for r in rows}
    return [of.get(s, 0) for s in range(256)]


def gather(train: DataFrame, text_col: str) -> DataFrame:
    """One pass over the training texts, written: rows (word, n) with word
    counts, and rows (gram, n) with counts of bytes after their contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        texts: list[bytes] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def learn() -> None:
            found.append(counted_grams(texts))
            texts.clear()
            if len(found) > 8:        # few lists are merged at a time
                merged = summed(*map(np.concatenate, zip(*found)))
                found[:] = [merged]

        def learnt() -> Iterator[pa.RecordBatch]:
            grams, n = summed(*map(np.concatenate, zip(*found)))
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                                             names=["word", "gram", "n"])

        def counted() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([
                pa.array([w.decode() for w in words], pa.string()), pa.nulls(len(words), pa.int64()),
                pa.array(list(words.values()), pa.int64())], names=["word", "gram", "n"])
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                texts.append(own := text.encode())
                words.update(own.lower().split())
                size += len(own) + 1
                if size > TOGETHER:
                    learn()
                    size = 0
                    if sum(len(n) for _, n in found) > FLUSH_GRAMS:
                        yield from learnt()
                if len(words) > FLUSH_WORDS:
                    yield from counted()
        if texts:
            learn()
        if found:
            yield from learnt()
        if words:
            yield from counted()

    texts = train.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return materialize(texts.mapInArrow(run, "word string, gram long, n long"), "lm-gathered")


def contexts_of(gathered: DataFrame, code: Code) -> DataFrame:
    """One row per context that a training text has, of all orders, written:
    its key, how often it was met as ``rank`` (eight steps each time it
    doubles), at most how many tree nodes it has, and what follows: symbols
    and their counts.  Counts are exact longs; the table grows with the texts."""
    grams = materialize(gathered.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")), "lm-grams")
    rows = None
    for k, order in enumerate(ORDERS):
        own = grams.select(F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
                            .bitwiseOR(F.lit(k << 8 * (max(ORDERS) + 1))).alias("gram"), "n")
        if order < max(ORDERS):
            own = own.groupBy("gram").agg(F.sum("n").alias("n"))
        rows = own if rows is None else rows.unionByName(own)
    symbol = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
    length = F.element_at(F.lit(code.lengths.tolist()), symbol + 1)
    out = (rows.groupBy(F.shiftright("gram", 8).alias("key"))
               .agg(F.floor(F.log2(F.sum("n")) * 8).cast("int").alias("rank"), F.sum(length).alias("nodes"),
                    F.collect_list(F.struct(symbol.alias("symbol"), "n")).alias("next")))
    contexts = materialize(out.withColumn("nodes", F.least("nodes", F.lit(255))), "lm-contexts")
    discard(grams)
    return contexts


def flat(keys: pa.Array, following: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (context, symbol, count) of contexts and their lists."""
    many = np.diff(following.offsets.to_numpy())
    items = following.flatten()
    return (np.repeat(keys.to_numpy(zero_copy_only=False).view(np.uint64), many),
            items.field("symbol").to_numpy(zero_copy_only=False), items.field("n").to_numpy(zero_copy_only=False))


def hashed(keys: np.ndarray, values: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(table, its exact keys): each entry lies in the first free slot from its own on."""
    spread = keys * SPREAD
    order = np.argsort(spread)
    own = (spread[order] >> np.uint64(65 - slots.bit_length())).astype(np.int64)
    at = np.maximum.accumulate(own - np.arange(len(own))) + np.arange(len(own))
    size = max(slots, int(at[-1]) + 1 if len(at) else 0) + 1
    table, held = np.full(size, UNSEEN, np.int16), np.full(size, EMPTY, np.uint64)
    table[at], held[at] = values[order], keys[order]
    return table, held


class Mixer:
    """Scores texts with the gathered counts; texts of a batch step together.

    ``table`` and ``keys`` hold the frequent contexts (``hashed``); without
    keys none is known.  ``others`` are the predictions of the other contexts
    of the texts that are scored next."""

    def __init__(self, code: Code, table: np.ndarray, top: dict[bytes, int], keys: np.ndarray | None = None):
        self.code, self.table, self.keys = code, table, keys
        self.others = (np.zeros(0, np.uint64), np.zeros(0, np.int16))
        self.forget()
        self.logs = {w: math.log10(n + 1) for w, n in top.items()}
        # Most weight on the longest order that a gate stands for, to begin with.
        self.start = np.array([[0.75, 0.12, 0.12, 0.12], [0.12, 0.3, 0.65, 0.12], [0.12, 0.12, 0.25, 0.75]], np.float32)
        middle = (np.arange(BUCKETS) - BUCKETS / 2 + 0.5) / 2.0
        self.identity = (1 / (1 + np.exp(-middle))).astype(np.float32)

    def forget(self) -> None:
        """Empty what is remembered of grams: one empty row is left."""
        self.grams, self.first = pa.array([], pa.uint64()), np.zeros(0, np.int32)
        self.x = np.zeros((1, len(ORDERS)), np.int16)
        self.kind = np.full(1, NONE, np.int8)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys; UNSEEN where no training text has been."""
        out = np.full(len(keys), UNSEEN, np.int16)
        if self.keys is not None:
            slots = 1 << (len(self.keys) - 1).bit_length() - 1
            at = ((keys * SPREAD) >> np.uint64(65 - slots.bit_length())).astype(np.int64)
            left = np.arange(len(keys))
            while len(left):
                held = self.keys[at]
                hit = held == keys[left]
                out[left[hit]] = self.table[at[hit]]
                more = ~hit & (held != EMPTY)
                left, at = left[more], at[more] + 1
        names, values = self.others
        if len(names):
            left = np.flatnonzero(out == UNSEEN)
            at = np.minimum(np.searchsorted(names, keys[left]), len(names) - 1)
            hit = names[at] == keys[left]
            out[left[hit]] = values[at[hit]]
        return out

    def remember(self, grams: np.ndarray) -> None:
        """Work out stretched predictions, gate and bit of each bit of new grams."""
        nodes, bits, lengths = bits_along((grams & np.uint64(255)).astype(np.uint8), self.code)
        x = np.zeros((len(bits), len(ORDERS)), np.int16)
        gate = np.zeros(len(bits), np.int8)
        for k in range(len(ORDERS)):
            value = self.find(np.repeat(context_keys(grams, k) << np.uint64(8), lengths) | nodes)
            known = value != UNSEEN
            x[:, k] = value * known
            gate[known] = GATE_OF[k]
        self.grams = pa.concat_arrays([self.grams, pa.array(grams)])
        self.first = np.concatenate([self.first, (len(self.kind) + np.cumsum(lengths) - lengths).astype(np.int32)])
        self.x, self.kind = np.concatenate([self.x, x]), np.concatenate([self.kind, gate + ONE * bits])

    def words_of(self, text: bytes) -> tuple[int, int, float, list[str]]:
        """Words, frequent words, the sum of their log10(count + 1), and the other words."""
        words = text.lower().split()
        found = list(map(self.logs.get, words))
        rare = [w.decode() for w, x in zip(words, found) if x is None] if None in found else []
        return len(words), len(words) - len(rare), sum(filter(None, found)), rare

    def score(self, texts: list[bytes]) -> list[tuple[float, int, int, float, list[str]]]:
        """Of each text: natural log probability, words, frequent words, the
        sum of their log10(count + 1), and the other words."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        state = {"w": np.repeat(self.start[None], len(texts), 0),
                 "ones": np.repeat((REFINE_COUNT * self.identity)[None], len(texts), 0).astype(np.float32),
                 "all": np.full((len(texts), BUCKETS), REFINE_COUNT, np.float32)}
        total = np.zeros(len(texts))
        ranked = [closed([texts[i]]) for i in order]
        steps = FIRST_STEPS
        while ranked:
            rest = []
            for d, own in enumerate(ranked):
                if len(texts[order[d]]) > SEGMENT and len(own) > SEGMENT:       # later segments of long texts, which come first
                    ends = np.flatnonzero(own[SEGMENT - 1:-1] == SPACE)
                    stop = SEGMENT + int(ends[0]) if len(ends) else len(own)
                    rest.append(own[stop:])
                    ranked[d] = own[:stop]
                elif len(texts[order[d]]) > SEGMENT:
                    rest.append(own[:0])
            self._segments(ranked, state, total, steps)
            steps = (0,)
            ranked = rest if any(map(len, rest)) else []
        out: list = [None] * len(texts)
        for d, i in enumerate(order):
            out[i] = (float(total[d]), *self.words_of(texts[i]))
        return out

    def _segments(self, segments: list[np.ndarray], state: dict, total: np.ndarray, steps: tuple[int, ...]) -> None:
        """Run the texts' next segments, in the given steps to begin with."""
        raw = np.concatenate(segments)
        met = pa.array(grams_of(raw)).dictionary_encode()
        if len(self.kind) > REMEMBERED:
            self.forget()
        place = pc.index_in(met.dictionary, value_set=self.grams)
        if place.null_count:
            self.remember(met.dictionary.filter(place.is_null()).to_numpy())
            place = pc.index_in(met.dictionary, value_set=self.grams)
        x, kind = self.x.view(np.int64).ravel(), self.kind        # four orders of 16 bits
        n = self.code.lengths.astype(np.int32).take(raw)
        through = np.cumsum(n, dtype=np.int32)
        first = self.first.take(place.to_numpy()).take(met.indices.to_numpy())
        path = np.repeat(first - (through - n), n)
        ends = np.concatenate([[0], through])[np.cumsum([0, *map(len, segments)])]
        paths = [path[a:b] for a, b in pairwise(ends.tolist())]
        for own, at in zip(paths, ends.tolist()):
            own += np.arange(at, at + len(own), dtype=np.int32)
        del raw, met, place, n, through, first
        sizes = np.diff(ends)
        rank = np.argsort(-sizes, kind="stable")
        longest = int(sizes.max(initial=0))
        stops = [*steps, *range(STEP, longest + STEP, STEP)]
        held = np.empty((len(segments), STEP), np.int32)
        for s, stop in zip(stops, stops[1:]):
            rank = rank[sizes[rank] > s]
            if not len(rank):
                break
            idx = held[:len(rank), :stop - s]
            many = np.minimum(sizes[rank] - s, stop - s)
            for r, d in enumerate(rank):
                part = paths[d][s:stop]
                idx[r, :len(part)] = part
                idx[r, len(part):] = 0
            for i in range(0, len(rank), 32):        # few enough rows to stay in the cache
                own = idx[i:i + 32]
                self._step(x.take(own).view(np.int16).reshape(*own.shape, -1) * np.float32(1 / UNIT), kind.take(own), many[i:i + 32], rank[i:i + 32], state, total)

    @staticmethod
    def _step(x, kind, many, rank, state, total) -> None:
        """Score and learn a step of the texts ``rank``; the first ``many`` bits of each row are its own."""
        n, k = len(rank), x.shape[2]
        rows = np.arange(n)[:, None]
        gate, one = kind & 3, (kind & ONE) >> 2
        valid = kind != NONE if many.min() < x.shape[1] else None
        w = state["w"][rank]
        gates = gate + rows * GATES
        z = (x * w.reshape(-1, k).take(gates, axis=0)) @ np.ones(k, np.float32)
        np.clip(z, -15, 15, out=z)
        p = np.exp(-z)
        p += 1
        np.reciprocal(p, out=p)
        z *= 2
        z += BUCKETS / 2
        key = z.astype(np.int64)
        np.clip(key, 0, BUCKETS - 1, out=key)
        key += rows * BUCKETS
        ones, seen = state["ones"][rank], state["all"][rank]
        final = (ones / seen).take(key)
        final += p
        final *= np.float32(0.5)
        np.clip(final, 2e-5, 1 - 2e-5, out=final)
        bit = one.astype(np.float32)
        logs = np.log(np.abs(final - (1 - bit)))        # of final or of 1 - final
        error = bit - p
        key *= 2
        key += one
        if valid is not None:
            logs *= valid
            error *= valid
            key[~valid] = 2 * n * BUCKETS
        total[rank] += logs.sum(axis=1, dtype=np.float64)
        by_gate = error[:, None, :] * (gate[:, None, :] == np.arange(GATES, dtype=np.int8)[:, None])
        count = np.bincount(gates.ravel(), minlength=n * GATES).reshape(n, GATES)
        count[:, 0] -= x.shape[1] - many         # what fills a row up has gate 0
        state["w"][rank] = w + RATE * np.matmul(by_gate, x) / (DAMP + count)[:, :, None]
        met = np.bincount(key.ravel(), minlength=2 * n * BUCKETS)[:2 * n * BUCKETS].reshape(n, BUCKETS, 2)
        state["all"][rank] = seen + met.sum(axis=2)
        state["ones"][rank] = ones + met[:, :, 1]


def packed(rows: pa.Table) -> bytes:
    """The rows as one compressed value, as they are written and shuffled."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    return out.getvalue().to_pybytes()


def unpacked(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all().combine_chunks()


def in_blocks(rows: DataFrame) -> DataFrame:
    """The rows (row, doc_id, held_out, text) in blocks of about ``BLOCK`` bytes
    of text, or one longer text: all ``packed``, and the first ``row`` as ``block``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays([table.column("row")[:1].combine_chunks(), pa.array([packed(table)], pa.binary())],
                                              names=["block", "rows"])

        size = 0
        for batch in batches:
            at = 0
            for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist(), 1):
                size += n + 1
                if size > BLOCK:
                    held.append(batch.slice(at, i - at))
                    yield block()
                    held.clear()
                    size, at = 0, i
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield block()

    return rows.mapInArrow(run, "block long, rows binary")


def asked(blocks: DataFrame, sent_keys) -> DataFrame:
    """(block, key): the contexts of each block's texts that are not among the broadcast ones."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = sent_keys.value
        numbers, keys = [], []
        for number, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
            texts = [t.encode() for t in unpacked(rows).column("text").to_pylist()]
            ends = np.cumsum([len(t) for t in texts]) // TOGETHER
            grams = np.unique(np.concatenate([counted_grams(texts[a:b])[0] for a, b in pairwise([0, *(np.flatnonzero(np.diff(ends)) + 1), len(texts)])]))
            own = np.unique(np.concatenate([context_keys(grams, k) for k in range(len(ORDERS))]))
            if len(known):
                own = own[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] != own]
            numbers.append(np.full(len(own), number, np.int64))
            keys.append(own.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(numbers)), pa.array(np.concatenate(keys))],
                                          names=["block", "key"])

    return map_batches(blocks.select("block", "rows"), run, "block long, key long")


def scored(blocks: DataFrame, needed: DataFrame, sent, id_type: str, n_train: int) -> DataFrame:
    """One row per document of the blocks, written: its score, its words and
    what the frequent ones add to the base score; the other words as ``rare``.
    ``needed`` holds the contexts (block, key, next) that are not broadcast: they
    reach their block's task sorted and in batches, so no list of them is collected."""
    mixers: dict[int, Mixer] = {}

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not mixers:
            mixers[0] = Mixer(*sent.value)
        mixer = mixers[0]
        following = right.column("next").combine_chunks()
        items = following.flatten().to_numpy(zero_copy_only=False)
        keys = np.repeat(right.column("key").to_numpy().view(np.uint64), following.value_lengths().to_numpy(zero_copy_only=False))
        mixer.others = predictions(keys, items & 255, items >> 8, mixer.code)
        tables = [unpacked(rows) for rows in left.column("rows")]
        texts = [t.encode() for rows in tables for t in rows.column("text").to_pylist()]
        tables = [rows.drop_columns("text") for rows in tables]
        del following, items, keys
        found: list = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP:
                found += mixer.score(group)
                group, size = [], 0
        found += mixer.score(group)
        numbers, ids, held = (pa.chunked_array([t.column(c).chunk(0) for t in tables]).combine_chunks()
                              for c in ("row", "doc_id", "held_out"))
        log_p, n_words, known, base, rare = zip(*found)
        ends = math.log10(n_train + 1)
        return pa.Table.from_arrays(
            [ids, held, pa.array(map(len, texts), pa.int64()),
             pa.array([n + 1 for n in n_words], pa.int64()), pa.array([n + (n_train > 0) for n in known], pa.int64()),
             pa.array([b + ends for b in base], pa.float64()), pa.array(log_p, pa.float64()),
             pa.array(rare, pa.list_(pa.string())), numbers],
            names=["doc_id", "held_out", "n_bytes", "n_tokens", "known", "base", "log_p", "rare", "row"])

    out = blocks.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(
        block, f"doc_id {id_type}, held_out boolean, n_bytes long, n_tokens long, known long, "
               "base double, log_p double, rare array<string>, row long")
    # Written: the row numbers stay what they are.
    return materialize(out, "lm-scored")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (both log10) and bits_per_byte.

    A null text counts as empty: one end token, and the probability of ending
    at once.  Rows are neither merged nor dropped; a null id counts as the
    empty text for the fold.  Without training documents every prediction is
    even and the base score is zero.  Extra columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       in_fold(F.col(id_col), FOLDS, HELD_OUT).alias("held_out"))
    with shuffles_removed(docs.sparkSession):
        return _scores(rows)


def _scores(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    train = rows.where(~F.col("held_out"))
    counts = byte_counts(train, "text")
    code = prefix_code(counts)
    n_train = counts[END]
    gathered = gather(train, "text")
    words = materialize(gathered.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    n_words, n_distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = n_words + n_train, n_distinct + (n_train > 0)
    share = math.log10(tokens + distinct + 1)
    # The frequent words: all with counts from the least on that at most so many have.
    ranks = words.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(FREQUENT_WORDS).collect()
    room, least = FREQUENT_WORDS, None
    for r in ranks:
        room -= r["n"]
        if room < 0:
            break
        least = r["c"]
    frequent = words.where(F.col("c") >= least).collect() if least is not None else []
    top = {r["word"].encode(): r["c"] for r in frequent}
    # The frequent contexts in the same way, by rank, as many as the table holds.
    contexts = contexts_of(gathered, code)
    discard(gathered)
    room, slots = int(LOAD * (len(ORDERS) << TABLE_BITS)), len(ORDERS) << TABLE_BITS
    least_rank, all_sent = None, True
    for r in contexts.groupBy("rank").agg(F.sum("nodes").alias("n")).orderBy(F.desc("rank")).collect():
        room -= r["n"]
        if room < 0:
            all_sent = False
            break
        least_rank = r["rank"]
    few = (contexts.where(F.col("rank") >= least_rank) if least_rank is not None else contexts.limit(0)) \
        .select("key", "next").toArrow().combine_chunks()
    if few.num_rows:
        sent_keys = np.sort(few.column(0).chunk(0).to_numpy().view(np.uint64))
        table = hashed(*predictions(*flat(few.column(0).chunk(0), few.column(1).chunk(0)), code), slots)
    else:
        sent_keys, table = np.zeros(0, np.uint64), (np.zeros(1, np.int16), None)
    sent = spark.sparkContext.broadcast((code, table[0], top, table[1]))     # fixed size, and a fixed number of words
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # The row numbers are written with the rows, so they stay what they are.
    with batch_rows(spark, BATCH_ROWS):
        blocks = materialize(in_blocks(rows), "lm-blocks", **FEW_ROWS)
    wanted, needed = None, spark.createDataFrame([], "block long, key long, next array<long>")
    if not all_sent:
        rest = contexts.where(F.col("rank") < least_rank) if least_rank is not None else contexts
        packed = F.transform("next", lambda x: F.shiftleft(x["n"], 8).bitwiseOR(x["symbol"].cast("long")))
        with batch_rows(spark, 1):      # one row is a whole block
            wanted = materialize(asked(blocks, spark.sparkContext.broadcast(sent_keys)), "lm-asked")
        needed = wanted.join(rest.select("key", packed.alias("next")).hint("merge"), "key").select("block", "key", "next")
    with batch_rows(spark, GROUPED):
        first = scored(blocks, needed, sent, id_type, n_train)
    discard(blocks)
    if wanted is not None:
        discard(wanted)
    rare = first.select("row", F.explode("rare").alias("word"))
    more = (rare.join(words, "word").groupBy("row")
                .agg(F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("c") + 1)).alias("more_base")))
    out = first.drop("rare").join(more, "row", "left")
    ten = math.log(10)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(share)).alias("base_score"),
        (F.col("log_p") / F.lit(ten)).alias("score"),
        (-F.col("log_p") / F.lit(math.log(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
