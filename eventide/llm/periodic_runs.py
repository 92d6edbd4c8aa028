"""Runs of words that repeat with a period, found on a grammar.

The word ids of a batch of documents are compressed by Re-Pair: pairs of
neighbouring symbols that occur again are replaced by a new symbol, the most
frequent first, until no pair occurs twice; what is left of each document is
then joined pairwise to one symbol.  A run lies inside some symbol and crosses
the boundary between its two halves, so the runs crossing the boundary of each
symbol are computed once, on one copy of its words, and translated to every
position where the derivation of a document has it.  Parts of a run that the
ends of a smaller symbol cut off lie inside the whole one, with the same
period; merging the intervals leaves the maximal ones.

Tasks hold a few documents at a time; memory follows the longest text (some
200 bytes a word).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 24
MIN_EXPONENT = 3
# Documents that share a grammar: about so many bytes of text, or one longer document.
GRAMMAR_BYTES = 1 << 21
RUNS = "array<struct<start: long, length: long, period: long>>"


class Grammar:
    """Rules of two halves each, for symbols from ``terminals`` on; a rule has
    its number of words and the place of one copy of them."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.terminals = int(words.max()) + 1
        self.left, self.right, self.at = ([np.zeros(0, np.int64)] for _ in range(3))
        self.length = np.ones(self.terminals, np.int64)
        self.rounds = [self.terminals]              # first symbol of each round of new rules
        self.seq, self.doc, self.start = words.astype(np.int64), doc, np.arange(len(words))
        self._replace_repeated()
        self._join_rest()
        self.left, self.right, self.at = (np.concatenate(x) for x in (self.left, self.right, self.at))

    def _add(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.at.append(at)
        self.length = np.concatenate([self.length, self.length[left] + self.length[right]])
        self.rounds.append(len(self.length))

    def _put(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Replace the pairs that begin at ``at``; what is kept of the sequence."""
        keep = np.ones(len(self.seq), bool)
        keep[at + 1] = False
        self.seq[at] = symbols
        self.seq, self.doc, self.start = self.seq[keep], self.doc[keep], self.start[keep]
        return keep

    def _replace_repeated(self) -> None:
        inside = lambda: np.append(self.doc[1:] == self.doc[:-1], False)  # noqa: E731  pairs of one document
        open_ = inside()
        while True:
            at = np.flatnonzero(open_)
            base = len(self.length)
            pair, kind, count = np.unique(self.seq[at] * base + self.seq[at + 1], return_inverse=True, return_counts=True)
            again = count[kind] >= 2
            open_[at[~again]] = False               # a pair that occurs once does so for good
            at, kind = at[again], kind[again]
            if not len(at):
                return
            # More frequent pairs first, by powers of two; a hash orders the rest, so that many
            # pairs are replaced in one round wherever they are the first choice of both symbols.
            order = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(8)
            order |= np.log2(count).astype(np.uint64) << np.uint64(56)
            rank = (order + np.uint64(1))[kind]
            near = at[1:] == at[:-1] + 1
            before = np.where(np.append(False, near), np.append(np.uint64(0), rank[:-1]), np.uint64(0))
            after = np.where(np.append(near, False), np.append(rank[1:], np.uint64(0)), np.uint64(0))
            first = np.flatnonzero(rank != before)  # of equal neighbours (one symbol repeated) every second pair
            last = np.append(first[1:], len(rank)) - 1
            group = np.cumsum(rank != before) - 1
            best = (rank[first] > before[first]) & (rank[last] > after[last])
            chosen = best[group] & ((np.arange(len(rank)) - first[group]) % 2 == 0)
            at, kind = at[chosen], kind[chosen]
            kinds, one, which = np.unique(kind, return_index=True, return_inverse=True)
            self._add(pair[kinds] // base, pair[kinds] % base, self.start[at[one]])
            open_[at] = True
            open_[np.maximum(at - 1, 0)] = True
            open_ = open_[self._put(at, base + which)] & inside()

    def _join_rest(self) -> None:
        while True:
            first = np.append(True, self.doc[1:] != self.doc[:-1])
            place = np.arange(len(self.seq)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            at = np.flatnonzero((place[:-1] % 2 == 0) & ~first[1:])
            if not len(at):
                return
            base = len(self.length)
            self._add(self.seq[at].copy(), self.seq[at + 1].copy(), self.start[at])
            self._put(at, base + np.arange(len(at)))


def common(x: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many words from ``i`` and ``j`` on (``step`` 1) or back (-1) are equal, ``most`` at most."""
    n, width = 0, 32
    while n < most:
        m = min(width, most - n)
        a, b = ((x[i + n:i + n + m], x[j + n:j + n + m]) if step > 0 else
                (x[i - n - m + 1:i - n + 1][::-1], x[j - n - m + 1:j - n + 1][::-1]))
        differ = a != b
        if differ.any():
            return n + int(differ.argmax())
        n, width = n + m, 2 * width
    return n


def boundary_runs(x: np.ndarray, g: Grammar, min_words: int, min_exponent: int):
    """(rule, start, length, period) of the runs that cross a rule's boundary,
    from the rule's first word.

    A run of period q has at least max(min_words, 3q) - q places whose word
    comes again q later.  So for ``gram = min_words // 3`` words either those
    right after or those right before the boundary come again q further on, or
    those right before it came q earlier; only such q are tried.
    """
    gram = max(1, min_words // 3)
    rules = np.flatnonzero(g.length[g.terminals:] >= min_words)
    hashes = np.zeros(max(0, len(x) - gram + 1), np.uint64)
    for k in range(gram):
        hashes = hashes * np.uint64(0x100000001B3) + (x[k:k + len(hashes)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    if not len(rules) or not len(hashes):
        return (np.zeros(0, np.int64),) * 4
    _, same = np.unique(hashes, return_inverse=True)
    n = len(x) + 1
    index = np.sort(same * n + np.arange(len(same)))
    lo = g.at[rules]
    size = g.length[g.terminals + rules]
    b, hi, most = lo + g.length[g.left[rules]], lo + size, size // min_exponent

    def pairs(a, least, top):
        """(rule, place) for places with the words of ``a`` from ``least`` to ``top``, without ``a``."""
        ok = np.flatnonzero((a >= lo) & (a + gram <= hi))
        if not len(ok):
            return ok, ok
        own = same[a[ok]] * n
        one = np.searchsorted(index, own + np.maximum(least, lo)[ok])
        end = np.searchsorted(index, own + np.minimum(top, hi - gram)[ok], side="right")
        many = np.maximum(end - one, 0)
        which = np.repeat(np.arange(len(ok)), many)
        place = index[one[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)] % n
        return ok[which], place

    found = []
    for a, least, top in ((b, b + 1, b + most), (b - gram, b - gram + 1, b - gram + most), (b - gram, b - gram - most, b - gram - 1)):
        which, place = pairs(a, least, top)
        found.append((which, np.abs(place - a[which]), np.minimum(place, a[which])))
    which, q, a = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((a, q, which))
    which, q, a = which[order], q[order], a[order]
    out = []
    edges = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else []
    for s, e in zip(edges, [*edges[1:], len(which)]):
        r, qs, places = which[s], q[s:e], a[s:e]
        low, high, mid = int(lo[r]), int(hi[r]), int(b[r])
        while len(qs):
            p, i = int(qs[0]), int(places[0])
            if common(x, i, i + p, gram, 1) < gram:     # equal hashes of different words
                qs, places = qs[1:], places[1:]
                continue
            begin = i - common(x, i - 1, i - 1 + p, i - low, -1)
            end = i + p + common(x, i, i + p, high - i - p, 1)
            if end - begin >= max(min_words, min_exponent * p) and begin < mid < end:
                out.append((rules[r], begin - low, end - begin, p))
            # Whatever has a multiple of this period inside this stretch has this period.
            rest = (qs % p != 0) | (places < begin) | (places + qs + gram > end)
            rest[0] = False
            qs, places = qs[rest], places[rest]
    return tuple(np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """The intervals that lie in no other of their period, by start, then period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.append(0, period[1:] != period[:-1])) if len(period) else period
    reach = group * (int(end.max(initial=0)) + 1) + end
    keep = reach > np.append(-1, np.maximum.accumulate(reach)[:-1]) if len(reach) else reach.astype(bool)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs(words: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT):
    """(start, end, period) of all runs of the word ids ``words``, which belong
    to the documents ``doc`` (ascending); no run leaves its document."""
    none = (np.zeros(0, np.int64),) * 3
    if len(words) < min_words:
        return none
    g = Grammar(words, doc)
    rule, offset, length, period = boundary_runs(words, g, min_words, min_exponent)
    if not len(rule):
        return none
    count = np.bincount(rule, minlength=len(g.left))         # boundary_runs() lists rules in order
    first = np.cumsum(count) - count
    holds = np.zeros(len(g.length), bool)
    holds[g.terminals:] = count > 0
    for s, e in zip(g.rounds, g.rounds[1:]):
        holds[s:e] |= holds[g.left[s - g.terminals:e - g.terminals]] | holds[g.right[s - g.terminals:e - g.terminals]]
    symbol, at = g.seq[holds[g.seq]], g.start[holds[g.seq]]
    starts, ends, periods = [], [], []
    while len(symbol):                                        # one level of the derivations at a time
        r = symbol - g.terminals
        many = count[r]
        which = np.repeat(np.arange(len(r)), many)
        k = first[r][which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        starts.append(at[which] + offset[k])
        ends.append(starts[-1] + length[k])
        periods.append(period[k])
        symbol, at = (np.concatenate([g.left[r], g.right[r]]), np.concatenate([at, at + g.length[g.left[r]]]))
        symbol, at = symbol[holds[symbol]], at[holds[symbol]]
    return maximal(*(np.concatenate(c) for c in (starts, ends, periods)))


def collapse(ids: pa.Array, texts: pa.Array, rewrite, min_words: int, min_exponent: int) -> pa.RecordBatch:
    """One result row per text."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    sizes = np.diff(split.offsets.to_numpy()).astype(np.int64)
    flat = split.flatten()
    sizes[pc.equal(pc.binary_length(pc.ascii_trim_whitespace(pc.fill_null(texts, ""))), 0).to_numpy(zero_copy_only=False)] = 0
    if sizes.sum() != len(flat):                 # an empty text is split into one empty word
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    edges = np.append(0, np.cumsum(sizes))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat))
    if rewrite is not None:
        place = rewrite(ids.to_pylist(), edges)
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[place]
    start, end, period = runs(words, doc, min_words, min_exponent)
    dropped = np.zeros(len(place) + 1, np.int64)             # where stretches of dropped words begin and end
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    keep = np.cumsum(dropped[:-1]) == 0
    kept = np.append(0, np.cumsum(np.bincount(doc[keep], minlength=len(sizes))))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.take(pa.array(place[keep]))), " ")
    of = doc[start]
    bounds = np.append(0, np.cumsum(np.bincount(of, minlength=len(sizes))))
    each = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start - edges[of], end - start, period)],
                                      names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each), collapsed],
        names=["doc_id", "n_words", "runs", "collapsed"])


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch in slices of about GRAMMAR_BYTES of text, one row at least."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(size, before + GRAMMAR_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT,
              rewrite: Callable[[list, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are what white space (space, tab to carriage return) separates.
    ``runs`` lists every maximal stretch (start, length, period) of at least
    ``min_words`` words and ``min_exponent`` (3 at least) periods, by start,
    then period, with its smallest period; ``collapsed`` is the words that lie
    in no run beyond its first period, joined by single spaces.
    ``rewrite(doc_ids, edges)`` may name for each word of a batch, document
    after document between ``edges``, the word to take its place.

    Null and empty texts have no words, no run and an empty text.  Repeated
    rows and rows without id give a row each.  Texts have no length limit.
    Other columns are not read.  An empty table gives no rows.
    """
    if min_exponent < 3 or min_words < 3:
        raise ValueError("runs have three words and three periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            yield collapse(part.column(0), part.column(1), rewrite, min_words, min_exponent)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def most_repeated(runs):
    """The run of greatest length / period, compared exactly; ties go to the
    smaller start, then period (the order of ``runs``); null without runs."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda best, x: F.when(
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))
