"""Exact BPE token counts of every prefix of a text, by dynamic programming.

In a byte-level BPE, a sequence of tokens is the encoding of its bytes if and
only if each adjacent pair is the encoding of its own bytes.  So the encoding
of a prefix ends in exactly one token ``t`` such that the prefix without ``t``
ends in a token that pairs with ``t``: one pass from left to right gives the
last token and the count of every prefix of a pre-token.  The counts of a
text are the counts inside its pieces on top of what the pieces before hold.

The stored counts answer, without encoding again, how many tokens a prefix
has and which longest prefix fits a budget (``PrefixTable``).  Counts are not monotone: one more character may merge
two tokens into one.
"""

from __future__ import annotations

import gc
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.bpe import Recent, Vocabulary, default_path, vocabulary
from eventide.llm.common import map_batches

CACHED = 200_000              # entries of one generation of what is remembered
HEAD = 6                      # bytes of a word whose counts all words that begin alike share
CONTRACTED = ("'re", "'ve", "'ll")
SPACES = re.compile(r"\s\s+")


@dataclass
class PrefixTable:
    """Token counts of every prefix of one text, piece by piece: where each
    piece starts, the tokens before it, and the counts at its characters
    (shared by all texts that hold the piece)."""

    starts: list[int]
    before: list[int]
    inner: list[tuple[int, ...]]
    n_chars: int
    n_tokens: int
    special: tuple[int, ...] = ()     # pieces that are special strings

    def count_prefix(self, characters: int) -> int:
        """Tokens of the prefix of that many characters."""
        if characters <= 0 or not self.inner:
            return 0
        if characters >= self.n_chars:
            return self.n_tokens
        k = bisect_right(self.starts, characters - 1) - 1
        return self.before[k] + self.inner[k][characters - 1 - self.starts[k]]

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.
        Counts are not monotone inside a piece, so it is read from its end;
        cut inside a special string, they may fall below those before it."""
        if self.n_tokens <= budget:
            return self.n_chars
        first = bisect_left(self.before, budget) - 1
        for k in (*(k for k in reversed(self.special) if k > first), *range(first, -1, -1)):
            for i in range(len(self.inner[k]), 0, -1):
                if self.before[k] + self.inner[k][i - 1] <= budget:
                    return self.starts[k] + i
        return 0

    def counts(self) -> list[int]:
        """The count of every prefix, the empty one first."""
        return [0, *(b + c for b, inner in zip(self.before, self.inner) for c in inner)]


class PrefixCounter:
    """Counts for one vocabulary; pieces and token pairs are remembered up to
    a fixed number of entries."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pieces, self.words, self.heads = Recent(CACHED), Recent(CACHED), Recent(CACHED)
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        if len(self.pairs) >= 4 * CACHED:
            self.pairs.clear()
        known = self.pairs[a, b] = self.vocab.merge(self.vocab.bytes_of[a] + self.vocab.bytes_of[b]) == [a, b]
        return known

    def word_counts(self, word: bytes) -> list[int]:
        """Token count of each byte prefix of a pre-token, the empty one first."""
        id_of, longest, pairs = self.vocab.id_of.get, self.vocab.longest, self.pairs.get
        counts, last = [0], [-1]
        if long := len(word) > HEAD:
            if (head := self.heads.get(word[:HEAD])) is not None:
                counts, last = head[0].copy(), head[1].copy()
        for end in range(len(counts), len(word) + 1):
            if long and end == HEAD + 1 and head is None:
                self.heads.put(word[:HEAD], (counts.copy(), last.copy()))
            for start in range(end - 1, -1 if end <= longest else end - longest - 1, -1):
                token = id_of(word[start:end])
                if token is None:
                    continue
                if start:
                    ok = pairs((last[start], token))
                    if not (self.compatible(last[start], token) if ok is None else ok):
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                break
        return counts

    def word_entry(self, word: str) -> tuple[int, ...]:
        """Tokens of each non-empty character prefix of a pre-token."""
        if (known := self.words.get(word)) is not None:
            return known
        counts = self.word_counts(raw := word.encode())
        if len(raw) != len(word):
            counts = [counts[i] for i in accumulate((len(c.encode()) for c in word), initial=0)]
        if word in CONTRACTED:      # cut short, the quote and the letter are two pre-tokens
            counts[2] = 2
        own = tuple(counts[1:])
        if len(word) <= 64:
            self.words.put(word, own)
        return own

    def piece_counts(self, piece: str) -> tuple[int, tuple[int, ...]]:
        """Tokens of the piece, and of each of its non-empty character prefixes."""
        if (known := self.pieces.get(piece)) is not None:
            return known
        words = self.vocab.words.findall(piece)
        if len(words) == 1 and len(piece) > 1 and not piece.isspace():
            own = self.words.young.get(piece) or self.word_entry(piece)
            entry = own[-1], own
        else:
            entry = self.joined(piece, words)
        if len(piece) <= 64:
            self.pieces.put(piece, entry)
        return entry

    def joined(self, piece: str, words: list[str]) -> tuple[int, tuple[int, ...]]:
        before, out = 0, []
        for word in words:
            own = self.words.young.get(word) or self.word_entry(word)
            out += [before + c for c in own] if before else own
            before += own[-1]
        # White space at the end of a prefix is one pre-token as long as nothing visible follows.
        for run in SPACES.finditer(piece):
            held = out[run.start() - 1] if run.start() else 0
            out[run.start() + 1:run.end()] = [held + c for c in self.word_entry(run.group())[1:]]
        return before, tuple(out)

    def table(self, text: str) -> PrefixTable:
        """The counts of all prefixes of ``text``."""
        pieces, entries, cached = [], [], self.pieces.young.get
        for n, segment in enumerate(self.vocab.segments(text)):
            if n % 2:     # a special string: ordinary text, after what stands before it, until its last character
                tail = pieces[-1] if pieces and pieces[-1] not in self.vocab.special else ""
                base = entries[-1][0] if tail else 0
                inner = self.piece_counts(tail + segment)[1][len(tail):]
                entries.append((1, (*(c - base for c in inner[:-1]), 1)))
                pieces.append(segment)
                continue
            own = self.vocab.pieces(segment)
            pieces += own
            entries += [cached(p) or self.piece_counts(p) for p in own]
        before = list(accumulate((e[0] for e in entries), initial=0))
        starts = list(accumulate(map(len, pieces), initial=0))
        total = before.pop()
        starts.pop()
        special = tuple(k for k, p in enumerate(pieces) if p in self.vocab.special) if n else ()
        return PrefixTable(starts, before, [e[1] for e in entries], len(text), total, special)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(vocabulary(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, limit: int = 512, path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", with_prefixes: bool = False) -> DataFrame:
    """Bytes and exact tokens of each whole text, whether it has more than
    ``limit`` tokens, and how many characters fit that budget.

    A null text counts as empty (no bytes, no tokens).  Rows are neither
    merged nor dropped: repeated rows, null ids and clashing extra columns
    give one row each.  ``with_prefixes`` adds the count of every prefix
    (``prefix_tokens``, one entry more than the text has characters).
    """
    path = path or default_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" \
        + (", prefix_tokens array<int>" if with_prefixes else "")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        gc.disable()          # many small objects and no cycles
        of = counter(path)
        out: tuple[list, ...] = ([], [], [], [], [])
        for text in batch.column(1).to_pylist():
            table = of.table(text)
            out[0].append(len(text.encode()))
            out[1].append(table.n_tokens)
            out[2].append(table.n_tokens > limit)
            out[3].append(table.longest_within(limit))
            if with_prefixes:
                out[4].append(table.counts())
        cols = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                pa.array(out[2], pa.bool_()), pa.array(out[3], pa.int64())]
        if with_prefixes:
            cols.append(pa.array(out[4], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    return map_batches(rows, run, schema)
