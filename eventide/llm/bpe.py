"""Byte-level BPE from a public vocabulary file: vocabulary, merge ranks,
pre-tokens and exact merging of one pre-token.

A text is first cut at special-token strings, which each become one token,
then at single spaces between two visible characters.  No pre-token crosses
such a space, so the pieces can be encoded -- and cached -- one by one.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
SPACES_MEET = re.compile(r"\s |\ \s")
NONE = 1 << 60
TOGETHER = 1 << 13            # pre-tokens that take their merges together
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 48)      # bytes of such pre-tokens; longer ones are merged one by one


def offsets_of(column: pa.Array) -> np.ndarray:
    """Where each value of a column with long offsets begins in its data, and where the last one ends."""
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]


def byte_of_char() -> dict[str, int]:
    """The printable stand-in character of each byte: itself where it is a
    visible Latin-1 character, else the next code point from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Recent:
    """What was computed last, in two generations: a full one becomes the
    older one, and what is asked for again moves to the younger."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Vocabulary:
    """Token bytes by id, id by token bytes, and the rank of each merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_of_char()
        raw = lambda s: bytes(of[c] for c in s)
        self.id_of = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: s.encode() for s, i in self.special.items()}
        self.rank, self.merged = {}, []           # of a pair of ids; the id that the merge of a rank makes
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            self.rank[self.id_of[a], self.id_of[b]] = n
            self.merged.append(self.id_of[a + b])
        self.id_of_byte = [self.id_of[bytes([b])] for b in range(256)]
        self.first_ids = np.array(self.id_of_byte)
        pairs = np.array([(a << 32) | b for a, b in self.rank] or [-1], np.int64)
        self.pair_order = np.argsort(pairs)
        self.pair_keys, self.merged_ids = pairs[self.pair_order], np.array(self.merged or [0], np.int64)
        # Of a pair of bytes, whose ranks are looked up most.
        self.first_ranks = self._ranks(np.repeat(self.first_ids, 256), np.tile(self.first_ids, 256))
        self.longest = max(map(len, self.id_of))
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def segments(self, text: str) -> list[str]:
        """The text cut at special-token strings; every second entry is one."""
        return self.at_special.split(text) if self.at_special else [text]

    @staticmethod
    def pieces(segment: str) -> list[str]:
        """The segment cut before each single space between visible characters."""
        parts = SAFE_SPACE.split(segment) if SPACES_MEET.search(segment) else segment.split(" ")
        return [p for p in (parts[0], *[" " + p for p in parts[1:]]) if p]

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE of one pre-token: the lowest-ranked adjacent pair merges
        first, leftmost on ties."""
        if len(word) > 48:
            return self._merge_long(word)
        ids, rank, merged = [self.id_of_byte[b] for b in word], self.rank.get, self.merged
        ranks = [rank(pair, NONE) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            at = ranks.index(best)
            ids[at] = merged[best]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), NONE)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), NONE)
        return ids

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, ``NONE`` where they never merge."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (right >= 0), self.pair_order[at], NONE)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many pre-tokens: those of like length take their next merge together."""
        out: list[list[int]] = [[]] * len(words)
        laid = pa.array(words, pa.large_binary())
        for rows, ids, size in self._merge_groups(laid):
            for i, own, n in zip(rows.tolist(), ids.tolist(), size.tolist()):
                out[i] = own[:n]
        for i in self._long(laid):
            out[i] = self._merge_long(words[i])
        return out

    def merged_sizes(self, words: pa.LargeBinaryArray) -> np.ndarray:
        """How many tokens ``merge`` makes of each pre-token."""
        out = np.zeros(len(words), np.int64)
        for rows, _, size in self._merge_groups(words):
            out[rows] = size
        for i in self._long(words):
            out[i] = len(self._merge_long(words[i].as_py()))
        return out

    @staticmethod
    def _long(words: pa.LargeBinaryArray) -> list[int]:
        return np.flatnonzero(np.diff(offsets_of(words)) > WIDTHS[-1]).tolist()

    def _merge_groups(self, words: pa.LargeBinaryArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, token ids, how many of them) of words of like length, up to the greatest width."""
        starts, data = offsets_of(words), np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(starts)
        by_length, first = np.argsort(lengths, kind="stable"), 0
        first = int(np.searchsorted(lengths, 0, "right", sorter=by_length))
        for width in WIDTHS:
            last = int(np.searchsorted(lengths, width, "right", sorter=by_length))
            for start in range(first, last, TOGETHER):
                rows = by_length[start:min(last, start + TOGETHER)]
                size, column = lengths[rows], np.arange(width)
                letters = data[np.minimum(starts[rows, None] + column, len(data) - 1)]
                yield rows, *self._merge_rows(letters, size)
            first = last

    def _merge_rows(self, letters: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of words given as rows of bytes, and how many each has."""
        width = letters.shape[1]
        size, column = size.copy(), np.arange(width)
        inside = column < size[:, None]
        ids = np.where(inside, self.first_ids[letters], -1)
        ranks = np.full(ids.shape, NONE)               # of the pair that begins in a column
        pairs = (letters[:, :-1].astype(np.int64) << 8) | letters[:, 1:]
        ranks[:, :-1] = np.where(inside[:, 1:], self.first_ranks[pairs], NONE)
        done_ids, done_size = ids, size
        live = np.arange(len(ids))
        while True:
            at = ranks.argmin(axis=1)                  # the lowest rank, leftmost on ties
            best = ranks[np.arange(len(live)), at]
            going = best != NONE
            if not going.all():
                done_ids[live], done_size[live] = ids, size
                live, ids, ranks, size, at, best = live[going], ids[going], ranks[going], size[going], at[going], best[going]
            if not len(live):
                return done_ids, done_size
            row = np.arange(len(live))
            kept = np.minimum(column + (column > at[:, None]), width - 1) + row[:, None] * width
            ids, ranks = ids.take(kept), ranks.take(kept)
            ids[:, -1], ranks[:, -1] = -1, NONE
            ids[row, at] = self.merged_ids[best]
            size = size - 1
            after, inner = np.minimum(at + 1, width - 1), np.flatnonzero(at > 0)
            ranks[row, at] = np.where(after > at, self._ranks(ids[row, at], ids[row, after]), NONE)
            ranks[inner, at[inner] - 1] = self._ranks(ids[inner, at[inner] - 1], ids[inner, at[inner]])

    def _merge_long(self, word: bytes) -> list[int]:
        """The same by a heap over linked parts, for pre-tokens of any length."""
        parts: list[int | None] = [self.id_of_byte[b] for b in word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < len(parts):
                r = self.rank.get((parts[i], parts[j]))
                if r is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = self.merged[r], None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


def default_path() -> str:
    return public_tokenizers.path(DEFAULT_VOCABULARY)
