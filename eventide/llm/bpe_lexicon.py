"""BPE encoding and decoding through a word lexicon.

The frequent pieces of the corpus are compiled into a minimal acyclic
transducer: words that end alike share their states, and the numbers on the
path of a word add up to its rank, which points at its token ids.  The
transducer is a handful of flat arrays in one file.  Spark hands the file to
each executor once, where the workers memory-map it and share its pages.
Words that the lexicon lacks are merged exactly, so the result never depends
on what it holds.
"""

from __future__ import annotations

import gc
import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.bpe import Recent, Vocabulary, default_path, offsets_of, vocabulary
from eventide.llm.common import map_batches, materialize
from eventide.session import ensure_checkpoint_dir

LEXICON_WORDS = 50_000        # proven bound of the lexicon: at most so many words ...
LEXICON_WORD_BYTES = 24       # ... of so many bytes
CACHED = 300_000              # pieces of one generation of what is remembered
MAGIC = 0x4C455831


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of ``words`` as one block of bytes.

    Words are added in order; a state is frozen once no later word can pass
    through it, and frozen states with the same end mark and the same edges
    are one state.  Each edge carries the number of words that sort before
    its own, so the sum along a path is the rank of the word.
    """
    ordered = sorted(words)
    frozen: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in frozen:
            frozen[key] = len(states)
            states.append(key)
        return frozen[key]

    path: list[list] = [[False, []]]      # of the last word: end mark, edges (byte, frozen state)
    previous = b""

    def close(keep: int) -> None:
        while len(path) > keep + 1:
            done = freeze(path.pop())
            path[-1][1].append((previous[len(path) - 1], done))

    for word in ordered:
        shared = next((i for i, (a, b) in enumerate(zip(word, previous)) if a != b), min(len(word), len(previous)))
        close(shared)
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        previous = word
    close(0)
    root = freeze(path[0])

    size = [0] * len(states)              # words below each state; edges lead to earlier states
    for s, (end, edges) in enumerate(states):
        size[s] = end + sum(size[t] for _, t in edges)
    first, labels, targets, outputs = array("i", [0]), array("B"), array("i"), array("i")
    for end, edges in states:
        before = int(end)
        for byte, t in edges:
            labels.append(byte)
            targets.append(t)
            outputs.append(before)
            before += size[t]
        first.append(len(labels))
    ends = array("B", [end for end, _ in states])
    ids = array("i", chain.from_iterable(words[w] for w in ordered))
    starts = array("i", np.cumsum([0, *(len(words[w]) for w in ordered)]).tolist())
    header = np.array([MAGIC, root, len(states), len(labels), len(ordered), len(ids)], np.int32)
    return b"".join([header.tobytes(), first.tobytes(), targets.tobytes(), outputs.tobytes(), starts.tobytes(),
                     ids.tobytes(), labels.tobytes(), ends.tobytes()])


class Lexicon:
    """A compiled lexicon, read where it lies."""

    def __init__(self, buffer: np.ndarray):
        head = buffer[:24].view(np.int32)
        if head[0] != MAGIC:
            raise ValueError("not a lexicon")
        self.root, n_states, n_edges, n_words, n_ids = map(int, head[1:6])
        at = 24
        for name, n in (("first", n_states + 1), ("targets", n_edges), ("outputs", n_edges),
                        ("starts", n_words + 1), ("ids", n_ids)):
            setattr(self, name, buffer[at:at + 4 * n].view(np.int32))
            at += 4 * n
        self.labels = buffer[at:at + n_edges]
        self.ends = buffer[at + n_edges:at + n_edges + n_states]
        self.n_words = n_words

    def find(self, words: list[bytes]) -> list[int]:
        """The rank of each word, -1 if the lexicon lacks it: all words take
        their next byte together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        letters = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        state, rank = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        live, step = np.arange(len(words)), 0
        while True:
            live = live[lengths[live] > step]
            if not len(live):
                break
            byte, edge = letters[offsets[live] + step], self.first[state[live]].astype(np.int64)
            stop, hit = self.first[state[live] + 1], np.full(len(live), -1, np.int64)
            open_ = np.flatnonzero(edge < stop)
            while len(open_):             # edges of a state lie in the order of their bytes
                seen = self.labels[edge[open_]]
                same = seen == byte[open_]
                hit[open_[same]] = edge[open_[same]]
                edge[open_] += 1
                open_ = open_[(seen < byte[open_]) & (edge[open_] < stop[open_])]
            rank[live[hit < 0]] = -1
            live, hit = live[hit >= 0], hit[hit >= 0]
            state[live] = self.targets[hit]
            rank[live] += self.outputs[hit]
            step += 1
        rank[(rank >= 0) & (self.ends[state] == 0)] = -1
        return rank.tolist()

    def token_ids(self, rank: int) -> list[int]:
        return self.ids[self.starts[rank]:self.starts[rank + 1]].tolist()


# A space that meets another white-space character: such texts are cut one by one.
SPACES_MEET = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] | [\s\x0b\x1c-\x1f\x{85}\p{Z}]"
STEP_BYTES = 8 << 20          # texts worked on together, unless one alone is longer


# A piece of visible ASCII without quotes, with a space before it or none, and other white space inside or behind.
PLAIN = r"^ ?[!-&(-~][\t-\r!-&(-~]*$"
KIND = np.full(256, 2, np.uint8)          # of an ASCII character: 0 a letter, 1 a digit, 2 another, 3 white space
KIND[[*range(65, 91), *range(97, 123)]] = 0
KIND[48:58] = 1
KIND[[*range(9, 14), 32]] = 3


def plain_words(pieces: pa.LargeStringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The pre-tokens of plain pieces in a row, and how many each piece has.

    One begins where the kind of the characters changes, but not behind the
    piece's space; of white space before something visible, the last
    character is one of its own."""
    places = offsets_of(pieces)
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[places[0]:places[-1]]
    starts = places[:-1] - places[0]
    kind = KIND[data]
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = kind[1:] != kind[:-1]
    begins[starts] = True
    white = np.flatnonzero(kind == 3)
    lone = white[data[white] != 32]
    last = lone[~begins[lone] & begins[lone + 1]]       # of several, in the middle or at the end of a piece
    edge = np.zeros(len(data) + 1, bool)
    edge[starts], edge[-1] = True, True
    begins[last[~edge[last + 1]]] = True
    spaces = white[data[white] == 32]
    begins[spaces + 1] = False
    at = np.flatnonzero(begins).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    return words, np.diff(np.searchsorted(at, np.append(starts, len(data))))


class Encoder:
    """Encodes and decodes texts in one worker process."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None):
        self.vocab, self.lexicon = vocab, lexicon
        self.known = Recent(CACHED)
        self.sizes = pa.array([], pa.large_binary()), np.zeros(0, np.int64)     # pre-tokens and their tokens
        size = max(vocab.bytes_of) + 1
        self.raw = pa.array([vocab.bytes_of.get(i, b"") for i in range(size)], pa.large_binary())
        self.decimal = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.special = {s: (i,) for s, i in vocab.special.items()}
        self.odd = "|".join([SPACES_MEET, *map(re.escape, vocab.special)])

    def merged(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of each piece by exact merging; the words that are new are merged together."""
        split = [self.vocab.words.findall(p) for p in pieces]
        fresh = list(set(chain.from_iterable(split)))
        own = dict(zip(fresh, map(tuple, self.vocab.merge_all([w.encode() for w in fresh]))))
        return [own[words[0]] if len(words) == 1 else tuple(chain.from_iterable([own[w] for w in words]))
                for words in split]

    def ids_of(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of each piece: remembered, in the lexicon, or merged."""
        found = [self.known.get(p) for p in pieces]
        fresh = [i for i, ids in enumerate(found) if ids is None]
        ranks = self.lexicon.find([pieces[i].encode() for i in fresh]) if self.lexicon and fresh else [-1] * len(fresh)
        lacking = []
        for i, rank in zip(fresh, ranks):
            if (ids := self.special.get(pieces[i])) is not None:
                found[i] = ids
            elif rank >= 0:
                found[i] = tuple(self.lexicon.token_ids(rank))
            else:
                lacking.append(i)
        for i, ids in zip(lacking, self.merged([pieces[i] for i in lacking])):
            found[i] = ids
        for i in fresh:
            if len(pieces[i]) <= 256:
                self.known.put(pieces[i], found[i])
        return found

    def cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pieces of the texts, the piece at each place, and where
        each text begins and the last one ends.  Texts without special strings
        whose spaces stand alone are cut at every space at once."""
        odd = pc.match_substring_regex(texts, self.odd)
        if pc.any(odd).as_py():
            pieces, ends = [], [0]
            for text in texts.to_pylist():
                for n, segment in enumerate(self.vocab.segments(text)):
                    pieces += [segment] if n % 2 else self.vocab.pieces(segment)
                ends.append(len(pieces))
            coded = pa.array(pieces, pa.large_string()).dictionary_encode()
            return strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), np.array(ends)
        parts = pc.split_pattern(texts, " ")
        coded, ends = parts.flatten().dictionary_encode(), parts.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        words, place = strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        place[ends[:-1]] += len(words)             # the first word of a text has no space before it
        seen = np.zeros(2 * len(words), bool)
        seen[place] = True
        used, renumbered = np.flatnonzero(seen), np.cumsum(seen) - 1
        return ([words[u - len(words)] if u >= len(words) else " " + words[u] for u in used.tolist()],
                renumbered[place], ends)

    def word_sizes(self, words: pa.LargeBinaryArray) -> np.ndarray:
        """Tokens of each of the distinct pre-tokens: remembered, or merged."""
        names, sizes = self.sizes
        at = pc.index_in(words, value_set=names)
        out = sizes.take(at.fill_null(0).to_numpy()) if len(names) else np.zeros(len(words), np.int64)
        fresh = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        if len(fresh):
            new = words.take(pa.array(fresh))
            out[fresh] = own = self.vocab.merged_sizes(new)
            short = np.flatnonzero(np.diff(offsets_of(new)) <= 64)[:CACHED]
            new, own = new.take(pa.array(short)), own[short]
            full = len(names) + len(new) > CACHED
            self.sizes = (new, own) if full else (pa.concat_arrays([names, new]), np.concatenate([sizes, own]))
        return out

    def piece_sizes(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Tokens of each of the distinct pieces, none of which is a special string."""
        plain = pc.match_substring_regex(pieces, PLAIN)
        words, many = plain_words(pieces.filter(plain))
        split = [self.vocab.words.findall(p) for p in strings(pieces.filter(pc.invert(plain)))]
        mask, counts = plain.to_numpy(zero_copy_only=False), np.zeros(len(pieces), np.int64)
        more = pa.array([w.encode() for w in chain.from_iterable(split)], pa.large_binary())
        counts[mask], counts[~mask] = many, np.fromiter(map(len, split), np.int64, len(split))
        coded = pa.concat_arrays([words, more]).dictionary_encode()
        sizes = self.word_sizes(coded.dictionary)[coded.indices.to_numpy()]
        # The words of the plain pieces come first.
        through = np.concatenate([[0], np.cumsum(sizes)])
        out, ends = np.zeros(len(pieces), np.int64), np.cumsum(np.concatenate([[0], counts[mask], counts[~mask]]))
        both = np.diff(through[ends])
        out[mask], out[~mask] = both[:len(many)], both[len(many):]
        return out

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; Python only touches distinct pieces that are not plain."""
        out = np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        if len(even := np.flatnonzero(~odd)):
            own = texts if len(even) == len(texts) else texts.take(pa.array(even))
            parts = pc.split_pattern(own, " ")
            ends = parts.offsets.to_numpy().astype(np.int64)
            ends -= ends[0]
            coded = parts.flatten().dictionary_encode()
            words, place = coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy().astype(np.int64)
            # The first word of a text has no space before it.
            firsts, number = np.unique(place[ends[:-1]], return_inverse=True)
            place[ends[:-1]] = len(words) + number
            none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
            spaced = pc.binary_join_element_wise(none, words, space)
            sizes = self.piece_sizes(pa.concat_arrays([spaced, words.take(pa.array(firsts))]))
            out[even] = np.diff(np.concatenate([[0], np.cumsum(sizes[place])])[ends])
        if len(which := np.flatnonzero(odd)):
            pieces, ends, special = [], [0], []
            for text in texts.take(pa.array(which)).to_pylist():
                segments = self.vocab.segments(text)
                for segment in segments[::2]:
                    pieces += self.vocab.pieces(segment)
                ends.append(len(pieces))
                special.append(len(segments) // 2)
            coded = pa.array(pieces, pa.large_string()).dictionary_encode()
            sizes = self.piece_sizes(coded.dictionary)[coded.indices.to_numpy()]
            out[which] = np.diff(np.concatenate([[0], np.cumsum(sizes)])[ends]) + special
        return out

    def encode(self, texts: pa.Array) -> Encoded:
        """The token ids of each text; Python only touches distinct pieces."""
        pieces, place, ends = self.cut(texts)
        own = self.ids_of(pieces)
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter(chain.from_iterable(own), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        taken = sizes[place]                       # tokens at each place, and the ids of all in a row
        before = np.concatenate([[0], np.cumsum(taken)])
        ids = flat[np.arange(before[-1]) + np.repeat(starts[place] - before[:-1], taken)]
        return Encoded(self, ids, before[ends])


class Encoded(NamedTuple):
    """Token ids of some texts in a row; ``ends`` is where each begins and the last ends."""

    by: Encoder
    ids: np.ndarray
    ends: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.ends)

    def _laid_out(self, of_id: pa.Array) -> list[memoryview]:
        """For each text what ``of_id`` holds of its tokens, one after the other."""
        line = of_id.take(pa.array(self.ids))
        _, offsets, data = line.buffers()
        at = np.frombuffer(offsets, np.int64)[line.offset + self.ends] if len(line) else self.ends * 0
        data = memoryview(data) if data is not None else memoryview(b"")
        return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def decimals(self) -> list[memoryview]:
        """The ids of each text in decimal, joined by commas."""
        return [text[:-1] for text in self._laid_out(self.by.decimal)]

    def decoded(self) -> list[str]:
        """The text of the token ids, special ones included."""
        return [str(text, "utf-8", "replace") for text in self._laid_out(self.by.raw)]


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def steps(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of at most ``STEP_BYTES`` together, or a single longer one."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        base = int(total[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + STEP_BYTES, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def frequent_pieces(docs: DataFrame, n: int = LEXICON_WORDS, text_col: str = "text") -> list[str]:
    """The most frequent pieces of all texts, at most ``n``; words of one count
    are all taken or all left.

    Words between spaces are counted natively over the whole table; pieces
    longer than ``LEXICON_WORD_BYTES`` bytes stay out.
    """
    words = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), " ")).alias("w"))
    counted = materialize(words.where(F.octet_length("w").between(1, LEXICON_WORD_BYTES - 1) & ~F.col("w").rlike(r"\s"))
                               .groupBy("w").agg(F.count(F.lit(1)).alias("n")), "lexicon-words")
    # All words from the least count on that at most ``n`` words reach.
    room, least = n, None
    for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).limit(n).collect():
        room -= r["k"]
        if room < 0:
            break
        least = r["n"]
    return [" " + r["w"] for r in counted.where(F.col("n") >= least).collect()] if least is not None else []


def publish_lexicon(spark: SparkSession, block: bytes) -> str:
    """Write the lexicon to the shared folder and have every executor fetch
    it once; the name under which workers find it."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/scratch/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(block)
    finally:
        out.close()
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    spark.sparkContext.addFile(full)
    return name


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def encoder(vocab_path: str, lexicon_name: str | None = None) -> Encoder:
    """One encoder per worker process for the lexicon in use, if any; its file is memory-mapped."""
    key = vocab_path, lexicon_name
    if key not in _ENCODERS:
        _ENCODERS.clear()
        lexicon = Lexicon(np.memmap(SparkFiles.get(lexicon_name), np.uint8, "r")) if lexicon_name else None
        _ENCODERS[key] = Encoder(vocabulary(vocab_path), lexicon)
    return _ENCODERS[key]


def build_lexicon(docs: DataFrame, path: str | None = None, n_words: int = LEXICON_WORDS,
                  text_col: str = "text") -> str:
    """Compile the corpus' frequent pieces and hand them to the executors."""
    vocab = vocabulary(path or default_path())
    maker = Encoder(vocab, None)
    pieces = frequent_pieces(docs, n_words, text_col)
    words = {p.encode(): list(ids) for p, ids in zip(pieces, maker.merged(pieces))}
    return publish_lexicon(docs.sparkSession, compile_lexicon(words))


def encode_decode(docs: DataFrame, lexicon: str | None = None, path: str | None = None, digest: bool = True,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode it again.

    ``digest`` gives SHA-256 sums of the ids (in decimal, joined by commas)
    and of the decoded text; without it the ids and the text themselves.
    A null text counts as empty: no ids, and the sums of the empty string.
    Every row gives one row, repeated rows and null ids included; extra
    columns are not looked at.
    """
    path = path or default_path()
    lexicon = lexicon or build_lexicon(docs, path, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, " + \
        ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        gc.disable()          # many small objects and no cycles
        of = encoder(path, lexicon)
        counts, left, right = [], [], []
        for texts in steps(batch.column(1)):
            got = of.encode(texts)
            counts.append(got.counts())
            decoded = got.decoded()
            if digest:
                left += [hashlib.sha256(d).hexdigest() for d in got.decimals()]
                right += [hashlib.sha256(d.encode()).hexdigest() for d in decoded]
            else:
                left += [got.ids[a:b].tolist() for a, b in zip(got.ends, got.ends[1:])]
                right += decoded
        kind = pa.string() if digest else pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(counts), pa.int64()), pa.array(left, kind), pa.array(right, pa.string())],
            names=["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])])

    return map_batches(rows, run, schema)
