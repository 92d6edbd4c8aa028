"""Runs against brute force, on random, periodic and odd texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from eventide.llm import periodic_runs, queries
from eventide.llm.common import read_table
from tests.conftest import SF001


def brute_runs(w, least=24, times=3):
    """Every maximal stretch per period, without those whose period is not the smallest."""
    found = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and not any(q % p == 0 and s <= i and j + q <= e for s, e, p in found):
                found.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted((s, e - s, q) for s, e, q in found)


def random_text(rng):
    w = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 4)):
        p = rng.randint(1, 14)
        block = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghijkl") for _ in range(p)]
        w += (block * rng.randint(1, 40))[:rng.randint(0, 8 * p)]
        if rng.random() < 0.4:
            w = w * rng.randint(1, 4)
        w += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 10))]
    return w[:900]


@pytest.mark.parametrize("least,times", [(24, 3), (3, 3), (10, 4)])
def test_runs_match_brute_force(least, times):
    rng = random.Random(least)
    texts = [random_text(rng) for _ in range(150)] + [["a"] * 700, list("ab") * 300, [], ["x"], list("aab") * 100 + list("aabaab") * 9]
    for batch in (texts[i::5] for i in range(5)):        # several documents share a grammar
        flat = [w for t in batch for w in t]
        ids = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        doc = np.repeat(np.arange(len(batch)), [len(t) for t in batch])
        start, end, period = periodic_runs.runs(np.array([ids[w] for w in flat], np.int64), doc, least, times)
        got = [[] for _ in batch]
        edges = np.append(0, np.cumsum([len(t) for t in batch]))
        for s, e, q in zip(start, end, period):
            d = int(doc[s])
            got[d].append((int(s - edges[d]), int(e - s), int(q)))
        assert [sorted(g) for g in got] == [brute_runs(t, least, times) for t in batch]


def test_grammar_derives_its_text():
    rng = random.Random(1)
    words = np.array([rng.randint(0, 5) for _ in range(3000)] * 2 + [7] * 500, np.int64)
    doc = np.sort(np.array([rng.randint(0, 9) for _ in words]))
    g = periodic_runs.Grammar(words, doc)

    def derive(s):
        return [s] if s < g.terminals else derive(int(g.left[s - g.terminals])) + derive(int(g.right[s - g.terminals]))

    assert len(g.seq) == len(set(doc))
    assert [w for s in g.seq for w in derive(int(s))] == words.tolist()
    assert all(words[a:a + n].tolist() == derive(g.terminals + i)
               for i, (a, n) in enumerate(zip(g.at, g.length[g.terminals:])) if n < 50)


def expected(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_query_on_the_whole_table(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, SF001).collect()
    assert sorted(map(tuple, got)) == sorted(expected(r.doc_id, r.text) for r in docs)


def test_odd_texts(spark):
    rng = random.Random(3)
    long = " ".join(random_text(rng)) + " z" * 40_000
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a b " * 30), (5, "x y x\x1cy " * 12), (6, long),
            (7, "é à " * 20), (7, "é à " * 20), (8, "one"), (9, "  a  b\n" * 40)]
    docs = spark.createDataFrame([(i, t, "s", 3) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    got = periodic_runs.find_runs(docs).collect()
    assert [(r.doc_id, r.n_words) for r in got] == [(i, len(re.findall("[^\x20\x09-\x0D]+", t or ""))) for i, t in rows]
    for r, (i, t) in zip(got, rows):
        if i != 6:
            assert [tuple(x) for x in r.runs] == brute_runs(re.findall("[^\x20\x09-\x0D]+", t or ""))
    assert (got[5].runs[-1].length, got[5].runs[-1].period) == (40_000, 1) and got[5].collapsed.endswith(" z")
    assert got[0].collapsed == "" and got[3].collapsed == "a b" and got[6] == got[7]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
