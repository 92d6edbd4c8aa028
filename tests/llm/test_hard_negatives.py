"""Hard negatives and decontamination against brute force, on odd tables.
The registered queries are held against SQL in tests/test_contract.py."""

import math
import random
import re

import numpy as np
import pytest

from eventide.llm import decontamination, hard_negatives


def brute_mine(rows, every, k, percent, scale):
    ok = {(i, y, tuple(math.floor(scale * x) for x in v)) for i, v, y in rows
          if None not in (i, v, y) and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for anchor in sorted({i for i, _, _ in ok if i % every == 0}):
        near, far = {}, {}
        for i, y, v in (r for r in ok if r[0] == anchor):
            for j, z, w in ok:
                if j != anchor and len(v) == len(w):
                    s = sum(a * b for a, b in zip(v, w))
                    if y == z:
                        near[j] = max(s, near.get(j, s))
                    else:
                        far.setdefault(j, set()).add(s)
        for p, top in sorted(near.items(), key=lambda x: (-x[1], x[0]))[:k]:
            found = {j: max(s for s in ss if percent * top <= 100 * s <= 100 * top) for j, ss in far.items()
                     if any(percent * top <= 100 * s <= 100 * top for s in ss)}
            for n, (j, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
                out.append((anchor, p, n, j, top, s))
    return sorted(out)


@pytest.mark.parametrize("size,block", [(40, 3), (1000, 100)])
def test_hard_negatives_match_brute_force(spark, size, block):
    rng = random.Random(size)
    one = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in one], rng.randint(0, 2)) for i in range(400)]
    rows += [(1000 + i, one, i % 2) for i in range(60)]                          # one vector of many rows: ties
    rows += [(10, rows[11][1], 1), (10, rows[11][1], 1), (500, one, None), (501, None, 1), (None, one, 1), (502, [], 1),
             (503, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (504, [float("nan")] * 6, 1), (505, [float("inf")] * 6, 0),
             (510, [1.0, 2.0], 0), (520, [1.0, 2.5], 0), (530, [0.9, 2.0], 1), (540, [-x for x in one], 1)]
    table = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows],
                                  "vec_id long, embedding array<double>, label int, rank string, v int")
    got = hard_negatives.mine(table, every=10, k=5, percent=80, scale=256, shard_vectors=size, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_mine(rows, 10, 5, 80, 256)
    assert hard_negatives.mine(table.limit(0)).count() == 0


def test_tree_boxes_and_tiles():
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(0, 100, (777, 9)))
    order, starts = hard_negatives.str_order(v, 32)
    assert sorted(order) == list(range(777)) and max(np.diff([*starts, 777])) <= 32
    tree = hard_negatives.Tree(v, [[i] for i in range(777)])
    q = np.floor(rng.normal(0, 100, 9))
    lower, upper = tree.intervals(q)

    def rows(at):
        s, e, leaf = tree.nodes[at]
        return list(range(s, e)) if leaf else [r for c in range(s, e) for r in rows(c)]

    for at in range(len(tree.nodes)):
        scores = tree.v[rows(at)] @ q
        assert lower[at] <= scores.min() and scores.max() <= upper[at]
    assert sorted(rows(len(tree.nodes) - 1)) == list(range(777))
    huge = hard_negatives.Tree(v * 1e12, [[i] for i in range(777)])            # beyond whole doubles: exact integers
    want = sorted((-sum(int(a) * int(b) for a, b in zip(r, q * 1e12)), i) for i, r in enumerate(v * 1e12))[:5]
    assert sorted((-s, i) for s, i in huge.best(q * 1e12, -1, 5, [(None, None)])[0]) == want


def brute_contamination(docs, items, window):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))

    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[s:s + window]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    named |= windows[tuple(w[s:s + n])] - {None}
        out.append((d, len(w), len(hit), len(named), tuple(sorted(map(str, named))), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_decontamination_matches_brute_force(spark, broadcast_rows):
    rng = random.Random(4)
    text = lambda n, v="abcdefghij": " ".join(rng.choice(v) for _ in range(n))
    items = [(i, text(rng.randint(1, 25))) for i in range(30)] + [(3, "Zebra quagga"), (3, "zebra-quagga"), (40, "ÉTÉ Été x9"),
             (41, None), (42, " .. "), (None, "one two three four five six seven eight nine ten eleven"), (43, "a a a a a a a a a a a a")]
    long = text(30_000)
    docs = [(i, text(rng.randint(0, 80), "abcdefghijklm")) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!!"), (103, long), (104, "ZEBRA.quagga"), (104, "ZEBRA.quagga"), (None, "zebra quagga zebra"),
             (105, "Été ÉTÉ Été x9"), (106, "ÉTÉ Été x9"), (107, "zero " + items[-2][1].upper()), (108, "a " * 11 + "b " + "A " * 30),
             (109, items[0][1] + " " + items[1][1]), (110, "zebra zebra"), (111, "eleven ten nine")]
    d = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, w string, row int")
    b = spark.createDataFrame([(i, t, "s", 1) for i, t in items], "item_id long, text string, words string, wid int")
    got = decontamination.decontaminate(d, b, broadcast_rows=broadcast_rows).select(
        "doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    assert sorted(((*r[:4], tuple(r.items), r.contaminated) for r in got), key=str) == brute_contamination(docs, items, 10)
    clean = decontamination.decontaminate(d, b.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)
    assert decontamination.decontaminate(d.limit(0), b).count() == 0
