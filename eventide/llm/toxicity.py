"""Toxicity by maximum-scoring segments.

Each token has a log-odds score: how much likelier it is in toxic than in
clean text, with a Dirichlet prior that pulls rare words to the overall rate,
less a drift that makes ordinary text negative.  A linear scan finds all
maximal scoring segments of a text; extreme-value statistics turn a segment's
score into the chance that clean text of that length has one as good, and the
chances of all segments together into the score of the document.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import in_fold, map_batches, materialize

SAMPLE_DOCS = 20_000       # labelled documents that the scores are fitted on, about, at most
MIN_DOCS = 4               # words in fewer of them have the score of ordinary text
PRIOR = 40.0               # documents that the prior counts for
DRIFT = 0.5
FOLDS, HELD_OUT = 5, 0
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class ToxicModel:
    """Scores of the words that can begin a segment (all others have
    ``-drift``), the extreme-value parameters and the calibration."""

    scores: dict[str, float]
    drift: float
    lam: float
    log_k: float
    slope: float
    offset: float


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def segments(scores: list[tuple[int, float]], n: int, drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last + 1) of ``n`` tokens,
    in linear time: ``scores`` are the positive ones by position, every other
    token has ``-drift``.

    A stack of candidates holds the sums before and through each.  A new
    positive token joins back to the nearest candidate with a smaller sum
    before it, as long as that one's sum through is smaller than its own.
    """
    found: list[list] = []           # [sum before, sum through, first, last + 1, nearest candidate with a smaller sum before]
    total, at = 0.0, 0
    for position, score in scores:
        total -= drift * (position - at)
        one = [total, total + score, position, position + 1, -1]
        total, at = one[1], position + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= one[0]:
                j = found[j][4]
            one[4] = j
            if j < 0 or found[j][1] >= one[1]:
                found.append(one)
                break
            one = [found[j][0], one[1], found[j][2], one[3], found[j][4]]
            del found[j:]
    return [(r - l, s, e) for l, r, s, e, _ in found]


def evidence(model_scores: dict[str, float], drift: float, words: list[str]) -> tuple[list, int]:
    hits = [(i, s) for i, s in enumerate(map(model_scores.get, words)) if s is not None]
    return segments(hits, len(words), drift), len(words)


def sum_statistic(found: list, n: int, lam: float, log_k: float) -> float:
    """Minus log10 of the chance that clean text of ``n`` tokens has segments
    as good as these.  Segments whose own chance is under one half count; the
    best scores of r segments together follow the sum statistic
    exp(-T) T^(r-1) / (r! (r-1)!), of which the least over r is taken."""
    if not found or not n:
        return 0.0
    base = math.log(max(n, 1)) + log_k
    best, total = 0.0, 0.0
    for r, score in enumerate(sorted((f[0] for f in found), reverse=True), 1):
        normal = lam * score - base
        if r > 1 and normal <= 0.4:
            break
        total += normal
        if r == 1:
            p = -math.expm1(-math.exp(-normal))
            value = -math.log10(max(p, 1e-300))
        else:
            if total <= 0:
                break
            value = (total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)) / math.log(10)
        best = max(best, value)
    return min(best, 60.0)


def _karlin(pairs: list[tuple[float, float]]) -> float:
    """The positive lambda with sum(p * exp(lambda * s)) = 1, by bisection."""
    total = sum(p for _, p in pairs)
    f = lambda x: sum(p / total * math.exp(min(700.0, x * s)) for s, p in pairs) - 1
    low, high = 1e-6, 1.0
    while f(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps with a small ridge; the slope is never negative."""
    if len(x) == 0 or y.min() == y.max():
        rate = min(max(float(y.mean()) if len(y) else 0.0, 0.01), 0.99)
        return 1.0, math.log(rate / (1 - rate)) - (0.0 if len(x) == 0 else float(x.mean()))
    w = np.array([0.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-3 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(text, toxic) of labelled training documents: all, or a sample by id
    hash of about ``sample_docs`` if there are more.  Several labels of an id
    count as toxic if one is; rows without id, text or label are left out."""
    own = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    own = own.where(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    n = own.count()
    if n > sample_docs:
        own = own.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000))
                        < F.lit(int(1_000_000 * sample_docs / n)))
    # About ``sample_docs`` short rows: a proven bound.
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(own), "doc_id") \
               .select("text", F.col("_toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> ToxicModel:
    """Word scores, extreme-value parameters and calibration from the labelled
    training documents; whole texts are read."""
    rows = materialize(training_rows(docs, labels, sample_docs), "toxicity-sample")

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        out_w, out_t = [], []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = set(tokens(text))
            out_w += own
            out_t += [toxic] * len(own)
        return pa.RecordBatch.from_arrays([pa.array(out_w, pa.string()), pa.array(out_t, pa.int32())], names=["w", "t"])

    n_toxic, n_docs = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not n_toxic or n_toxic == n_docs:
        rate = (n_toxic + 1) / (n_docs + 2) if n_docs else 0.1
        return ToxicModel({}, DRIFT, 1.0, 0.0, 1.0, math.log(rate / (1 - rate)) if rate < 1 else 5.0)
    pi = n_toxic / n_docs
    odds = math.log(pi / (1 - pi))
    seen = (map_batches(rows, words, "w string, t int").groupBy("w")
            .agg(F.sum("t").alias("tox"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS))
    p = (F.col("tox") + F.lit(PRIOR * pi)) / (F.col("n") + F.lit(PRIOR))
    seen = seen.withColumn("s", F.log(p / (1 - p)) - F.lit(odds) - F.lit(DRIFT))
    # Only words that raise the odds are kept: a few of the words of the bounded sample.
    scores = {r["w"]: r["s"] for r in seen.where("s > 0").select("w", "s").collect()}

    def background(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits, total = {}, 0
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not toxic:
                own = tokens(text)
                total += len(own)
                for w in own:
                    if w in scores:
                        hits[w] = hits.get(w, 0) + 1
        return pa.RecordBatch.from_arrays([pa.array([*hits, ""], pa.string()),
                                           pa.array([*hits.values(), total], pa.int64())], names=["w", "n"])

    counts = {r["w"]: r["n"] for r in map_batches(rows, background, "w string, n long")
              .groupBy("w").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop("", 0)
    pairs = [(scores[w], n) for w, n in counts.items()] + [(-DRIFT, max(1, total - sum(counts.values())))]
    lam = min(_karlin(pairs), 4.0) if counts else 1.0
    # K: clean tokens begin a segment as often as a scoring word occurs.
    log_k = math.log(max(1, sum(counts.values())) / max(1, total))

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [sum_statistic(*evidence(scores, DRIFT, tokens(t)), lam, log_k) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], names=["x", "y"])

    # A histogram of the statistic in steps of 0.05: at most some thousand rows.
    bins = (map_batches(rows, measured, "x double, y int").groupBy(F.round(F.col("x") * 20).alias("b"), "y")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    slope, offset = _calibrate(np.repeat([r["b"] / 20 for r in bins], [r["n"] for r in bins]).astype(float),
                               np.repeat([r["y"] for r in bins], [r["n"] for r in bins]).astype(float))
    return ToxicModel(scores, DRIFT, lam, log_k, slope, offset)


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, or with more underscores in front if ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def score(docs: DataFrame, model: ToxicModel, with_passages: bool = False) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` of each whole text;
    a null or empty text has no segments.  ``with_passages`` adds the
    significant ones: first token, token after the last, minus log10 of the
    chance.  Rows, null ids and extra columns are passed through; an input
    column named like a result is replaced by it, any other stays."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)     # words of the bounded sample
    passages = "array<struct<first:int,after:int,evidence:double>>"
    results = ["score", "predicted", *(["passages"] if with_passages else [])]
    names = [c for c in docs.columns if c.lower() not in results]
    text, value, spans_ = (fresh_name(docs, n) for n in ("_text", "_score", "_passages"))
    schema = f"`{value}` double" + (f", `{spans_}` {passages}" if with_passages else "")
    keep = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col("text"), F.lit("")).alias(text))
    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema[:-1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        scores, spans = [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            found, n = evidence(m.scores, m.drift, tokens(text))
            x = m.slope * sum_statistic(found, n, m.lam, m.log_k) + m.offset
            scores.append(1 / (1 + math.exp(-max(-60.0, min(60.0, x)))))
            if with_passages:
                single = [(s, e, sum_statistic([(v, s, e)], n, m.lam, m.log_k)) for v, s, e in found]
                spans.append([{"first": s, "after": e, "evidence": x} for s, e, x in single if x > 0.3])
        cols = [*batch.columns[:-1], pa.array(scores, pa.float64())]
        if with_passages:
            cols.append(pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32()),
                                                            ("evidence", pa.float64())]))))
        return pa.RecordBatch.from_arrays(cols, names=[*names, value, *([spans_] if with_passages else [])])

    out = map_batches(keep, run, f"{full}, {schema}")
    return out.select(*[F.col(f"`{c}`") for c in names], F.col(value).alias("score"),
                      (F.col(value) >= 0.5).cast("int").alias("predicted"),
                      *([F.col(spans_).alias("passages")] if with_passages else []))


def reject(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` without those predicted toxic, with their own columns whatever
    their names; null and empty texts stay."""
    scored = {c: fresh_name(docs, "_" + c) for c in docs.columns if c.lower() in ("score", "predicted")}
    kept = score(docs.withColumnsRenamed(scored), model).where("predicted = 0").drop("score", "predicted")
    return kept.withColumnsRenamed({new: old for old, new in scored.items()}).select(
        *[F.col(f"`{c}`") for c in docs.columns])
