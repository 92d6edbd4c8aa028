"""Registered queries of the training-data operators."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from eventide.llm import (chat, decontamination, graph_search, hard_negatives, kd_search, lm_mixing, packing,
                          periodic_runs, pii, simhash, toxicity)
from eventide.llm.bpe_lexicon import encode_decode
from eventide.llm.common import in_fold, read_table
from eventide.llm.token_counts import token_counts


def op1_graph_search(spark, sf_dir):
    return graph_search.nearest_by_cosine(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), k=4, max_bits=4, seed=42)


def op3_kd_search(spark, sf_dir):
    return kd_search.top_by_product(read_table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op4_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"), limit=512).drop("fit_chars")


def op5_best_fit_packing(spark, sf_dir):
    return packing.best_fit(read_table(spark, sf_dir, "documents"))


def op6_bpe_lexicon(spark, sf_dir):
    return encode_decode(read_table(spark, sf_dir, "documents"))


def op7_context_mixing(spark, sf_dir):
    return lm_mixing.score(read_table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, with_spans=True)


def op9_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    held_out = in_fold(toxicity.F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_chat_formatting(spark, sf_dir):
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op11_hard_negatives(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", shifted), every=100, k=5,
                               percent=80, scale=256)


def every_tenth_periodic(doc_ids: list, edges: np.ndarray) -> np.ndarray:
    """The word that each word becomes: one document in ten, by a hash of its id, is periodic from some word on."""
    place = np.arange(edges[-1])
    for doc_id, start, stop in zip(doc_ids, edges, edges[1:]):
        h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), int(stop - start)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            place[start + a:stop] = start + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return place


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(read_table(spark, sf_dir, "documents"), min_words=24, min_exponent=3,
                                    rewrite=every_tenth_periodic)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", periodic_runs.most_repeated(F.col("runs")))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
                       F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_decontamination(spark, sf_dir):
    found = decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        "contaminated")


QUERIES = {f.__name__: f for f in (op1_graph_search, op2_simhash, op3_kd_search, op4_token_counts,
                                   op5_best_fit_packing, op6_bpe_lexicon, op7_context_mixing, op8_pii_surrogates,
                                   op9_toxicity, op10_chat_formatting, op11_hard_negatives,
                                   op12_periodic_runs, op13_decontamination)}
# Exact top-k by brute force, and maximal conversations by whole turn lists.
ORACLES: dict[str, str] = {
    "op3_kd_search": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.e, c.e) AS BIGINT)) AS score
  FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
""",
    "op10_chat_formatting": chat.FORMAT_SQL,
    "op11_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL,
    "op13_decontamination": decontamination.DECONTAMINATION_SQL,
}
