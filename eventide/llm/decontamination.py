"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows (``window`` consecutive words) are the sets to be contained.
The shingles of a window are ordered by rarity: a shingle is as rare as its
rarest word, counted over all documents; ties are ordered by hash.  Containment
must be whole, so the necessary prefix of a window is its one rarest shingle:
where that shingle does not occur, the window does not.  The documents' shingles
are joined with these prefix shingles alone.  A match at a position fixes where
the window would begin; the bounds of position (not before the text) and length
(not beyond it) apply, and the words there are compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize

WINDOW = 10
SHINGLE = 5
# A side is broadcast only if it is counted to have at most so many rows and bytes of words.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_CASED_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; the cheap way where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The lower-cased words of ``text``: runs of digits, letters and whatever is not ASCII; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def item_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words): the distinct windows of each item; an item of fewer
    words, but not none, is one window."""
    listed = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return listed.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words")).distinct()


def is_small(df: DataFrame, held: Column, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and BROADCAST_BYTES bytes in ``held``."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(held), F.lit(0))).first()
    return n <= max_rows and size <= BROADCAST_BYTES


def word_counts(text: DataFrame, vocabulary: DataFrame, max_rows: int) -> DataFrame:
    """(word, n): how often each word of ``vocabulary`` (word) occurs in all of ``text`` (text)."""
    split = F.split(F.coalesce("text", F.lit("")), NOT_CASED_WORD)
    each = text.select(F.explode_outer(split).alias("raw"))
    if is_small(vocabulary, F.octet_length("word"), max_rows):
        found = each.select(lower_ascii(F.col("raw")).alias("word")).join(F.broadcast(vocabulary), "word", "left_semi")
        return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = each.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    return (counted.groupBy(lower_ascii(F.col("raw")).alias("word")).agg(F.sum("n").alias("n"))
                   .join(vocabulary, "word", "left_semi"))


def prefixes(windows: DataFrame, counts: DataFrame, shingle: int) -> DataFrame:
    """(wid, words, token, lead, size): the rarest shingle of each window as a
    hash, with the number of words before it and its own number of words.
    Windows with a word that no document holds cannot occur and are left out."""
    known = (windows.select("wid", F.posexplode("words").alias("at", "word")).join(counts, "word", "left")
                    .groupBy("wid").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))).alias("c")))
    size = F.least(F.size("words"), F.lit(shingle))
    rank = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda o: F.struct(
        F.array_min(F.transform(F.slice("c", o + 1, F.col("size")), lambda x: x["n"])).alias("n"),
        token_of([F.get(F.col("words"), o + k) for k in range(shingle)], F.col("size")).alias("token"), o.alias("lead")))
    return (windows.join(known, "wid").withColumn("size", size).withColumn("first", F.array_min(rank))
                   .where(F.forall("c", lambda x: x["n"] > 0))
                   .select("wid", "words", F.col("first.token").alias("token"), F.col("first.lead").alias("lead"), "size"))


def token_of(shingle: list[Column], size) -> Column:
    """Hash of the first ``size`` words of ``shingle``; hashes only propose, the words are compared later."""
    if isinstance(size, int):
        return F.xxhash64(F.lit(size), *shingle[:size])
    return F.xxhash64(size, *(F.when(F.lit(k) < size, w) for k, w in enumerate(shingle)))


def occurrences(docs: DataFrame, keep: DataFrame, sizes: list[int], window: int, small: bool) -> DataFrame:
    """(row, doc_id, n_words, at, token, context): each place of a document that
    holds a prefix shingle, with the words around it that a window could cover;
    and a row without token for each document, so that none is lost.  ``docs``
    has row, doc_id, text; ``keep`` the distinct prefix shingles (token)."""
    listed = docs.select("row", "doc_id", words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    each = listed.select("row", "doc_id", "n_words", "w", F.posexplode_outer("w").alias("at", "word"))
    hashes = [token_of([F.col("word"), *(F.get("w", F.col("at") + k) for k in range(1, s))], s) for s in sizes]
    each = each.withColumn("token", hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes)))
    around = lambda at: F.slice("w", F.greatest(at - window, F.lit(0)) + 1, 2 * window)
    marked = keep.select("token", F.lit(True).alias("is_prefix"))
    if small:
        # The words stay beside their document: nothing of the corpus is shuffled.
        return (each.join(F.broadcast(marked), "token", "left").where("is_prefix or at is null or at = 0")
                    .select("row", "doc_id", "n_words", "at", F.when(F.col("is_prefix"), F.col("token")).alias("token"),
                            F.when(F.col("is_prefix"), around(F.col("at"))).alias("context")))
    places = each.select("row", "at", "token").where("at is not null").join(marked, "token", "left_semi")
    places = places.groupBy("row").agg(F.collect_list(F.struct("at", "token")).alias("places"))
    found = listed.join(places, "row", "left").withColumn("place", F.explode_outer("places"))
    at = F.col("place.at")
    return found.select("row", "doc_id", "n_words", at.alias("at"), F.col("place.token").alias("token"),
                        F.when(at.isNotNull(), around(at)).alias("context"))


def contained(places: DataFrame, prefix: DataFrame, window: int) -> DataFrame:
    """(row, start, stop, wid): the windows that occur, at their words; bounds first, then the words themselves."""
    before = F.least(F.col("at"), F.lit(window))            # words of the context before the shingle
    start, n = F.col("at") - F.col("lead"), F.size("words")
    return (places.where("token is not null").join(prefix, "token")
                  .where((start >= 0) & (start + n <= F.col("n_words")))
                  .where(F.slice("context", before - F.col("lead") + 1, n) == F.col("words"))
                  .select("row", start.alias("start"), (start + n).alias("stop"), "wid").distinct())


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any
    occurrence of a window), n_items and items (ids of the items with occurring
    windows, sorted as strings), contaminated.

    Null and empty texts have no words and are clean; an item without words
    matches nothing; an item without id counts for n_hit but is not listed.
    Repeated documents are judged each; repeated items count once per id.
    Texts have no length limit.  Other columns of either table are not read.
    Empty tables give no rows, or clean rows.  Prefix shingles are broadcast if
    they are at most ``broadcast_rows``; beyond that they are joined by a shuffle.
    """
    docs = docs.select("doc_id", "text")
    linked = materialize(item_windows(items, window), "benchmark-windows")
    windows = materialize(linked.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "window-ids")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    prefix = materialize(prefixes(windows, word_counts(docs.select("text"), vocabulary, broadcast_rows), shingle), "window-prefixes")
    keep = prefix.select("token").distinct()
    sizes = sorted(r[0] for r in prefix.select("size").distinct().collect()) or [shingle]     # at most ``shingle`` numbers
    small = is_small(keep, F.lit(8), broadcast_rows)
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    if not small:                       # read twice below: the numbers must stay
        numbered = materialize(numbered, "numbered-documents")
    places = materialize(occurrences(numbered, keep, sizes, window, small), "window-places")

    width = F.aggregate("words", F.lit(0), lambda n, w: n + F.octet_length(w))
    hits = contained(places, F.broadcast(prefix) if is_small(prefix, width, broadcast_rows) else prefix, window)
    hits = materialize(hits, "window-hits")
    # Words covered: each window adds what lies beyond the furthest end before it.
    before = F.max("stop").over(Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.select("row", "start", "stop").distinct().withColumn("before", F.coalesce(before, F.lit(0)))
                   .groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "before"))).alias("n_hit")))
    named = linked.join(windows, "words").select("wid", "item_id").where("item_id is not null")
    named = F.broadcast(named) if is_small(named, F.lit(16), broadcast_rows) else named
    matched = (hits.select("row", "wid").distinct().join(named, "wid").select("row", F.col("item_id").cast("string").alias("item"))
                   .distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    rows = places.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").cast("long").alias("n_words"))
    return (rows.join(covered, "row", "left").join(matched, "row", "left")
                .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


# The same by brute force: every run of words as long as some window, joined on its text.
DECONTAMINATION_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + 9], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM docs CROSS JOIN (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
hits AS (SELECT p.r, p.m, p.i, x.item_id FROM places p JOIN windows x ON p.m = x.m AND p.t = x.t),
covered AS (
  SELECT r, count(DISTINCT k) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS k FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_items, sha256(coalesce(k.s, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named k ON k.r = d.r
"""
