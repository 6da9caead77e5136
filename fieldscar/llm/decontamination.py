"""Benchmark decontamination by a prefix-filtered set join. DataFrame functions only.

A benchmark item is cut into windows of consecutive words, a window into overlapping shingles. To
contain a window a text must contain all its shingles, so the necessary prefix in the order of rarity is
one: its rarest. Documents meet windows by that shingle; length and position bounds drop the starts
that cannot hold the window, and the shingles around each start are compared one by one.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut_lineage
from .common import broadcast_if, register, table

WINDOW_WORDS, SHINGLE_WORDS = 10, 4
#: What parts words, in lower-cased text; splitting at it is much faster than extracting words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a benchmark side up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lower, BETWEEN_WORDS), ""), F.array().cast("array<string>"))


def _shingles(w: Column, k: int) -> Column:
    """Hash of every k consecutive words, in order."""
    at = lambda i: F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)])
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), at)).otherwise(
        F.array().cast("array<bigint>"))


def windows_of(items: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: wid, m words, k words per shingle, hashes; wid with each of its items)."""
    w = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    cut = cut_lineage(w.select("item_id", size.alias("m"), F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - size), lambda i: F.slice("w", i + 1, size))).alias("w")))
    ks = range(1, shingle + 1)
    hashes = F.coalesce(*[F.when(F.least("m", F.lit(shingle)) == k, _shingles(F.col("w"), k)) for k in ks])
    hashed = cut_lineage(cut.select(
        "item_id", "m", F.least("m", F.lit(shingle)).alias("k"), hashes.alias("hashes"), F.sha2(F.concat_ws(" ", "w"), 256).alias("wid")))
    return hashed.dropDuplicates(["wid"]).select("wid", "m", "k", "hashes"), hashed.select("wid", "item_id").distinct()


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS):
    """(documents: row, doc_id, n_words; occurrences: row, start, m, wid; wid with its items).

    ``row`` tells repeated doc_ids apart. Documents are read once; what is kept of them are the
    places of benchmark shingles.
    """
    wins, of_items = windows_of(items, window, shingle)
    ks = sorted(r[0] for r in wins.select("k").distinct().collect())  # at most ``shingle`` values
    known = wins.select("k", F.explode("hashes").alias("hash")).distinct()
    place = lambda k: F.transform(
        _shingles(F.col("w"), k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), h.alias("hash")))
    marker = F.array(F.struct(F.lit(0).alias("k"), F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("hash")))
    stream = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w")).select(
        "row", "doc_id", F.size("w").cast("long").alias("n_words"), F.inline(F.concat(marker, *[place(k) for k in ks])))
    met = cut_lineage(
        stream.join(broadcast_if(known.withColumn("known", F.lit(True)), BROADCAST_ROWS), ["k", "hash"], "left")
        .filter("known or pos < 0").drop("known"))
    texts = met.filter("pos < 0").select("row", "doc_id", "n_words")
    hits = met.filter("pos >= 0").select("row", "n_words", "k", "pos", "hash")

    rarity = hits.groupBy("k", "hash").agg(F.count("*").alias("df"))
    # necessary prefix: the rarest shingle of a window; windows with a shingle that never occurs drop out
    prefix = (
        wins.select("wid", "m", "k", "hashes", F.posexplode("hashes").alias("offset", "hash")).join(rarity, ["k", "hash"])
        .groupBy("wid").agg(F.count("*").alias("n"), F.first("m").alias("m"), F.first("hashes").alias("hashes"), F.first("k").alias("k"),
                            F.min(F.struct("df", "hash", "offset")).alias("rarest"))
        .filter(F.col("n") == F.size("hashes"))
        .select("wid", "m", "k", "hashes", "rarest.hash", "rarest.offset"))
    reach = window - min(ks, default=1)
    around = W.partitionBy("row", "k").orderBy("pos").rangeBetween(-reach, reach)
    near = hits.withColumn("near", F.collect_list(F.struct("pos", "hash")).over(around))
    start = F.col("pos") - F.col("offset")
    inside = F.filter("near", lambda x: (x["pos"] >= start) & (x["pos"] <= start + F.col("m") - F.col("k")))
    found = (
        near.join(broadcast_if(cut_lineage(prefix), BROADCAST_ROWS), ["k", "hash"])
        .filter((start >= 0) & (start + F.col("m") <= F.col("n_words")))
        .filter(F.transform(F.array_sort(inside), lambda x: x["hash"]) == F.col("hashes"))
        .select("row", start.alias("start"), "m", "wid"))
    return texts, cut_lineage(found), of_items


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``items``: item_id, text. Null texts have no words, and items without words no windows; equal
    windows of several items count for each; repeated rows each give a row; without items nothing is
    contaminated. Hashes of 64 bits stand for shingles: a false hit needs equal hashes of every
    shingle of a window.
    """
    texts, found, of_items = occurrences(docs, items, window, shingle)
    before = F.max(F.col("start") + F.col("m")).over(
        W.partitionBy("row").orderBy("start", "m").rowsBetween(W.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("start") + F.col("m") - F.greatest("start", F.coalesce(before, F.lit(0))))
    n_hit = found.select("row", "start", "m").distinct().withColumn("new", new).groupBy("row").agg(F.sum("new").alias("n_hit"))
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    per_row = (
        found.select("row", "wid").distinct().join(broadcast_if(of_items, BROADCAST_ROWS), "wid")
        .groupBy("row").agg(ids.alias("ids")))
    return texts.join(n_hit, "row", "left").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


_WORDS_SQL = (r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])")
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
i AS (SELECT item_id, least(len(w), {WINDOW_WORDS}) AS m, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, unnest([array_to_string(w[p + 1 : p + m], ' ') FOR p IN range(len(w) - m + 1)]) AS t FROM i),
ms AS (SELECT DISTINCT m FROM i),
dw AS (SELECT doc_id, m, unnest(range(len(w) - m + 1)) AS p,
              unnest([array_to_string(w[p + 1 : p + m], ' ') FOR p IN range(len(w) - m + 1)]) AS t FROM d, ms WHERE len(w) >= m),
o AS (SELECT doc_id, p, dw.m, item_id FROM dw JOIN win ON dw.m = win.m AND dw.t = win.t),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS x FROM o) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM o) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@register("op2_decontamination", sql=SQL)
def op2_decontamination(spark, folder):
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
