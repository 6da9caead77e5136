"""Mixing of sources to target weights, without Python: budgets by water filling, cuts by prefix sums.

Every document gets a hash-random key. The documents are range-sorted by source and key, so that a source of
any size lies in many slices; sums of slices give the words before each slice, a running sum inside the slice
the words before each document. What a source's budget holds of whole epochs is taken of every document, the
rest in the order of the keys up to the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ranking import ranked
from ..session import cut_lineage
from .common import register, table

WEIGHTS, MOST_EPOCHS = (1, 2, 3), 3
WORD = r"[^\x20\x09-\x0D]+"
#: Slices of sources (fixed-width rows but for the source's name) up to which, and bytes of names up to which,
#: their table is sent to every task; beyond, it is joined by a shuffle.
BROADCAST_SLICES, BROADCAST_NAME_BYTES = 200_000, 16_000_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def source_budgets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target, budget (whole words) for ``sizes`` (source, source_size; one row per source).

    Sources in code point order, null last, have the weights in turn and share the sum of all sizes by them;
    what a source would get beyond ``most`` times its size is shared by the others, until none is beyond.
    """
    ordered = sizes.withColumn("_last", F.col("source").isNull())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("n") - 1) % len(weights) + 1).cast("int")).cast("long")
    weighed = cut_lineage(ranked(ordered, [], ["_last", "source"], "n").select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit")))
    total, whole = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    left, share, before = total or 0, whole or 1, None
    while True:  # the level left / share only rises; a few rounds settle it
        full = _exact("limit") * F.lit(share).cast("decimal(19,0)") < F.lit(left).cast("decimal(19,0)") * _exact("weight")
        taken, open_weight, n_full = weighed.agg(
            F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if n_full == before or not open_weight:
            break
        left, share, before = (total or 0) - (taken or 0), open_weight, n_full
    part = F.lit(left).cast("long") * F.col("weight")
    return weighed.select(
        "source", "source_size",
        F.when(full, F.col("limit").cast("double")).otherwise(part.cast("double") / F.lit(share)).alias("target"),
        F.when(full, F.col("limit")).otherwise(F.floor(part.cast("decimal(38,0)") / F.lit(share))).cast("long").alias("budget"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "0") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source).

    ``taken``: words that the mix takes of the row, repeats counted; those of a source sum to the whole words of
    its target. A null or empty text has size 0 and gives nothing. The order inside a source comes from md5 of
    the doc_id and ``seed`` (then doc_id and size), so reruns agree; repeated rows each take a place. A null
    source is one source, a null doc_id hashes as an empty one. An empty table gives no rows; other columns
    are ignored.
    """
    key = F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))), 1, 16)
    sized = cut_lineage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), key.alias("key")))
    budgets = source_budgets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    # written out, because a retried range partitioning could cut elsewhere
    sliced = cut_lineage(sized.repartitionByRange("source", "key", "doc_id", "size").withColumn("slice", F.spark_partition_id()))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("s").join(
        budgets.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source"))).select(
        F.col("s.source").alias("of"), F.col("slice").alias("in_slice"), "before", "source_size", "target",
        F.expr("coalesce(budget div nullif(source_size, 0), 0)").alias("epochs"),
        F.expr("coalesce(budget % nullif(source_size, 0), 0)").alias("rest"))
    starts = cut_lineage(starts)
    n, name_bytes = starts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("of")), F.lit(0))).first()
    if n <= BROADCAST_SLICES and name_bytes <= BROADCAST_NAME_BYTES:
        starts = F.broadcast(starts)
    here = W.partitionBy("slice", "source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.col("before") + F.col("upto") - F.col("size")
    return (
        sliced.withColumn("upto", F.sum("size").over(here))
        .join(starts, (F.col("slice") == F.col("in_slice")) & F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "source_size", "target", (
            F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - place))).cast("long").alias("taken"))
    )


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '') || ':0'), 1, 16) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size,
    (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1 AS w FROM d GROUP BY source),
t AS (SELECT sum(size) AS total, sum(w) AS weight FROM s),
c AS (SELECT s.*, {MOST_EPOCHS} * size AS cap, total,
    sum({MOST_EPOCHS} * size) OVER o AS caps, weight - sum(w) OVER o AS rest_w, total - sum({MOST_EPOCHS} * size) OVER o AS rest
    FROM s, t WINDOW o AS (ORDER BY size::DOUBLE / w, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
p AS (SELECT total AS rest, weight AS w FROM t UNION ALL SELECT rest, rest_w FROM c WHERE rest_w > 0),
l AS (SELECT rest, w FROM p WHERE p.rest = (SELECT max(total) FROM c) - coalesce((SELECT sum(cap) FROM c WHERE cap * p.w < p.rest * c.w), 0)
    AND p.w = coalesce((SELECT sum(c.w) FROM c WHERE cap * p.w >= p.rest * c.w), 0) LIMIT 1),
b AS (SELECT c.source, c.size, CASE WHEN cap * l.w < l.rest * c.w THEN cap::DOUBLE ELSE (l.rest * c.w)::DOUBLE / l.w::DOUBLE END AS target,
    (CASE WHEN cap * l.w < l.rest * c.w THEN cap ELSE (l.rest * c.w) // l.w END)::BIGINT AS budget FROM c, l),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d)
SELECT o.doc_id, o.size, b.size AS source_size, b.target, (CASE WHEN b.size = 0 THEN 0 ELSE
    (b.budget // b.size) * o.size + greatest(0, least(o.size, b.budget % b.size - o.before)) END)::BIGINT AS taken
FROM o JOIN b ON o.source IS NOT DISTINCT FROM b.source
"""


@register("op12_source_mix", sql=SQL)
def op12_source_mix(spark, folder):
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
