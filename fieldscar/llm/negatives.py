"""Hard negatives by exact integer scores: Strassen products of anchor and candidate tiles, and mergeable heaps.

Vectors become integers, so every score is exact and ties are real ties. Anchors go in chunks of bounded bytes to
all tasks; a task streams its candidates past them in tiles, multiplies by Strassen's recursion, and keeps two
kinds of heaps: the best positives of an anchor, and (in a second pass, when the positives are known) the best
negatives in the window of scores that each positive sets. Heaps of tasks merge into those of all rows, so no
score is ever stored or shuffled but those that a heap holds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .common import Scratch, register, shared_folder, table

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
#: A component x becomes floor(SCALE x).
SCALE = 256
#: Bytes of anchors (vectors as integers) that are sent to the tasks at a time.
CHUNK_BYTES = 32_000_000
ANCHOR_TILE, CANDIDATE_TILE = 256, 512
#: Side at which the recursion ends.
LEAF = 16

_LEAST = np.iinfo(np.int64).min  # stands for an empty place of a heap; scores are greater


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b by Strassen's seven products; odd sides are padded with zeros.

    On int64 the additions wrap modulo 2^64, which leaves the product exact if its entries fit.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    c = np.empty((2 * h, 2 * j), dtype=p1.dtype)
    c[:h, :j] = p1 + p4 - p5 + p7
    c[:h, j:] = p3 + p5
    c[h:, :j] = p2 + p4
    c[h:, j:] = p1 - p2 + p3 + p6
    return c[:m, :n]


def _floor(x: float) -> int:
    return math.floor(SCALE * x) if abs(x) < 1e300 else SCALE * int(x)


def whole_vectors(lists: pa.Array) -> np.ndarray:
    """floor(SCALE x) of the components, a row per vector, shorter vectors filled with zeros: int64, or Python
    integers if a component is 2^62 or more."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten()).astype(np.float64)
    scaled = np.floor(flat * SCALE) if len(flat) == 0 or np.abs(flat).max() < 2.0 ** 54 else None
    values = scaled.astype(np.int64) if scaled is not None else np.array([_floor(v) for v in flat.tolist()], dtype=object)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=values.dtype)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = values
    return out


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` as int64; those beyond 64 bits count as the nearest such number."""
    k = min(a.shape[1], b.shape[1])  # what one of the vectors lacks is zero
    a, b = a[:, :k], b[:, :k].T
    if a.size and b.size and _largest(a) * _largest(b) * k >= 1 << 63:
        exact = strassen(a.astype(object), b.astype(object))
        return np.clip(exact, int(_LEAST) + 1, (1 << 63) - 1).astype(np.int64)
    return strassen(a.astype(np.int64), b.astype(np.int64))


class Heaps:
    """The first ``k`` (score, id) of every row: higher scores first, ties by smaller id."""

    def __init__(self, rows: int, k: int):
        self.score = np.full((rows, k), _LEAST, dtype=np.int64)
        self.id = np.zeros((rows, k), dtype=np.int64)

    def worst(self, rows: slice) -> np.ndarray:
        """Score that a row's newcomers must reach."""
        return self.score[rows, -1]

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        k = self.score.shape[1]
        touched = np.unique(row)
        old = self.score[touched]
        at, place = np.nonzero(old > _LEAST)
        row = np.concatenate([row, touched[at]])
        score = np.concatenate([score, old[at, place]])
        ids = np.concatenate([ids, self.id[touched][at, place]])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        keep = rank < k
        self.score[row[keep], rank[keep]] = score[keep]
        self.id[row[keep], rank[keep]] = ids[keep]

    def lists(self, row: int) -> list[dict]:
        """Filled places, as mergeable structs: ascending order is heap order."""
        return [{"less": -s, "id": i} for s, i in zip(self.score[row].tolist(), self.id[row].tolist()) if s > _LEAST]


HEAP = "array<struct<less:bigint,id:bigint>>"


def _tiles(batches, anchors: np.ndarray):
    """(rows of anchors, scores, ids, labels) per tile of anchors and candidates."""
    for batch in batches:
        for lo in range(0, batch.num_rows, CANDIDATE_TILE):
            part = batch.slice(lo, CANDIDATE_TILE)
            ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            vectors = whole_vectors(part.column(2))
            for at in range(0, len(anchors), ANCHOR_TILE):
                rows = slice(at, at + ANCHOR_TILE)
                yield rows, scores(anchors[rows], vectors), ids, labels


def _merged(heaps: DataFrame, by: list[str], k: int) -> DataFrame:
    """Heaps of tasks merged: a row holds k places at most, one per task and key."""
    return heaps.groupBy(*by).agg(F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, k).alias("heap"))


def _best_positives(candidates: DataFrame, chunk, k: int) -> DataFrame:
    def run(batches):
        ids, labels, vectors = chunk.value
        heaps = Heaps(len(ids), k)
        for rows, score, cid, label in _tiles(batches, vectors):
            hit = (labels[rows, None] == label) & (ids[rows, None] != cid) & (score >= heaps.worst(rows)[:, None])
            a, c = np.nonzero(hit)
            heaps.add(a + rows.start, score[a, c], cid[c])
        for lo in range(0, len(ids), 1024):
            part = range(lo, min(lo + 1024, len(ids)))
            yield pa.RecordBatch.from_pydict({
                "anchor_id": pa.array(ids[lo:lo + 1024], type=pa.int64()),
                "heap": pa.array([heaps.lists(i) for i in part], type=pa.list_(pa.struct([("less", pa.int64()), ("id", pa.int64())])))})

    return _merged(candidates.mapInArrow(run, f"anchor_id bigint, heap {HEAP}"), ["anchor_id"], k)


def _windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score n with low p <= 100 n <= high p for every positive score p, within 64 bits."""
    within = lambda v: min(max(v, int(_LEAST) + 1), (1 << 63) - 1)
    p = positive.tolist()
    return (np.array([within(-((-low * v) // 100)) for v in p], dtype=np.int64),
            np.array([within(high * v // 100) for v in p], dtype=np.int64))


def _best_negatives(candidates: DataFrame, chunk, pairs, k: int, low: int, high: int) -> DataFrame:
    """``pairs``: anchor number, positive_id and positive_score of every pair, by anchor number."""
    def run(batches):
        ids, labels, vectors = chunk.value
        anchor, positive, gained = pairs.value
        least, most = _windows(gained, low, high)
        heaps, edges = Heaps(len(anchor), k), np.searchsorted(anchor, np.arange(len(ids) + 1))
        for rows, score, cid, label in _tiles(batches, vectors):
            own = slice(int(edges[rows.start]), int(edges[min(rows.stop, len(ids))]))
            of = anchor[own] - rows.start
            score = np.where(labels[rows, None] != label, score, _LEAST)
            for lo in range(0, len(of), ANCHOR_TILE):
                part = slice(own.start + lo, min(own.start + lo + ANCHOR_TILE, own.stop))
                s = score[of[lo:lo + ANCHOR_TILE]]
                hit = (s <= most[part, None]) & (s >= np.maximum(least[part], heaps.worst(part))[:, None])
                a, c = np.nonzero(hit)
                heaps.add(a + part.start, s[a, c], cid[c])
        for lo in range(0, len(anchor), 1024):
            part = slice(lo, lo + 1024)
            yield pa.RecordBatch.from_pydict({
                "anchor_id": pa.array(ids[anchor[part]], type=pa.int64()), "positive_id": pa.array(positive[part], type=pa.int64()),
                "positive_score": pa.array(gained[part], type=pa.int64()),
                "heap": pa.array([heaps.lists(i) for i in range(lo, min(lo + 1024, len(anchor)))],
                                 type=pa.list_(pa.struct([("less", pa.int64()), ("id", pa.int64())])))})

    keys = ["anchor_id", "positive_id", "positive_score"]
    return _merged(candidates.mapInArrow(run, f"anchor_id bigint, positive_id bigint, positive_score bigint, heap {HEAP}"), keys, k)


OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _mined(spark: SparkSession, candidates: DataFrame, anchors: pa.Table, sizes: tuple[int, int, int, int]) -> DataFrame:
    """Result rows of one chunk of anchors."""
    positives, negatives, low, high = sizes
    order = np.argsort(anchors.column(0).to_numpy(), kind="stable")
    ids, labels = anchors.column(0).to_numpy()[order], anchors.column(1).to_numpy()[order]
    chunk = spark.sparkContext.broadcast((ids, labels, whole_vectors(anchors.column(2))[order]))
    best = _best_positives(candidates, chunk, positives).select("anchor_id", F.explode("heap").alias("p")).select(
        "anchor_id", F.col("p.id").alias("id"), (-F.col("p.less")).alias("score")).toArrow()  # a few rows per anchor of the chunk
    anchor = np.searchsorted(ids, best.column(0).to_numpy())
    by = np.argsort(anchor, kind="stable")
    pairs = spark.sparkContext.broadcast((anchor[by], best.column(1).to_numpy()[by], best.column(2).to_numpy()[by]))
    return _best_negatives(candidates, chunk, pairs, negatives, low, high).select(
        "anchor_id", "positive_id", "positive_score", F.posexplode("heap").alias("at", "n")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", (-F.col("n.less")).alias("negative_score"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id (whole number), label (whole number), embedding (array of float or double). Rows with a null
    id, label, vector or component, or a component that is not finite, take no part; repeated rows count once, and
    of rows that share a vec_id the smallest (label, embedding) counts. Components become floor(256 x); a score is an
    inner product of these, the shorter vector filled with zeros; scores beyond 64 bits count as the nearest number.
    Rows for which ``is_anchor`` holds are anchors. Per anchor its first ``positives`` other rows of its label, and
    for each of them the first ``negatives`` rows of other labels with low p <= 100 n <= high p, by falling score,
    then vec_id. Anchors without such rows, and an empty table, give no rows; other columns are ignored.

    Every anchor meets every row: the work is their product, in tasks that hold one chunk of anchors and one tile.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
        .groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding"))
    with Scratch(spark) as scratch:
        stored = scratch.stored(rows)
        of_anchors = stored.filter(is_anchor)
        n, width = of_anchors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
        chunks = max(1, math.ceil(n * (8 * width + 16) / chunk_bytes))
        # as many heaps per anchor as tasks run at a time, however many files there are
        candidates = stored.coalesce(2 * spark.sparkContext.defaultParallelism)
        path = shared_folder(spark, "negatives")
        scratch.paths.append(path)
        for i in range(chunks):
            chunk = of_anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == i).toArrow()
            _mined(spark, candidates, chunk, (positives, negatives, low, high)).write.mode("append").parquet(path)
        return cut_lineage(spark.read.parquet(path).select(*OUT))


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    coalesce(list_sum([coalesce(z[1], 0) * coalesce(z[2], 0) FOR z IN list_zip(a.e, c.e)]), 0)::BIGINT AS score
    FROM v a, v c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
"""


@register("op11_hard_negatives", sql=SQL)
def op11_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "label", "embedding").withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END"))
    return hard_negatives(vectors, F.expr("vec_id % 50 = 0"))
