"""Row numbers and group winners that survive one group holding most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut_lineage


def first_per_group(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per group, smallest by ``order`` (which must end in a unique column).

    A plain aggregate: each task keeps one row per group before the shuffle.
    """
    rest = [c for c in df.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*by).agg(best.alias("_best")).select(*by, "_best.*").select(*df.columns)


def top_per_group(df: DataFrame, by: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per group with their 1-based rank (Spark prunes before the shuffle)."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)


def ranked(df: DataFrame, by: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """1-based row number inside each ``by`` group, ordered by ascending unique ``order`` columns.

    The rows are range-partitioned on (by, order), so a group of any size is cut over many
    tasks; the rank is the row number inside the slice plus the rows in earlier slices. The
    slices are written out first, because a retried range partitioning could cut elsewhere.
    """
    sliced = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()))
    per_slice = sliced.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("_slice") == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    local = F.row_number().over(W.partitionBy(*by, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_local", local).join(offsets, same)
        .withColumn(name, (F.col("_local") + F.col("_before")).cast("long"))
        .select(*df.columns, name)
    )


#: Ranges of values that are counted at a time to find the k-th value.
_RANGES = 1024


def kth_smallest(rows: DataFrame, column: str, k: int, low: int, high: int) -> int:
    """The ``k``-th smallest of the whole numbers in ``column`` within (low, high], which holds as many, by counts of
    ever smaller ranges: no sort, and a bounded number of counts at a time."""
    while high - low > 1:
        width = -(-(high - low) // _RANGES)
        part = F.floor((F.col(column) - (low + 1)) / F.lit(width))
        counts = dict(rows.filter((F.col(column) > low) & (F.col(column) <= high)).groupBy(part.alias("part")).count().collect())
        at = 0
        while counts.get(at, 0) < k:
            k, at = k - counts.get(at, 0), at + 1
        low, high = low + at * width, min(high, low + (at + 1) * width)
    return high


def round_robin_position(rank: Column, counts: Column, own_index: Column) -> Column:
    """Position of the ``rank``-th row of one queue when queues are popped in turn.

    ``counts`` is ARRAY<STRUCT<idx, n>> of all queues: every queue has given min(n, rank - 1)
    rows before this turn, and in this turn the queues with a smaller index that are not empty.
    """
    zero = F.lit(0).cast("long")
    return F.aggregate(
        counts, zero,
        lambda acc, q: acc + F.least(q["n"], rank - 1)
        + F.when((q["idx"] < own_index) & (q["n"] >= rank), 1).otherwise(0),
    ) + 1
