"""Polygons and dated places on a tree of square cells.

A cell (level, cx, cy) covers [cx, cx + 1) x [cy, cy + 1) times its side, which halves from level to level. A
polygon is known in a cell by the edges that meet the closed cell and by whether it holds the cell's centre; without
edges it holds the whole cell or nothing of it, so nothing needs an edge test there. Days are known by bucket,
as one bit per day, so that date ranges meet by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .spatial import day_bucket, day_number, ring_edges

#: Days of a bucket: bits of its mask.
BUCKET_DAYS = 32
NODE = ["level", "cx", "cy"]
_EDGE = ("x1", "y1", "x2", "y2")


def centre(side) -> tuple[Column, Column]:
    return (F.col("cx") + 0.5) * side, (F.col("cy") + 0.5) * side


def meets_cell(e: Column, cx: Column, cy: Column, side) -> Column:
    """Whether a segment shares a point with the closed cell: boxes overlap and its line does not leave all corners on one side."""
    west, south, east, north = cx * side, cy * side, (cx + 1) * side, (cy + 1) * side
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    sides = [dx * (y - e["y1"]) - dy * (x - e["x1"]) for x in (west, east) for y in (south, north)]
    return (
        (F.least(e["x1"], e["x2"]) <= east) & (F.greatest(e["x1"], e["x2"]) >= west)
        & (F.least(e["y1"], e["y2"]) <= north) & (F.greatest(e["y1"], e["y2"]) >= south)
        & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0))


def inside_from(x0: Column, y0: Column, inside: Column, x: Column, y: Column, edges: Column) -> Column:
    """Whether (x, y) is inside, from the same of (x0, y0): the edges crossed on the way up, then across. ``edges``
    must hold all that meet this way. A point on an edge counts as one just east and north of it."""
    def crossed(e):
        up = e["y1"] + F.try_divide((e["y2"] - e["y1"]) * (x0 - e["x1"]), e["x2"] - e["x1"])
        across = e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
        first = ((e["x1"] > x0) != (e["x2"] > x0)) & ((up > y0) != (up > y))
        second = ((e["y1"] > y) != (e["y2"] > y)) & ((across > x0) != (across > x))
        return first != second

    return F.aggregate(edges, inside, lambda odd, e: odd != crossed(e))


def rasterised(shapes: DataFrame, key: str, side: float) -> DataFrame:
    """key, cx, cy, inside, edges of every cell that a polygon (``key``, rings) has part in; no edges: the whole cell.

    Edges are cut to rows of cells and rows to cells, so a polygon of any number of edges is spread over tasks, and a
    row here carries the edges that meet its cell. Centres are settled by the crossings of the middle lines of rows.
    """
    far = 1e-9
    sides = shapes.select(key, F.explode(ring_edges("rings")).alias("e")).select(key, *[F.col(f"e.{c}").alias(c) for c in _EDGE])
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = sides.withColumn("cy", F.explode(F.sequence(F.floor(low / side - far), F.floor(high / side + far))))
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    at = lambda y: F.col("x1") + slope * (y - F.col("y1"))
    bottom, top = at(F.greatest(low, F.col("cy") * side)), at(F.least(high, (F.col("cy") + 1) * side))
    ends = [F.coalesce(bottom, F.col("x1")), F.coalesce(top, F.col("x2"))]
    met = rows.withColumn("cx", F.explode(F.sequence(
        F.floor(F.least(*ends) / side - far), F.floor(F.greatest(*ends) / side + far))))
    edge = F.struct(*_EDGE)
    crossed = met.filter(meets_cell(edge, F.col("cx"), F.col("cy"), side)).groupBy(key, "cx", "cy").agg(
        F.collect_list(edge).alias("edges"))
    middle = (F.col("cy") + 0.5) * side
    lines = rows.filter((F.col("y1") > middle) != (F.col("y2") > middle)).groupBy(key, "cy").agg(
        F.array_sort(F.collect_list(at(middle))).alias("xs"))
    first = lambda x: F.ceil(x / side - 0.5)  # noqa: E731  first cell whose centre is not west of x
    spans = F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda i: F.struct(
        first(F.get("xs", i)).alias("a"), (first(F.get("xs", i + 1)) - 1).alias("b")))
    held = lines.select(key, "cy", F.explode(spans).alias("s")).filter("s.a <= s.b").select(
        key, F.explode(F.sequence("s.a", "s.b")).alias("cx"), "cy", F.lit(True).alias("inside"))
    return crossed.join(held, [key, "cx", "cy"], "full").select(
        key, "cx", "cy", F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("edges", F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")).alias("edges"))


def halved(rows: DataFrame, side: float) -> DataFrame:
    """``rows`` (cx, cy, inside, edges, anything) of cells of ``side`` as their four quarters that still have a part of the polygon."""
    quarter = F.struct((F.col("q") % 2).alias("x"), F.expr("q div 2").alias("y"))
    x0, y0 = centre(side)
    kept = [c for c in rows.columns if c not in ("cx", "cy", "inside", "edges")]
    parts = rows.withColumns({"x0": x0, "y0": y0, "q": F.explode(F.array(*map(F.lit, range(4))))}).select(
        *kept, "x0", "y0", "inside", "edges", (2 * F.col("cx") + quarter["x"]).alias("cx"), (2 * F.col("cy") + quarter["y"]).alias("cy"))
    x, y = centre(side / 2)
    parts = parts.withColumn("inside", inside_from(F.col("x0"), F.col("y0"), F.col("inside"), x, y, F.col("edges"))).withColumn(
        "edges", F.filter("edges", lambda e: meets_cell(e, F.col("cx"), F.col("cy"), side / 2)))
    return parts.filter(F.col("inside") | (F.size("edges") > 0)).select(*rows.columns)


def day_masks(low: Column, high: Column) -> Column:
    """ARRAY<STRUCT<bucket, days>> of a closed range of dates: per bucket the bits of its days. Null if an end is unknown."""
    first, last = day_number(low), day_number(high)
    buckets = F.when(low <= high, F.sequence(day_bucket(low, BUCKET_DAYS), day_bucket(high, BUCKET_DAYS)))

    one = F.lit(1).cast("long")

    def days(b):
        start = F.greatest(first - b * BUCKET_DAYS, F.lit(0))
        stop = F.least(last - b * BUCKET_DAYS, F.lit(BUCKET_DAYS - 1))
        # the bits from start to stop
        return F.struct(b.alias("bucket"), (F.call_function("shiftleft", one, stop + 1) - F.call_function("shiftleft", one, start)).alias("days"))

    return F.transform(buckets, days)


def day_mask(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day_number(day), F.lit(BUCKET_DAYS)).cast("int"))


def shared_days(a: str, b: str) -> Column:
    return F.col(a).bitwiseAND(F.col(b)) != 0
