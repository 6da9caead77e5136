"""Geometry predicates on ring arrays and bucket keys for spatial and interval joins.

Rings are ARRAY<ARRAY<STRUCT<x, y>>>, each ring closed; holes follow the even-odd rule.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.geo import rect_ring
from ..session import join_in_place

BOX = ("bbox_w", "bbox_s", "bbox_e", "bbox_n")


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def ring_edges(rings) -> Column:
    """All ring sides as ARRAY<STRUCT<x1, y1, x2, y2>>."""
    def sides(ring):
        return F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p, i: F.struct(
            p["x"].alias("x1"), p["y"].alias("y1"),
            F.get(ring, i + 1)["x"].alias("x2"), F.get(ring, i + 1)["y"].alias("y2"),
        ))
    return F.flatten(F.transform(_col(rings), sides))


def point_inside(x, y, edges) -> Column:
    x, y = _col(x), _col(y)

    def crosses(e):
        at = e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)
    return F.aggregate(_col(edges), F.lit(False), lambda odd, e: F.when(crosses(e), ~odd).otherwise(odd))


def point_distance(x, y, edges) -> Column:
    """Planar distance in the units of the coordinates, 0 inside."""
    x, y = _col(x), _col(y)

    def squared(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        along = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        px, py = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
        return px * px + py * py
    return F.when(point_inside(x, y, edges), 0.0).otherwise(
        F.sqrt(F.array_min(F.transform(_col(edges), squared))))


def _length(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def is_box() -> Column:
    """Whether a polygon (bbox_*, rings) is its box: one ring through its corners, either way round from any of them."""
    def holds(v):
        ring, (w, s, e, n) = v["ring"], (v[c] for c in BOX)
        a, b, c, d = ([F.get(ring, F.lit(i))[k] for k in ("x", "y")] for i in range(4))
        same = lambda p, x, y: (p[0] == x) & (p[1] == y)
        across = (F.least(a[0], c[0]) == w) & (F.greatest(a[0], c[0]) == e) & (F.least(a[1], c[1]) == s) & (F.greatest(a[1], c[1]) == n)
        around = (same(b, a[0], c[1]) & same(d, c[0], a[1])) | (same(b, c[0], a[1]) & same(d, a[0], c[1]))
        finite = F.abs(w) + F.abs(s) + F.abs(e) + F.abs(n) < float("inf")
        return (v["rings"] == 1) & (F.size(ring) == 5) & (F.get(ring, F.lit(4)) == F.get(ring, F.lit(0))) & (w < e) & (s < n) & finite & across & around

    w, s, e, n = map(F.col, BOX)
    usual = (w < e) & (s < n) & (F.abs(w) + F.abs(s) + F.abs(e) + F.abs(n) < float("inf")) & (F.col("rings") == F.array(rect_ring(*BOX)))
    # in an array of one, so that the ring is built once for all that is asked of it
    known = F.struct(F.size("rings").alias("rings"), F.get(F.col("rings"), F.lit(0)).alias("ring"), *BOX)
    return F.coalesce(usual, F.lit(False)) | F.coalesce(F.get(F.transform(F.array(known), holds), F.lit(0)), F.lit(False))


def box_distance(x: Column, y: Column) -> Column:
    """Distance of (x, y) to the box bbox_*, 0 inside: what lies in the box is not nearer."""
    w, s, e, n = map(F.col, BOX)
    return _length(F.greatest(w - x, F.lit(0.0), x - e), F.greatest(s - y, F.lit(0.0), y - n))


def box_reach(x: Column, y: Column) -> Column:
    """Distance of (x, y) to the farthest corner of the box bbox_*: what lies in the box is not farther."""
    w, s, e, n = map(F.col, BOX)
    return _length(F.greatest(F.abs(x - w), F.abs(x - e)), F.greatest(F.abs(y - s), F.abs(y - n)))


def _side(ax, ay, bx, by, px, py) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _segments_meet(a, b) -> Column:
    near = (
        (F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
        & (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
        & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
        & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
    )
    def straddles(p, q):
        one = _side(p["x1"], p["y1"], p["x2"], p["y2"], q["x1"], q["y1"])
        two = _side(p["x1"], p["y1"], p["x2"], p["y2"], q["x2"], q["y2"])
        return one * two <= 0
    return near & straddles(a, b) & straddles(b, a)


def edges_meet(a, b) -> Column:
    """True when an edge of ``a`` shares a point with an edge of ``b``."""
    return F.exists(_col(a), lambda p: F.exists(_col(b), lambda q: _segments_meet(p, q)))


def middle_in_box(e, west, south, east, north) -> tuple[Column, Column]:
    """The middle of the part of a segment that lies in the box (which it meets)."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    ways = [(F.try_divide(low - start, d), F.try_divide(high - start, d))
            for start, d, low, high in ((e["x1"], dx, west, east), (e["y1"], dy, south, north))]
    enter = F.greatest(F.lit(0.0), *[F.least(*w) for w in ways])
    leave = F.least(F.lit(1.0), *[F.greatest(*w) for w in ways])
    t = (enter + leave) / 2
    return e["x1"] + t * dx, e["y1"] + t * dy


def day_number(day) -> Column:
    return F.date_diff(_col(day), F.lit("1970-01-01").cast("date"))


def day_bucket(day, span: int) -> Column:
    return F.floor(day_number(day) / F.lit(span)).cast("int")


def day_buckets(first, last, span: int) -> Column:
    """Every bucket a closed day interval touches (empty when either end is unknown)."""
    first, last = day_bucket(first, span), day_bucket(last, span)
    return F.when(first <= last, F.sequence(first, last))


def grid_cell(x, y, size: float) -> Column:
    return F.floor(_col(x) / size) * 1_000_000 + F.floor(_col(y) / size)


def grid_cells(west, south, east, north, size: float) -> Column:
    """Keys of every square cell a box touches."""
    def span(low, high):
        low, high = F.floor(_col(low) / size), F.floor(_col(high) / size)
        return F.when(low <= high, F.sequence(low, high))
    ys = span(south, north)
    return F.flatten(F.transform(span(west, east), lambda x: F.transform(ys, lambda y: x * 1_000_000 + y)))


def grid_boxes(west, south, east, north, size: float) -> Column:
    """ARRAY<STRUCT<cx, cy>> of every square cell a box touches."""
    def span(low, high):
        low, high = F.floor(_col(low) / size), F.floor(_col(high) / size)
        return F.when(low <= high, F.sequence(low, high))
    ys = span(south, north)
    return F.flatten(F.transform(span(west, east), lambda x: F.transform(ys, lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def explode_keys(df: DataFrame, **arrays: Column) -> DataFrame:
    """One row per combination of the named key arrays."""
    for name, values in arrays.items():
        df = df.withColumn(name, F.explode(values))
    return df


#: Side of the finest cells and days of a bucket that ``meeting`` finds its pairs by.
MEET_DEGREES, MEET_DAYS = 4.0, 32


def box_grids(boxes: DataFrame) -> list[tuple]:
    """(grid, width, height): the grids that boxes stand on by their size, and the largest box of each. A grid has cells
    of twice the side of the one before; there are few."""
    return [tuple(g) for g in boxes.groupBy(_box_grid().alias("grid")).agg(
        F.max(F.col("bbox_e") - F.col("bbox_w")), F.max(F.col("bbox_n") - F.col("bbox_s"))).filter("grid IS NOT NULL").collect()]


def _box_grid() -> Column:
    size = F.greatest(F.col("bbox_e") - F.col("bbox_w"), F.col("bbox_n") - F.col("bbox_s"))
    return F.when(size > MEET_DEGREES, F.ceil(F.log2(size / MEET_DEGREES))).when(size.isNotNull(), 0).cast("int")


def _node(bucket, grid, cx, cy) -> Column:
    """One number for a bucket of days and a cell of a grid."""
    return ((bucket.cast("long") * 100 + grid) * 1_000_000 + cx) * 1_000_000 + cy


def meeting(p: DataFrame, q: DataFrame, grids: list[tuple], on: tuple[str, ...] = (), also: Column | None = None) -> DataFrame:
    """Pairs (aliases ``p``, ``q``) of rows whose boxes meet, with ``acq`` of ``q`` in the closed dates ``low`` to ``high``
    of ``p``, equal in the columns ``on``. ``grids``: the ``box_grids`` of ``q``.

    A row of ``q`` stands in one cell, that of its south-west corner, on the grid of its size; a row of ``p`` asks in the
    cells where such corners can lie. So no row of ``q`` is copied and no pair comes twice; the pairs are to be
    added up as they come, by aggregates of fixed width.
    """
    far = 1e-9
    cells = []
    for grid, width, height in grids:
        side = MEET_DEGREES * 2 ** grid
        span = lambda low, high, size: F.sequence(F.floor((F.col(low) - (size + far)) / side), F.floor(F.col(high) / side))  # noqa: E731,B023
        ys = span("bbox_s", "bbox_n", height)
        cells.append(F.flatten(F.transform(span("bbox_w", "bbox_e", width), lambda x: F.transform(ys, lambda y: _node(F.lit(0), F.lit(grid), x, y)))))  # noqa: B023
    known = p.filter("bbox_w <= bbox_e AND bbox_s <= bbox_n AND low <= high")
    asked = known.withColumn("_bucket", F.explode(day_buckets("low", "high", MEET_DAYS))).withColumn(
        "_node", F.explode(F.concat(*cells) if cells else F.array().cast("array<bigint>"))).withColumn(
        "_node", F.col("_node") + _node(F.col("_bucket"), F.lit(0), F.lit(0), F.lit(0))).drop("_bucket").alias("p")
    # boxes of one grid, the usual case, need no look at their size: shorter code for every row
    one = F.lit(grids[0][0]) if len(grids) == 1 else None
    side = F.lit(MEET_DEGREES * 2 ** grids[0][0]) if one is not None else F.lit(MEET_DEGREES) * F.pow(F.lit(2.0), _box_grid())
    held = q.withColumn("_node", _node(
        day_bucket("acq", MEET_DAYS), _box_grid() if one is None else one, F.floor(F.col("bbox_w") / side), F.floor(F.col("bbox_s") / side))).alias("q")
    (pw, ps, pe, pn), (qw, qs, qe, qn) = ([F.col(f"{side}.{c}") for c in BOX] for side in "pq")
    meet = (
        (F.col("p._node") == F.col("q._node")) & F.col("q.acq").between(F.col("p.low"), F.col("p.high"))
        & (pw <= qe) & (pe >= qw) & (ps <= qn) & (pn >= qs))
    for c in on:
        meet = meet & (F.col(f"p.{c}") == F.col(f"q.{c}"))
    return asked.join(held, meet if also is None else meet & also)


#: Days of a bucket of ``picked``; bits of the number of cells a region is wide and high and of the buckets it is long; rows of a
#: side beyond which a region is dealt to several tasks; bits that a row's number in its region has at most.
PICK_DAYS, REGION_BITS, REGION_ROWS, CODE_BITS = 16, {"x": 2, "y": 2, "t": 3}, 2_000_000, 40


def picked(p: DataFrame, q: DataFrame, key: str, order: tuple[str, ...], picks: dict[str, tuple[Column | None, bool]],
           by: tuple[str, ...] = (), also: Column | None = None, rows: int = REGION_ROWS) -> DataFrame:
    """Per ``key`` of ``p`` what it picks from the rows of ``q`` that meet it as in ``meeting``: their number ``n`` and per
    name of ``picks`` a struct (rank, *order), the first by rank, then ``order`` (the largest if the flag says so). Rows of ``p`` that
    meet nothing are left out. A rank is a whole number from 0 of ``p.*``, ``q.acq`` and ``q.*`` of ``by``; ``also`` knows the same columns.

    Both sides are shuffled once, to regions of several cells and buckets, where all else is done: rows are numbered by
    ``order``, so that a pick is the smallest number, added up in the join, and its row is found by this number. Only
    there a row of ``p`` is copied to its cells. Rows of ``q`` with equal box, day and ``by`` count together.
    """
    mask = (1 << CODE_BITS) - 1
    size = F.greatest(F.col("bbox_e") - F.col("bbox_w"), F.col("bbox_n") - F.col("bbox_s"))
    q = q.select(*dict.fromkeys((*BOX, "acq", *by, *order))).filter(size.isNotNull() & F.col("acq").isNotNull())
    grids = box_grids(q)
    one = len(grids) == 1
    grid = F.lit(grids[0][0]) if one else _box_grid()
    x, y = _corner_cell(F.lit(MEET_DEGREES * 2.0 ** grids[0][0]) if one else F.lit(MEET_DEGREES) * F.pow(F.lit(2.0), grid))
    corner = (x, y, day_bucket("acq", PICK_DAYS))
    held = q.withColumn("_region", _region(grid, *[F.shiftright(v, bits) for v, bits in zip(corner, REGION_BITS.values())]))
    far = 1e-9
    # the grid of an asked cell is a constant where there is one only, the usual case: shorter code for every row
    number = grid if one else F.col("_g")

    def of(get) -> Column:
        values = [(g[0], F.lit(float(get(g)))) for g in grids]
        return functools.reduce(lambda rest, v: F.when(number == v[0], v[1]).otherwise(rest), values[1:], values[0][1] if values else F.lit(1.0))
    width, height, side = of(lambda g: g[1] + far), of(lambda g: g[2] + far), of(lambda g: MEET_DEGREES * 2 ** g[0])

    def span(low, high):
        return F.floor(low), F.floor(high)
    cells = {"x": span((F.col("bbox_w") - width) / side, F.col("bbox_e") / side), "y": span((F.col("bbox_s") - height) / side, F.col("bbox_n") / side),
             "t": (day_bucket("low", PICK_DAYS), day_bucket("high", PICK_DAYS))}
    asked = p.filter("bbox_w <= bbox_e AND bbox_s <= bbox_n AND low <= high")
    if not one:
        asked = asked.withColumn("_g", F.explode(F.array(*[F.lit(g[0]) for g in grids]).cast("array<int>")))
    for c, (low, high) in cells.items():
        asked = asked.withColumn(f"_{c}", F.explode(F.sequence(F.shiftright(low, REGION_BITS[c]), F.shiftright(high, REGION_BITS[c]))))
    asked = asked.withColumn("_region", _region(number, F.col("_x"), F.col("_y"), F.col("_t")))
    asked, held = _dealt(asked, held, key, by, rows)
    extra = [c for c in p.columns if c not in (key, *BOX, "low", "high")]
    where = [c for c in asked.columns if c in ("_region", "_i", "_j")]
    join_in_place(p.sparkSession)
    asked, held = asked.repartition(*where), held.repartition(*where)
    # every column is in the order, so that both uses below read the same shuffled rows, and ties are none
    coded = held.withColumn("_code", F.row_number().over(W.partitionBy(*where).orderBy(*q.select(*dict.fromkeys((*order, *q.columns))).columns)))
    daily = coded.groupBy(*where, *BOX, "acq", *by).agg(F.min("_code").alias("first"), F.max("_code").alias("last"), F.count("*").alias("n"))
    daily = daily.withColumn("_node", _place(*corner))
    for c, (low, high) in cells.items():
        cells_wide = 1 << REGION_BITS[c]
        first = F.col(f"_{c}") * cells_wide
        asked = asked.withColumn(f"_{c}", F.explode(F.sequence(F.greatest(low, first), F.least(high, first + (cells_wide - 1)))))
    asked = asked.withColumn("_node", _place(F.col("_x"), F.col("_y"), F.col("_t"))).select(
        *where, key, *BOX, "low", "high", "_node", *extra)
    (pw, ps, pe, pn), (qw, qs, qe, qn) = ([F.col(f"{side}.{c}") for c in BOX] for side in "pq")
    meet = F.col("q.acq").between(F.col("p.low"), F.col("p.high")) & (pw <= qe) & (pe >= qw) & (ps <= qn) & (pn >= qs)
    for c in (*where, "_node"):
        meet = meet & (F.col(f"p.{c}") == F.col(f"q.{c}"))
    pairs = asked.alias("p").join(daily.alias("q"), meet if also is None else meet & also)
    ranked = {name: F.lit(0).cast("long") if rank is None else rank.cast("long") for name, (rank, _) in picks.items()}
    best = [(F.max if last else F.min)(F.call_function("shiftleft", ranked[name], F.lit(CODE_BITS)) + F.col("q.last" if last else "q.first")).alias(f"_{name}")
            for name, (_, last) in picks.items()]
    met = pairs.groupBy(*[F.col(f"p.{c}").alias(c) for c in where], F.col(f"p.{key}").alias(key)).agg(F.sum("q.n").alias("n"), *best)
    asks = F.array(*[F.struct(F.lit(i).alias("pick"), F.col(f"_{name}").alias("best"), (F.col("n") if i == 0 else F.lit(0).cast("long")).alias("n"))
                     for i, name in enumerate(picks)])
    asks = met.select(*where, key, F.explode(asks).alias("_a")).select(
        *where, key, "_a.pick", "_a.n", F.shiftright("_a.best", CODE_BITS).alias("rank"), F.col("_a.best").bitwiseAND(F.lit(mask)).cast("int").alias("_code"))
    named = asks.join(coded.select(*where, "_code", *order), [*where, "_code"])
    found = F.struct("rank", *order)
    return named.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("n"), *[
        (F.max if last else F.min)(F.when(F.col("pick") == i, found)).alias(name) for i, (name, (_, last)) in enumerate(picks.items())])


def _corner_cell(side: Column) -> tuple[Column, Column]:
    """Cell of the south-west corner of a box on the grid of ``side``."""
    return F.floor(F.col("bbox_w") / side), F.floor(F.col("bbox_s") / side)


def _region(grid, x, y, t) -> Column:
    # never null, so that Spark does not look at the whole expression for nulls at the scan
    return F.coalesce(((t.cast("long") * 100 + grid) * 1_000_000 + x) * 1_000_000 + y, F.lit(-1).cast("long"))


def _place(x, y, t) -> Column:
    """Number of a cell and a bucket in their region."""
    number = F.lit(0)
    for v, bits in zip((x, y, t), REGION_BITS.values()):
        number = number * (1 << bits) + F.pmod(v, F.lit(1 << bits)).cast("int")
    return F.coalesce(number, F.lit(-1))


def _dealt(asked: DataFrame, held: DataFrame, key: str, by: tuple[str, ...], rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the part ``_i`` of ``asked`` and ``_j`` of ``held`` in their region, if there are regions of more than ``rows``
    rows of a side: every part of one side meets every part of the other. Such regions are few."""
    most = lambda side: {r["_region"]: -(-r["count"] // rows) for r in side.groupBy("_region").count().filter(F.col("count") > rows).collect()}
    many, wide = most(asked), most(held)
    parts = {region: (many.get(region, 1), wide.get(region, 1)) for region in many | wide}
    if not parts:
        return asked, held
    table = F.broadcast(held.sparkSession.createDataFrame([(k, *v) for k, v in parts.items()], "_region long, _ni int, _nj int"))
    part = lambda count, *columns: F.pmod(F.xxhash64(*columns), F.coalesce(count, F.lit(1))).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1))
    asked = asked.join(table, "_region", "left").withColumns({"_i": part(F.col("_ni"), key), "_j": each(F.col("_nj"))})
    held = held.join(table, "_region", "left").withColumns({"_i": each(F.col("_ni")), "_j": part(F.col("_nj"), *BOX, "acq", *by)})
    return asked.drop("_ni", "_nj"), held.drop("_ni", "_nj")
