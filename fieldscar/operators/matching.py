"""Cross-verification joins: events against activations, archives, relief lists, countries and scenes.

Every range condition gets equi keys (grid cell, time bucket) and the exact test as residual.
Existence tests are semi joins, so matches are never materialised.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import KM_PER_DEGREE
from ..session import Scratch, cut_lineage
from . import cells as C, spatial as S

SPAN_DAYS = 32


#: Places and shapes of a cell up to which it is not split, and levels below the first.
CELL_BOUND, SHAPE_BOUND, CELL_LEVELS = 64, 256, 8
#: Rows of archive boxes in a cell and a bucket of days up to which each event there looks at them.
BOX_BOUND = 8192


def _flag(df: DataFrame, key: str, matched: DataFrame, name: str) -> DataFrame:
    hits = matched.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(hits, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _padded(days: int) -> tuple[Column, Column]:
    return F.date_sub("date_start", days), F.date_add("date_end", days)


def _with_days(df: DataFrame, low: Column, high: Column, *columns: str) -> DataFrame:
    """One row per bucket of the date range, with the bits of its days."""
    return df.select(*columns, F.explode(C.day_masks(low, high)).alias("_d")).select(*columns, "_d.bucket", "_d.days")


def match_points(events: DataFrame, points: DataFrame, radius_km: float = 150.0, days: int = 15, cell: float = 4.0,
                 name: str = "match_ems", bound: int = CELL_BOUND, levels: int = CELL_LEVELS) -> DataFrame:
    """Flag events whose polygon comes within ``radius_km`` / 111 degrees of a dated point.

    ``events``: event_id, bbox_*, rings, date_start, date_end; ``points``: lon, lat, date. A place counts once,
    whatever its number of dates: its days are bits. Cells with more than ``bound`` places are split; an event
    walks down the cells that its surroundings reach, and a cell that lies wholly within the radius needs neither
    its places nor a distance. So a hot place costs an event a bounded number of rows. The box of an event settles
    most places and cells: what is too far from the box, and what has all of the box within reach, needs no edge.
    """
    radius = radius_km / KM_PER_DEGREE
    x, y = F.col("lon"), F.col("lat")
    shape = ["event_id", "rings", *S.BOX, "dated"]
    spots = points.filter("date IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL").groupBy(
        "lon", "lat", S.day_bucket("date", C.BUCKET_DAYS).alias("bucket")).agg(F.bit_or(C.day_mask(F.col("date"))).alias("seen"))

    def at(level):
        side = cell / 2 ** level
        return [F.lit(level).alias("level"), F.floor(x / side).alias("cx"), F.floor(y / side).alias("cy")]

    with Scratch(events.sparkSession) as scratch:
        spots = scratch.stored(spots)
        crowded = _crowded(spots.select("lon", "lat").distinct(), at, bound, levels, scratch)
        deepest = len(crowded)
        leaf = spots.withColumn("_n", F.lit(0))
        for level, split in enumerate(crowded):  # how many levels down the cells of a spot are split
            here = split.select("cx", "cy", F.lit(1).alias("_more"))
            leaf = leaf.withColumns(dict(zip(("level", "cx", "cy"), at(level)))).join(here, ["cx", "cy"], "left").withColumn(
                "_n", F.when((F.col("_n") == level) & F.col("_more").isNotNull(), level + 1).otherwise(F.col("_n"))).drop("_more", "level", "cx", "cy")
        node = F.expr(f"CAST({cell} / shiftleft(1, _n) AS DOUBLE)")
        right = leaf.select(F.col("_n").alias("level"), F.floor(x / node).alias("cx"), F.floor(y / node).alias("cy"), F.lit(False).alias("whole"),
                            "bucket", "seen", "lon", "lat")
        for level in range(deepest + 1):
            if cell / 2 ** level * 0.7072 <= radius:  # cells of this size can lie wholly within the radius
                right = right.unionByName(spots.groupBy(*at(level), "bucket").agg(F.bit_or("seen").alias("seen")).select(
                    *C.NODE, F.lit(True).alias("whole"), "bucket", "seen", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat")))
        low, high = _padded(days)
        # spread by event first: the work per row is in its cells and days, and a scan may be one task
        # cells and days of an event are found once, not for each of its rows; explode would have Spark find them
        # before the shuffle too, to drop empty ones, which explode_outer leaves to the join
        reach = S.grid_boxes(F.col("bbox_w") - radius, F.col("bbox_s") - radius, F.col("bbox_e") + radius, F.col("bbox_n") + radius, cell)
        walk = events.select("event_id", "rings", *S.BOX, "date_start", "date_end").repartition("event_id").select(
            "event_id", "rings", *S.BOX, C.day_masks(low, high).alias("dated"), reach.alias("_c")).select(
            *shape, F.explode_outer("_c").alias("_c")).select(*shape, "_c.cx", "_c.cy")
        left = None
        for level in range(deepest + 1):
            side = cell / 2 ** level
            half = side * 0.70710679  # of the diagonal, and a little more
            reached = walk
            if level or deepest:
                reached = walk.filter(S.box_distance(*C.centre(side)) <= radius + half)
            whole = _within(*C.centre(side), radius - half) if (level or deepest) and half <= radius else F.lit(False)
            reached = reached.withColumns({"level": F.lit(level), "whole": whole})
            if level < deepest:
                split = crowded[level].select("cx", "cy", F.lit(True).alias("_split"))
                reached = scratch.stored(reached.join(split, ["cx", "cy"], "left"))
                walk = reached.filter("_split AND NOT whole").select(*shape, "cx", "cy", F.explode(
                    F.array(*map(F.lit, range(4)))).alias("_q")).select(
                    *shape, (2 * F.col("cx") + F.col("_q") % 2).alias("cx"), (2 * F.col("cy") + F.expr("_q div 2")).alias("cy"))
                reached = reached.filter("whole OR _split IS NULL")
            kept = reached.select(*shape, *C.NODE, "whole")
            left = kept if left is None else left.unionByName(kept)
        rows = left.select(*shape, *C.NODE, "whole", F.explode_outer("dated").alias("_d")).select(
            "event_id", "rings", *S.BOX, *C.NODE, "whole", "_d.bucket", "_d.days")
        pairs = rows.join(right, [*C.NODE, "whole", "bucket"]).filter(
            C.shared_days("days", "seen") & (F.col("whole") | (S.box_distance(x, y) <= radius + 1e-9)))
        # an aggregate, as a filter would put the look at edges into the join, where it slows down every row
        hits = pairs.groupBy("event_id").agg(F.bool_or(F.col("whole") | _within(x, y, radius)).alias("_hit")).filter("_hit")
        return _flag(events, "event_id", cut_lineage(hits.select("event_id")), name)


def _within(x: Column, y: Column, reach: float) -> Column:
    """Whether a polygon (bbox_*, rings) comes within ``reach`` of (x, y): by its box where that tells, else by its edges."""
    far = 1e-9
    has_edge = F.exists("rings", lambda ring: F.size(ring) > 1)
    exact = F.get(F.transform(F.array(S.ring_edges("rings")), lambda edges: S.point_distance(x, y, edges)), F.lit(0))
    return (S.box_distance(x, y) <= reach + far) & (((S.box_reach(x, y) <= reach - far) & has_edge) | (exact <= reach))


def _crowded(things: DataFrame, at, bound: int, levels: int, scratch: Scratch) -> list[DataFrame]:
    """Per level the cells (cx, cy) with more than ``bound`` rows of ``things``, as long as there are any; those of a level
    lie in those of the level before."""
    out = []
    while len(out) < levels:
        level = len(out)
        split = scratch.stored(things.groupBy(*at(level)[1:]).count().filter(F.col("count") > bound).select("cx", "cy"))
        if split.isEmpty():
            break
        out.append(split)
    return out


def match_polygons(events: DataFrame, archive: DataFrame, days: int = 15, cell: float = 4.0, name: str = "match_dfo",
                   bound: int = SHAPE_BOUND, levels: int = CELL_LEVELS, box_bound: int = BOX_BOUND) -> DataFrame:
    """Flag events whose polygon shares a point with an archive polygon (touching counts) with overlapping padded dates.

    Polygons that are their box meet where the boxes do, so no edge is needed among them (:func:`_boxes_met`). All other
    events (of another shape, or left where the archive has other shapes or too many boxes in one place) go to the
    tree of cells (:func:`_polygons_met`), if there are any.
    """
    plain = S.is_box()
    boxes = archive.filter(plain)
    settled, crowded = _boxes_met(events.filter(plain), boxes, days, cell, box_bound)
    settled = cut_lineage(settled)
    shaped = lambda df: df.agg(F.coalesce(F.bool_or(~plain), F.lit(False))).first()[0]
    left = None
    if crowded or shaped(archive):
        left = events.join(settled, "event_id", "left_anti")
    elif shaped(events):
        left = events.filter(~plain)
    hits = settled if left is None else settled.unionByName(_polygons_met(left, archive, days, cell, bound, levels))
    return _flag(events, "event_id", hits, name)


def _boxes_met(events: DataFrame, archive: DataFrame, days: int, cell: float, bound: int) -> tuple[DataFrame, bool]:
    """event_id of the events whose box meets one of the archive with overlapping padded dates, and whether boxes were left
    out: those of cells and buckets with more than ``bound`` of them.

    Both sides stand in the cells and buckets they touch; a semi join stops at the first box that meets an event.
    """
    low, high = _padded(days)
    where = ["cx", "cy", "bucket"]

    def placed(df, first, last, *columns):
        span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
        rows = df.select(*columns, *S.BOX, first.alias("low"), last.alias("high")).filter("low <= high")
        rows = rows.withColumn("bucket", F.explode(F.sequence(S.day_bucket("low", SPAN_DAYS), S.day_bucket("high", SPAN_DAYS))))
        return rows.withColumn("cx", span("bbox_w", "bbox_e")).withColumn("cy", span("bbox_s", "bbox_n"))

    held = placed(archive, low, high)
    asked = placed(events, F.col("date_start"), F.col("date_end"), "event_id")
    crowd = cut_lineage(held.groupBy(*where).count().filter(F.col("count") > bound).select(*where))
    crowded = not crowd.isEmpty()
    if crowded:
        held = held.join(crowd, where, "left_anti")
    p, q = asked.alias("p"), held.alias("q")
    meet = functools.reduce(Column.__and__, [F.col(f"p.{c}") == F.col(f"q.{c}") for c in where] + [
        F.col("p.bbox_w") <= F.col("q.bbox_e"), F.col("p.bbox_e") >= F.col("q.bbox_w"), F.col("p.bbox_s") <= F.col("q.bbox_n"),
        F.col("p.bbox_n") >= F.col("q.bbox_s"), F.col("p.low") <= F.col("q.high"), F.col("p.high") >= F.col("q.low")])
    return p.join(q, meet, "left_semi").select("event_id").distinct(), crowded


def _polygons_met(events: DataFrame, archive: DataFrame, days: int, cell: float, bound: int, levels: int) -> DataFrame:
    """event_id of the events whose polygon shares a point with one of the archive with overlapping padded dates.

    Archive records with equal rings are one shape, whose days are bits. Both sides are cut to cells; cells that
    the edges of more than ``bound`` shapes meet are split. Where either polygon holds a whole cell, all shapes of
    the cell count together; edges are compared only in cells with few of them.
    """
    shape = F.sha2(F.to_json("rings"), 256).alias("shape")
    low, high = _padded(days)
    ranges = archive.select(shape, low.alias("low"), high.alias("high"))
    seen = _with_days(ranges, F.col("low"), F.col("high"), "shape").groupBy("shape", "bucket").agg(F.bit_or("days").alias("seen"))
    q_box = [f"q_{c}" for c in S.BOX]
    shapes = archive.select(shape, *S.BOX, "rings").dropDuplicates(["shape"]).withColumns({q: F.col(c) for q, c in zip(q_box, S.BOX)})
    with Scratch(events.sparkSession) as scratch:
        theirs = _cut_to_cells(shapes, ["shape", *q_box], cell)
        ours = _cut_to_cells(events.withColumns({f"p_{c}": F.col(c) for c in S.BOX}), ["event_id", "date_start", "date_end", *[f"p_{c}" for c in S.BOX]], cell)
        kinds, left = [], []
        for level in range(levels + 1):
            side = cell / 2 ** level
            theirs = scratch.stored(theirs)
            crowd = theirs.filter(F.size("edges") > 0).groupBy("cx", "cy").count().filter(F.col("count") > bound)
            split = scratch.stored(crowd.select("cx", "cy", F.lit(True).alias("split"))) if level < levels else None
            last = split is None or split.isEmpty()
            if not last:
                theirs, ours = (x.join(split, ["cx", "cy"], "left") for x in (theirs, scratch.stored(ours)))
            else:
                theirs, ours = (x.withColumn("split", F.lit(None).cast("boolean")) for x in (theirs, ours))
            kinds.append(theirs.withColumn("level", F.lit(level)))
            left.append(ours.withColumn("level", F.lit(level)))
            if last:
                break
            theirs = C.halved(theirs.filter("split AND size(edges) > 0").drop("split"), side)
            ours = C.halved(ours.filter("split AND size(edges) > 0").drop("split"), side)
        theirs, ours = (functools.reduce(DataFrame.unionByName, x) for x in (kinds, left))
        # what an event asks for: where it holds the cell, any shape; on its edges, shapes that hold the cell, and the edges of others
        dated = theirs.join(seen, "shape")
        by_node = [*C.NODE, "bucket"]
        whole = dated.groupBy(*by_node, F.when(F.size("edges") == 0, "whole").otherwise("edge").alias("kind")).agg(F.bit_or("seen").alias("seen"))
        none = F.lit(None)
        together = whole.select(*by_node, "kind", "seen", none.cast("boolean").alias("q_inside"), F.array().cast(EDGES).alias("q_edges"), *[none.cast("double").alias(c) for c in q_box])
        alone = dated.filter("split IS NULL AND size(edges) > 0").select(
            *by_node, F.lit("one").alias("kind"), "seen", F.col("inside").alias("q_inside"), F.col("edges").alias("q_edges"), *q_box)
        asks = F.when(F.size("edges") == 0, F.array(F.lit("whole"), F.lit("edge"))).when(
            F.col("split").isNull(), F.array(F.lit("whole"), F.lit("one"))).otherwise(F.array(F.lit("whole")))
        p = _with_days(ours, F.col("date_start"), F.col("date_end"), "event_id", "inside", "edges", "split", *[f"p_{c}" for c in S.BOX], *C.NODE).withColumn("kind", F.explode(asks))
        pairs = p.join(together.unionByName(alone), [*by_node, "kind"]).filter(C.shared_days("days", "seen"))
        side = F.expr(f"CAST({cell} / shiftleft(1, level) AS DOUBLE)")
        # boxes first: they settle most pairs of a cell without a look at an edge
        boxes_meet = F.expr("p_bbox_w <= q_bbox_e AND p_bbox_e >= q_bbox_w AND p_bbox_s <= q_bbox_n AND p_bbox_n >= q_bbox_s")
        meets = (F.col("kind") != "one") | (boxes_meet & ((F.col("inside") & F.col("q_inside")) | S.edges_meet("edges", "q_edges") | _reaches_into(
            "edges", "q_inside", "q_edges", side) | _reaches_into("q_edges", "inside", "edges", side)))
        return cut_lineage(pairs.filter(meets).select("event_id").distinct())


EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _cut_to_cells(df: DataFrame, keep: list[str], cell: float) -> DataFrame:
    """``keep``, cx, cy, inside, edges for the cells that polygons (bbox_*, rings) of few edges have part in."""
    spread = df.select(*keep, "rings", *S.BOX).repartition(keep[0])  # the work per row is in its cells, and a scan may be one task
    cut = spread.select(*keep, S.ring_edges("rings").alias("all"), F.explode(S.grid_boxes(*S.BOX, cell)).alias("_c")).select(*keep, "all", "_c.cx", "_c.cy")
    found = cut.select(*keep, "cx", "cy", S.point_inside(*C.centre(cell), F.col("all")).alias("inside"), F.filter(
        "all", lambda e: C.meets_cell(e, F.col("cx"), F.col("cy"), cell)).alias("edges"))
    return found.filter(F.col("inside") | (F.size("edges") > 0))


def _reaches_into(edges: str, inside: str, others: str, side: Column) -> Column:
    """Whether a part of ``edges`` within the cell lies in the other polygon, known by its centre and its edges there."""
    x0, y0 = C.centre(side)

    def reaches(e):
        x, y = S.middle_in_box(e, F.col("cx") * side, F.col("cy") * side, (F.col("cx") + 1) * side, (F.col("cy") + 1) * side)
        return C.inside_from(x0, y0, F.col(inside), x, y, F.col(others))

    return F.exists(edges, reaches)


def match_country_dates(events: DataFrame, relief: DataFrame, days: int = 15,
                        name: str = "match_ifrc") -> DataFrame:
    """Flag events with a relief record of their country inside the padded dates.

    ``relief``: iso3 (codes joined by ``;``), date. Its distinct (country, day) pairs are few.
    """
    low, high = _padded(days)
    probe = S.explode_keys(
        events.filter(F.coalesce(F.col("iso3"), F.lit("")) != "")
        .select("event_id", F.col("iso3").alias("iso"), low.alias("low"), high.alias("high")),
        bucket=S.day_buckets("low", "high", SPAN_DAYS),
    )
    dated = (
        relief.filter("date IS NOT NULL").select(F.explode(F.split("iso3", ";")).alias("iso"), "date")
        .filter("iso <> ''").distinct().withColumn("bucket", S.day_bucket("date", SPAN_DAYS))
    )
    p, q = probe.alias("p"), dated.alias("q")
    hit = (
        (F.col("p.iso") == F.col("q.iso")) & (F.col("p.bucket") == F.col("q.bucket"))
        & F.col("q.date").between(F.col("p.low"), F.col("p.high"))
    )
    return _flag(events, "event_id", p.join(q, hit, "left_semi"), name)


def assign_country(events: DataFrame, countries: DataFrame, key: str = "event_id", name: str = "iso3",
                   default: str | None = None, cell: float = 2.0) -> DataFrame:
    """Code of the first country polygon (by ``country_id``) that holds the centre (lon, lat).

    Countries are rasterised: a cell carries the edges that meet it, cells inside a country none; so a centre
    meets the countries of its cell and their edges there, however long a border is.
    """
    spots = events.select(key, "lon", "lat", F.floor(F.col("lon") / cell).alias("cx"), F.floor(F.col("lat") / cell).alias("cy"))
    shapes = C.rasterised(countries, "country_id", cell).join(countries.select("country_id", "iso_a3"), "country_id")
    held = C.inside_from(*C.centre(cell), F.col("inside"), F.col("lon"), F.col("lat"), F.col("edges"))
    found = spots.join(shapes, ["cx", "cy"]).filter(held).groupBy(key).agg(F.min_by("iso_a3", "country_id").alias(name))
    out = events.join(found, key, "left")
    return out if default is None else out.withColumn(name, F.coalesce(name, F.lit(default)))


def corroborate(news: DataFrame, activations: DataFrame, archive: DataFrame, relief: DataFrame,
                countries: DataFrame, radius_km: float = 150.0, days: int = 15) -> DataFrame:
    """Add match_ems, match_dfo, match_ifrc and n_indep to news events."""
    out = match_points(news, activations, radius_km, days)
    out = match_polygons(out, archive, days)
    out = match_country_dates(assign_country(out, countries), relief, days)
    flags = ("match_ems", "match_dfo", "match_ifrc")
    return out.withColumn("n_indep", sum(F.col(f).cast("int") for f in flags))


def event_scenes(events: DataFrame, scenes: DataFrame) -> DataFrame:
    """Scenes whose box meets the event box inside its closed dates, one row per pair.

    ``events``: event_id, bbox_*, date_start, date_end; ``scenes``: scene_id, bbox_*, acq.
    """
    asked = events.select("event_id", *S.BOX, F.col("date_start").alias("low"), F.col("date_end").alias("high"))
    return S.meeting(asked, scenes, S.box_grids(scenes)).select("p.event_id", *[f"q.{c}" for c in scenes.columns])


# --- near-duplicate events ---------------------------------------------------------------------
# Two points of one block are always within the limits: blocks are sized so that the block diagonal
# stays below the distance and the block length below the days. A test therefore needs one head per
# block only, and work grows with the rows, never with the pairs. Rows meet heads in wider cells, so that
# a head has few copies.

DEDUP_KM, DEDUP_DAYS = 25.0, 30


def _band_width(band: Column, height: float) -> Column:
    """Longitude width of a block so that it is nowhere wider than ``height`` degrees of latitude."""
    low, high = F.abs(band * height), F.abs((band + 1) * height)
    return height / F.greatest(F.cos(F.radians(F.least(low, high))), F.lit(1e-6))


def with_block(df: DataFrame, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """Add the block (band, column, slot) of lon, lat, day."""
    height = 0.66 * km / KM_PER_DEGREE
    band = F.floor(F.col("lat") / height)
    return df.select(
        "*", band.alias("band"),
        F.floor(F.col("lon") / _band_width(band, height)).alias("strip"),
        F.floor(F.col("day") / F.lit(days)).alias("slot"),
    )


def _nodes(df: DataFrame, km: float, days: int):
    """Side in degrees and days of the cells that rows meet in, and the number of a cell."""
    height, length = 2 * km / KM_PER_DEGREE, max(2 * days, 1)
    number = lambda slot, band, strip: (slot * 1_000_003 + band) * 1_000_003 + strip
    return height, length, number


def with_node(df: DataFrame, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """Add the one cell (``node``) that holds lon, lat, day: twice the limits wide, high and long."""
    height, length, number = _nodes(df, km, days)
    band = F.floor(F.col("lat") / height)
    return df.withColumn("node", number(
        F.floor(F.col("day") / F.lit(length)), band, F.floor(F.col("lon") / _band_width(band, height))))


def near_nodes(df: DataFrame, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """One row per cell that may hold a point within the limits of the row, eight as a rule, as ``node``."""
    height, length, number = _nodes(df, km, days)
    reach = km / KM_PER_DEGREE + 1e-9
    far_lat = F.least(F.abs(F.col("lat")) + reach, F.lit(90.0))
    dlon = reach / F.greatest(F.cos(F.radians(far_lat)), F.lit(1e-3)) + 1e-9
    span = lambda low, high, size: F.sequence(F.floor(low / size), F.floor(high / size))
    bands = span(F.col("lat") - reach, F.col("lat") + reach, F.lit(height))
    slots = span(F.col("day") - days, F.col("day") + days, F.lit(length))
    strips = lambda band: span(F.col("lon") - dlon, F.col("lon") + dlon, _band_width(band, height))
    cells = F.flatten(F.transform(bands, lambda b: F.flatten(F.transform(strips(b), lambda s: F.transform(slots, lambda t: number(t, b, s))))))
    return df.withColumn("node", F.explode(cells))


def close_in_space_and_time(new: str, old: str, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> Column:
    """Flat-earth distance with the cosine at the newer point, and the day difference."""
    a = {c: F.col(f"{new}.{c}") for c in ("lon", "lat", "day")}
    b = {c: F.col(f"{old}.{c}") for c in ("lon", "lat", "day")}
    dy = (a["lat"] - b["lat"]) * KM_PER_DEGREE
    dx = (a["lon"] - b["lon"]) * KM_PER_DEGREE * F.cos(F.radians(a["lat"]))
    return (F.abs(a["day"] - b["day"]) <= days) & (F.sqrt(dx * dx + dy * dy) <= km)


BLOCK = ["band", "strip", "slot"]


def block_heads(df: DataFrame) -> DataFrame:
    """The earliest row (smallest ``seq``, which is unique) of every block, column by column, so that
    fixed-width columns are aggregated by hash."""
    rest = [F.min_by(c, "seq").alias(c) for c in df.columns if c not in (*BLOCK, "seq")]
    return df.groupBy(*BLOCK).agg(F.min("seq").alias("seq"), *rest).select(*df.columns)


def with_near_head(df: DataFrame, heads: DataFrame, condition: Column, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """Pairs (row ``x``, head ``h``) that satisfy ``condition``, which must ask for the limits.

    Every row stands in one cell; a head is known in the few cells that its limits reach. ``heads`` holds at most one
    row per block, so a row meets a bounded number of them.
    """
    h, x = near_nodes(heads, km, days).alias("h"), with_node(df, km, days).alias("x")
    return x.join(h, (F.col("x.node") == F.col("h.node")) & condition)


def seen_before(df: DataFrame, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """Flag rows with an earlier row (smaller ``seq``) close in space and time.

    Rows that are not the head of their block have one by construction; only heads are tested. Most heads of a
    crowded region are settled by an earlier head of their own cell (:func:`unsettled_heads`), so only the others are
    copied to the cells around. There all rows stand on the left of an inner join, whose hot blocks AQE can split; a
    row meets a bounded number of heads.
    """
    place = ["seq", "lon", "lat", "day"]
    with Scratch(df.sparkSession) as scratch:
        heads = scratch.stored(unsettled_heads(block_heads(with_block(df, km, days)).select(*place), km, days))
        earlier = (F.col("x.seq") < F.col("h.seq")) & close_in_space_and_time("h", "x", km, days)
        hit = with_near_head(df.select(*place), heads, earlier, km, days).select("h.seq").distinct()
        fresh = cut_lineage(heads.select("seq").join(hit, "seq", "left_anti").withColumn("_fresh", F.lit(True)))
    return (
        df.join(fresh, "seq", "left").withColumn("seen", F.col("_fresh").isNull()).drop("_fresh")
    )


def unsettled_heads(heads: DataFrame, km: float = DEDUP_KM, days: int = DEDUP_DAYS) -> DataFrame:
    """The ``heads`` without an earlier head close to them in their own cell (of twice the usual side), which holds a
    bounded number of them. Nothing tells the two sides apart, so they are shuffled once."""
    cells = with_node(heads, 2 * km, 2 * days).withColumn("node", F.coalesce("node", F.lit(-1)))
    h, x = cells.alias("h"), cells.alias("x")
    earlier = (F.col("x.seq") < F.col("h.seq")) & close_in_space_and_time("h", "x", km, days)
    return h.join(x, (F.col("h.node") == F.col("x.node")) & F.coalesce(earlier, F.lit(False)), "left_anti").select(*heads.columns)
