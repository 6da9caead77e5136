"""Cell operators: overpass reduces, resampling, neighbourhoods, mosaics and windows.

Cells are rows (event keys, r, c, ...); NULL is nodata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.geo import utm_inverse
from ..session import cut_lineage

CELL = ["r", "c"]


def fuse_solar_day(cells: DataFrame, by: list[str], order: str, value: str = "value") -> DataFrame:
    """One value per cell and day: the first valid one in item order."""
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    return cells.groupBy(*by, *CELL).agg(first.alias(value))


def temporal_max(stack: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Highest valid value per cell; NULL where never observed."""
    return stack.groupBy(*by, *CELL).agg(F.max(value).alias(name))


def persistence(flooded: Column, valid: Column) -> Column:
    """Percent of valid overpasses that were flooded, rounded half to even."""
    return F.when(valid > 0, F.bround(100.0 * flooded / valid).cast("int"))


def aggregate_event(stack: DataFrame, by: tuple[str, ...] = ("ev",)) -> DataFrame:
    """All per-cell reduces of an overpass stack in one pass.

    ``stack``: by..., r, c, day, extent, water, exclusion, likelihood.
    """
    hits = F.count_if(F.col("extent") > 0)
    return stack.groupBy(*by, *CELL).agg(
        F.max("extent").alias("extent"), persistence(hits, F.count("extent")).alias("persistence"),
        F.max("water").alias("water"), exclusion_footprint("exclusion").alias("exclusion"),
        F.max("likelihood").alias("likelihood"),
    )


def exclusion_footprint(value: str) -> Column:
    """1 if flagged in any overpass, 0 if only seen, NULL outside every swath."""
    return F.max(F.when(F.col(value).isNotNull(), (F.col(value) == 1).cast("int")))


def flood_series(stack: DataFrame, by: list[str], pixel_km2: float) -> DataFrame:
    """Flooded and valid pixels per overpass day."""
    px = F.count_if(F.col("extent") > 0)
    return stack.groupBy(*by, "day").agg(
        px.alias("flood_px"), F.count("extent").alias("valid_px"), F.bround(px * pixel_km2, 3).alias("flood_km2"))


def event_summary(cells: DataFrame, days: DataFrame, by: str, pixel_km2: float) -> DataFrame:
    """Per event: overpass days, flooded and valid area, mean persistence over flooded cells.

    ``cells``: by, extent, persistence (one row per cell); ``days``: by, day.
    """
    wet = F.col("extent") > 0
    area = cells.groupBy(by).agg(
        F.count_if(wet).alias("event_flood_px"), F.count("extent").alias("event_valid_px"),
        F.coalesce(F.bround(F.avg(F.when(wet, F.col("persistence"))), 1), F.lit(0.0)).alias("flood_persistence_mean"),
    )
    passes = days.select(by, "day").distinct().groupBy(by).agg(
        F.count("*").alias("n_overpasses"), F.array_sort(F.collect_list("day")).alias("overpass_days"))
    return area.join(passes, by, "left").withColumns({
        "event_flood_km2": F.bround(F.col("event_flood_px") * pixel_km2, 3),
        "event_valid_km2": F.bround(F.col("event_valid_px") * pixel_km2, 3),
    })


def flood_screen(events: DataFrame, stack: DataFrame, scenes: DataFrame, by: str, pixel_km2: float,
                 min_pixels: int = 300, min_scenes: int = 1) -> DataFrame:
    """Screen result per event: flooded when 1 on any overpass, box over flooded pixel centres.

    ``stack``: by, r, c, x, y, extent; ``scenes``: by, n_scenes. No rows means a transient miss.
    """
    wet = F.coalesce(F.col("wet"), F.lit(False))
    read = F.coalesce((F.col("n_scenes") >= min_scenes) & F.col("flood_px").isNotNull(), F.lit(False))
    cells = stack.groupBy(by, *CELL).agg(
        F.bool_or(F.col("extent") == 1).alias("wet"), F.max("x").alias("x"), F.max("y").alias("y"))
    found = cells.groupBy(by).agg(
        F.count_if(wet).alias("flood_px"),
        *[fn(F.when(wet, F.col(axis))).alias(name) for name, fn, axis in (
            ("w", F.min, "x"), ("s", F.min, "y"), ("e", F.max, "x"), ("n", F.max, "y"))],
    )
    passed = read & (F.col("flood_px") >= min_pixels)
    return events.select(by).join(scenes, by, "left").join(found, by, "left").select(
        by, F.coalesce("n_scenes", F.lit(0)).cast("long").alias("n_scenes"),
        F.when(read, F.col("flood_px")).otherwise(0).alias("flood_px"),
        F.when(read, F.bround(F.col("flood_px") * pixel_km2, 3)).otherwise(0.0).alias("flood_km2"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.when(~read, "transient").when(passed, "pass").otherwise("no_flood").alias("outcome"),
        *[F.when(read, F.col(side)).alias(f"flood_{side}") for side in "wsen"],
    )


def lonlat_box(screened: DataFrame, epsg: str = "epsg") -> DataFrame:
    """``screened`` (flood_w, flood_s, flood_e, flood_n in metres of ``epsg``) with ``flood_bbox``: the lon/lat bounds of the
    box's corners at 5 decimals, NULL without flooded pixels."""
    metres = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x in ("flood_w", "flood_e") for y in ("flood_s", "flood_n")])
    corners = screened.withColumn("_at", F.transform(metres, lambda p: utm_inverse(p["x"], p["y"], epsg)))
    sides = {"w": (F.array_min, "lon"), "s": (F.array_min, "lat"), "e": (F.array_max, "lon"), "n": (F.array_max, "lat")}
    box = F.struct(*[F.bround(fn(F.col(f"_at.{axis}")), 5).alias(k) for k, (fn, axis) in sides.items()])
    return corners.withColumn("flood_bbox", F.when(F.col("flood_w").isNotNull(), box)).drop("_at")


def resample_nearest(cells: DataFrame, factor: int = 2) -> DataFrame:
    """Split every cell into factor x factor cells of the same value."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    fine = cells.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
    return fine.withColumns({"r": F.col("r") * factor + F.col("_i"), "c": F.col("c") * factor + F.col("_j")}).drop("_i", "_j")


def _neighbours(df: DataFrame, by: list[str], along: str, across: str, value: str,
                names: tuple[str, str], block: int) -> DataFrame:
    """Add the value of the previous and the next cell along one axis (NULL where there is none).
    Cells at a block border are copied into the neighbouring block, so a window spans one block."""
    at = F.col(along)
    spread = df.withColumn("_b", F.explode(F.sequence(
        F.floor((at - 1) / F.lit(block)), F.floor((at + 1) / F.lit(block)))))
    w = W.partitionBy(*by, across, "_b").orderBy(along)
    return spread.withColumns({
        names[0]: F.max(value).over(w.rangeBetween(-1, -1)), names[1]: F.max(value).over(w.rangeBetween(1, 1)),
    }).filter(F.col("_b") == F.floor(at / F.lit(block))).drop("_b")


def halve_cells(cells: DataFrame, by: list[str], nearest: list[str], smooth: list[str], block: int = 2048) -> DataFrame:
    """Halve the cell size: ``nearest`` columns are copied, ``smooth`` columns mix the nearest 2 x 2
    valid sources (9:3:3:1). Every cell first gathers its eight neighbours in two one-axis passes, so
    the four targets are computed in place and no weighted copies are shuffled."""
    line = F.struct(F.col("_west").alias("west"), F.col("_v").alias("mid"), F.col("_east").alias("east"))
    out = cells.select(*by, *CELL, *nearest, F.struct(*smooth).alias("_v"))
    out = _neighbours(out, by, "c", "r", "_v", ("_west", "_east"), block)
    out = out.select(*by, *CELL, *nearest, line.alias("_mid"))
    out = _neighbours(out, by, "r", "c", "_mid", ("_north", "_south"), block)

    def mix(name: str, i: int, j: int) -> Column:
        rows = (("_mid", 0.75), ("_south" if i else "_north", 0.25))
        cols = (("mid", 0.75), ("east" if j else "west", 0.25))
        terms = [(F.col(f"{row}.{col}.{name}"), wr * wc) for row, wr in rows for col, wc in cols]
        total = sum(F.coalesce(v * w, F.lit(0.0)) for v, w in terms)
        weight = sum(F.when(v.isNotNull(), w).otherwise(0.0) for v, w in terms)
        return F.when(weight > 0, total / weight)

    targets = F.explode(F.array(*[
        F.struct((F.col("r") * 2 + i).alias("r"), (F.col("c") * 2 + j).alias("c"), *[mix(v, i, j).alias(v) for v in smooth])
        for i in (0, 1) for j in (0, 1)]))
    return out.select(*by, *nearest, targets.alias("_t")).select(*by, "_t.r", "_t.c", *nearest, *[f"_t.{v}" for v in smooth])


def resample_bilinear(cells: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    return halve_cells(cells, by, [], values)


def dilate(mask: DataFrame, by: list[str], shape: str = "circle") -> DataFrame:
    """Cells within one step of the mask: the 4 neighbours for a circle, 8 for a square."""
    near = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if shape == "square" or dr == 0 or dc == 0]
    moved = F.explode(F.array(*[
        F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c")) for dr, dc in near]))
    return mask.select(*by, moved.alias("_n")).select(*by, "_n.r", "_n.c").distinct()


def mosaic_first(cells: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Overlapping tiles on one grid: the first tile in ``order`` that covers a cell wins."""
    return cells.groupBy(*by, *CELL).agg(F.min_by(value, order).alias(value))


def ordered_mosaic(cells: DataFrame, by: list[str], value: str, rank: Column) -> DataFrame:
    """Value of the best-ranked scene that is valid in the cell (largest ``rank``)."""
    return cells.groupBy(*by, *CELL).agg(F.max_by(value, F.when(F.col(value).isNotNull(), rank)).alias(value))


def align_layers(extent: DataFrame, layers: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Other layers joined onto the extent grid; absent cells are NULL."""
    out = extent
    for name, layer in layers.items():
        out = out.join(layer.select(*by, *CELL, F.col("value").alias(name)), [*by, *CELL], "left")
    return out


def cut_out(cells: DataFrame, chips: DataFrame, size: int) -> DataFrame:
    """Cells of the chosen tiles, re-indexed from each tile's corner. ``chips``: ev, row, col, chip_id."""
    keyed = cells.withColumns({"row": F.col("r") - F.pmod("r", F.lit(size)), "col": F.col("c") - F.pmod("c", F.lit(size))})
    picked = keyed.join(chips.select("ev", "row", "col", "chip_id"), ["ev", "row", "col"])
    return picked.withColumns({"r": F.col("r") - F.col("row"), "c": F.col("c") - F.col("col")}).drop("row", "col")


def grid_mismatches(layers: DataFrame, res: float, tolerance: float = 1e-6) -> DataFrame:
    """Layers off the expected resolution or zone; must be empty. Columns xres, yres, epsg, want_epsg."""
    off = (
        (F.abs(F.abs("xres") - res) > tolerance) | (F.abs(F.abs("yres") - res) > tolerance)
        | (F.col("epsg") != F.col("want_epsg"))
    )
    return layers.filter(F.coalesce(off, F.lit(True)))


def scout_map(cells: DataFrame, by: list[str], factor: int) -> DataFrame:
    """Burned cropland on a coarser grid: 1 where any fine cell is observed, severe, crop and inside."""
    hit = F.col("observed") & (F.col("severity") >= 1) & F.col("crop") & F.col("in_perimeter")
    coarse = [F.floor(F.col(a) / F.lit(factor)).cast("long").alias(a) for a in CELL]
    return cells.groupBy(*by, *coarse).agg(F.max(F.coalesce(hit, F.lit(False)).cast("int")).alias("burned_crop"))


def _moving_sum(df: DataFrame, by: list[str], along: str, across: str, value: str,
                back: int, ahead: int, block: int) -> DataFrame:
    """Sum over [p - back, p + ahead] along one axis, as the difference of two running sums (exact for whole
    numbers), so the work does not depend on the width. Rows near a block border are copied into the
    next block, so a window never spans more than one block."""
    at = F.col(along)
    home = F.floor(at / F.lit(block))
    spread = df.withColumn("_b", F.explode(F.sequence(
        F.floor((at - ahead) / F.lit(block)), F.floor((at + back) / F.lit(block)))))
    line = W.partitionBy(*by, across, "_b").orderBy(along)
    upto, before = (F.coalesce(F.sum(value).over(line.rangeBetween(W.unboundedPreceding, end)), F.lit(0.0)) for end in (ahead, -back - 1))
    return spread.withColumn(value, upto - before).filter(F.col("_b") == home).drop("_b")


def box_density(grid: DataFrame, by: list[str], value: str, win: int, block: int = 2048) -> DataFrame:
    """Mean over a win x win window with zeros outside the grid, as two one-axis passes."""
    back, ahead = win // 2, win - win // 2 - 1
    summed = grid.select(*by, *CELL, F.col(value).cast("double").alias("density"))
    summed = _moving_sum(summed, by, "c", "r", "density", back, ahead, block)
    summed = _moving_sum(summed, by, "r", "c", "density", back, ahead, block)
    return summed.withColumn("density", F.col("density") / (win * win))


def block_of(r: str, c: str, block: int) -> list[Column]:
    return [F.floor(F.col(r) / block).alias("br"), F.floor(F.col(c) / block).alias("bc")]


def boxes_in_blocks(boxes: DataFrame, block: int) -> DataFrame:
    """One row per block that a half-open box (r0, c0, r1, c1) meets."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / block), F.floor((F.col(b) - 1) / block))
    return boxes.withColumn("br", F.explode(span("r0", "r1"))).withColumn("bc", F.explode(span("c0", "c1")))


def inside_box(cell: str, box: str) -> Column:
    """Whether a cell (r, c, br, bc) lies in a box in blocks, for joins of the two aliases."""
    x, s = (lambda n: F.col(f"{cell}.{n}")), (lambda n: F.col(f"{box}.{n}"))
    return ((x("br") == s("br")) & (x("bc") == s("bc")) & (x("r") >= s("r0")) & (x("r") < s("r1"))
            & (x("c") >= s("c0")) & (x("c") < s("c1")))


def pick_centres(density: DataFrame, shape: DataFrame, by: str, win: int, k: int = 5) -> DataFrame:
    """Up to ``k`` window centres per event: highest density first, each pick suppressing the square
    [r - win, r + win) around it; row-major order on ties; windows may not leave the grid.

    ``shape``: by, height, width. The open cells are written once and read in every round. Cells meet
    the squares of the picks by event and block, so a large event is spread over its blocks.
    """
    m, block = win // 2, max(64, win)
    inside = cut_lineage(density.join(shape, by).filter(
        (F.col("density") > 0) & (F.col("r") >= m) & (F.col("r") < F.col("height") - m)
        & (F.col("c") >= m) & (F.col("c") < F.col("width") - m)
    ).select(by, *CELL, "density", *block_of("r", "c", block)))
    pick = F.max_by(F.struct("r", "c", "density"), F.struct(F.col("density"), -F.col("r"), -F.col("c"))).alias("_p")
    picks = cut_lineage(inside.groupBy(by).agg(pick).select(by, F.array("_p").alias("picks")))
    for _ in range(k - 1):
        squares = boxes_in_blocks(picks.select(by, F.explode("picks").alias("p")).select(
            by, (F.col("p.r") - win).alias("r0"), (F.col("p.c") - win).alias("c0"),
            (F.col("p.r") + win).alias("r1"), (F.col("p.c") + win).alias("c1")), block).alias("s")
        x = inside.alias("x")
        hit = (F.col(f"x.{by}") == F.col(f"s.{by}")) & inside_box("x", "s")
        best = x.join(squares, hit, "left_anti").groupBy(by).agg(pick)
        grown = F.when(F.col("_p").isNull(), F.col("picks")).otherwise(F.concat("picks", F.array("_p")))
        picks = cut_lineage(picks.join(best, by, "left").select(by, grown.alias("picks")))
    return picks.select(by, F.posexplode("picks").alias("_at", "_p")).select(
        by, (F.col("_at") + 1).alias("rank"), "_p.r", "_p.c", "_p.density")
