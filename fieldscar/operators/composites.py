"""Composite operators: flood labels and chips, burn labels and chips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classes as C, spectral as B
from ..functions.text import chip_id
from . import labels as L, raster as R
from .imagery import clear_share


def flood_label(stack: DataFrame, cropland: DataFrame) -> DataFrame:
    """Overpass stack to the label grid: temporal reduces, halved cell size, classes.

    ``stack``: ev, r, c, day, extent, water, exclusion, likelihood on the native grid;
    ``cropland``: ev, r, c, crop (bool) on the label grid. Class layers are split, smooth layers
    interpolated.
    """
    reduced = R.aggregate_event(stack)
    cells = R.halve_cells(reduced, ["ev"], ["extent", "water", "exclusion"], ["likelihood", "persistence"])
    cells = cells.join(cropland, ["ev", "r", "c"], "left")
    rounded = {v: F.round(v).cast("int") for v in ("likelihood", "persistence")}
    return cells.withColumns(rounded).withColumn("label", C.flood_class("extent", "crop", "exclusion"))


def flood_chips(cells: DataFrame, size: int, k: int = L.CHIPS_PER_EVENT) -> DataFrame:
    """The best k tiles per event that pass the gates, with ids, ranks and published shares."""
    tiles = L.tile_statistics(cells, "ev", size)
    chosen = L.select_flood_chips(L.flood_chip_gate(tiles, size), "ev", k)
    return chosen.withColumn("chip_id", chip_id(F.concat(F.lit("E"), F.col("ev").cast("string")), "row", "col"))


def optical_mosaic(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Clearest-first mosaic: each cell takes the clear pixel of the scene with the largest clear share.

    ``pixels``: ev, r, c, scene_id, clear (bool), red, bands...
    """
    shares = clear_share(pixels, ["ev"]).filter("clear_frac IS NOT NULL").select("ev", "scene_id", "clear_frac")
    ranked = pixels.filter("clear").join(shares, ["ev", "scene_id"])
    best = F.max_by(F.struct(*bands), F.struct(F.col("clear_frac"), F.col("scene_id")))
    return ranked.groupBy("ev", "r", "c").agg(best.alias("_b")).select("ev", "r", "c", "_b.*")


def burn_label(pre: DataFrame, post: DataFrame, grid: DataFrame, perimeter: DataFrame) -> DataFrame:
    """dNBR, severity and class per cell. ``pre`` / ``post``: ev, r, c, b8, b12; ``grid``: ev, r, c,
    crop (0/1); ``perimeter``: ev, r, c of the grown burn perimeter."""
    index = lambda df, name: df.select("ev", "r", "c", B.normalized_difference("b8", "b12").alias(name))
    key = ["ev", "r", "c"]
    cells = (
        grid.join(index(pre, "nbr_pre"), key, "left").join(index(post, "nbr_post"), key, "left")
        .join(perimeter.select(*key, F.lit(True).alias("in_perimeter")), key, "left")
    )
    cells = cells.withColumns({
        "dnbr": B.dnbr("nbr_pre", "nbr_post"), "in_perimeter": F.coalesce("in_perimeter", F.lit(False)),
        "observed": F.col("nbr_pre").isNotNull() & F.col("nbr_post").isNotNull()})
    cells = cells.withColumn("severity", F.when(F.col("observed"), B.burn_severity("dnbr")))
    return cells.withColumn("label", C.burn_class("severity", F.col("crop") == 1, "observed", "in_perimeter"))


def burn_chips(cells: DataFrame, win: int, k: int = L.CHIPS_PER_EVENT) -> DataFrame:
    """Windows with the densest burned cropland that pass the gates, with their statistics."""
    grid = cells.withColumn("burned", (F.col("label") == C.DAMAGED).cast("int"))
    shape = cells.groupBy("ev").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
    centres = R.pick_centres(R.box_density(grid, ["ev"], "burned", win), shape, "ev", win, k)
    low = win // 2
    boxes = centres.select(
        "ev", "rank", F.col("r").alias("cr"), F.col("c").alias("cc"),
        chip_id(F.concat(F.lit("E"), F.col("ev").cast("string")), "r", "c").alias("chip_id"))
    block = max(64, win)
    spread = R.boxes_in_blocks(boxes.withColumns({
        "r0": F.col("cr") - low, "c0": F.col("cc") - low, "r1": F.col("cr") - low + win, "c1": F.col("cc") - low + win}), block).alias("s")
    x = cells.select("*", *R.block_of("r", "c", block)).alias("x")
    cut = x.join(spread, (F.col("x.ev") == F.col("s.ev")) & R.inside_box("x", "s")).select("x.*", "s.rank", "s.cr", "s.cc", "s.chip_id")
    stats = L.burn_chip_gate(L.burn_chip_statistics(cut))
    return boxes.select("chip_id", "ev", "rank").join(stats, "chip_id")
