"""Label statistics, chip gates and chip selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.classes import DAMAGED, EXCLUDED, INTACT, NODATA
from .ranking import top_per_group

MIN_OBSERVED, MIN_CROP, MIN_DAMAGED, CHIPS_PER_EVENT = 0.5, 0.20, 0.02, 5
CLASS_NAMES = {1: "flooded_cropland", 2: "dry_cropland", 3: "excluded_cropland", 4: "non_cropland", 255: "nodata"}


def class_histogram(cells: DataFrame, by: str) -> DataFrame:
    """Pixels and percent per class and event."""
    counts = cells.groupBy(by, "label").agg(F.count("*").alias("px"))
    totals = counts.groupBy(by).agg(F.sum("px").alias("_all"))
    names = F.create_map(*[F.lit(x) for pair in CLASS_NAMES.items() for x in pair])
    return counts.join(totals, by).select(
        by, F.coalesce(F.get(F.map_values(F.map_filter(names, lambda k, _: k == F.col("label"))), F.lit(0)),
                       F.col("label").cast("string")).alias("label_name"),
        "px", F.bround(100.0 * F.col("px") / F.col("_all"), 3).alias("pct"))


def crop_statistics(cells: DataFrame, by: str, pixel_km2: float) -> DataFrame:
    """Exclusion and cropland shares per event. ``cells``: by, label, exclusion (NULL off swath), crop."""
    excluded = F.col("exclusion") == 1
    crop = F.col("crop") == 1
    n = cells.groupBy(by).agg(
        F.count_if(excluded).alias("exc"), F.count("exclusion").alias("seen"), F.count_if(crop).alias("crop_px"),
        F.count_if(crop & excluded).alias("cropland_in_exclusion_px"),
        F.count_if(F.col("label") == DAMAGED).alias("flooded"))
    return n.select(
        by, F.bround(F.col("exc") / F.greatest("seen", F.lit(1)), 4).alias("aoi_excluded_frac_of_inswath"),
        F.bround(F.col("crop_px") * pixel_km2, 3).alias("cropland_km2"), "cropland_in_exclusion_px",
        F.when(F.col("crop_px") > 0, F.bround(100.0 * F.col("cropland_in_exclusion_px") / F.col("crop_px"), 3))
        .alias("cropland_in_exclusion_pct"),
        F.bround(F.col("flooded") * pixel_km2, 3).alias("cropland_flooded_km2"))


def tile_statistics(cells: DataFrame, by: str, size: int = 512, persistence: bool = True) -> DataFrame:
    """Counts per whole size x size tile; shares are left unrounded until :func:`publish_shares`."""
    tile = [(F.col(a) - F.pmod(a, F.lit(size))).alias(name) for a, name in (("r", "row"), ("c", "col"))]
    label = F.col("label")
    extra = [F.avg(F.when(label == DAMAGED, F.col("persistence"))).alias("persistence_mean")] if persistence else []
    stats = cells.groupBy(by, *tile).agg(
        F.count("*").alias("n_px"), F.count_if(label != NODATA).alias("n_valid"),
        F.count_if(label.isin(DAMAGED, INTACT, EXCLUDED)).alias("crop_px"),
        F.count_if(label == DAMAGED).alias("flooded_crop_px"), F.count_if(label == EXCLUDED).alias("excluded_px"),
        *extra)
    share = lambda c: F.try_divide(F.col(c), F.col("n_valid"))
    return stats.filter(F.col("n_px") == size * size).drop("n_px").withColumns({
        "cropland_frac": share("crop_px"), "flooded_crop_frac": share("flooded_crop_px"),
        "excluded_crop_frac": share("excluded_px")})


def flood_chip_gate(tiles: DataFrame, size: int = 512) -> DataFrame:
    return tiles.filter(
        (F.col("n_valid") >= MIN_OBSERVED * size * size) & (F.col("cropland_frac") >= MIN_CROP)
        & (F.col("flooded_crop_frac") >= MIN_DAMAGED))


def burn_chip_gate(chips: DataFrame) -> DataFrame:
    """``chips``: n_px, crop_px, burned_crop_px."""
    return chips.filter(
        (F.col("crop_px") / F.col("n_px") >= MIN_CROP)
        & (F.col("burned_crop_px") / F.greatest("crop_px", F.lit(1)) >= MIN_DAMAGED))


def publish_shares(tiles: DataFrame) -> DataFrame:
    rounded = {c: F.bround(c, 4) for c in ("cropland_frac", "flooded_crop_frac", "excluded_crop_frac")}
    if "persistence_mean" in tiles.columns:
        rounded["flood_persistence_mean"] = F.bround("persistence_mean", 1)
    return tiles.withColumns(rounded).drop("persistence_mean")


def select_flood_chips(tiles: DataFrame, by: str, k: int = CHIPS_PER_EVENT) -> DataFrame:
    """The k tiles with the largest (rounded) flooded share; ties by row, col. Ranks start at 0."""
    order = [F.col("flooded_crop_frac").desc(), "row", "col"]
    return top_per_group(publish_shares(tiles), [by], order, k).withColumn("rank", F.col("rank") - 1)


def burn_chip_statistics(cells: DataFrame, chip: str = "chip_id") -> DataFrame:
    """Per chip: crop, burned and excluded pixels, shares and mean severity (0 when nothing burned).

    ``cells``: chip, label, crop (0/1), observed (bool), severity (NULL when unobserved).
    """
    n = cells.groupBy(chip).agg(
        F.count("*").alias("n_px"), F.count_if(F.col("crop") == 1).alias("crop_px"),
        F.count_if(F.col("label") == DAMAGED).alias("burned_crop_px"),
        F.count_if(F.col("label") == EXCLUDED).alias("excluded_px"),
        F.avg(F.when(F.col("label") == DAMAGED, F.col("severity"))).alias("_sev"),
        (F.count_if("observed") / F.count("*")).alias("observed_frac"))
    return n.select(
        chip, "n_px", "crop_px", "burned_crop_px",
        F.bround(F.col("crop_px") / F.col("n_px"), 4).alias("cropland_frac"),
        F.bround(F.col("burned_crop_px") / F.col("n_px"), 4).alias("burned_crop_frac"),
        F.bround(F.col("excluded_px") / F.greatest("crop_px", F.lit(1)), 4).alias("excluded_crop_frac"),
        F.coalesce(F.bround("_sev", 2), F.lit(0.0)).alias("burn_severity_mean"),
        F.bround("observed_frac", 4).alias("observed_frac"))
