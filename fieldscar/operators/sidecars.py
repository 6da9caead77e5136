"""Nested chip documents: building them and patching blocks by chip id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quality import IMAGES
from ..functions.text import burn_provenance
from .imagery import optical_record, radar_note, radar_record

# Band names and notes of the published burn document.
OPTICAL_BANDS = ("B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12", "NDVI")
RADAR_BANDS = ("VV", "VH")
FIRST_CHECK = ("chip QC", "download success per raster + S2 observability (clear pre AND post) fraction")


def patch_block(sidecars: DataFrame, blocks: DataFrame, name: str) -> DataFrame:
    """Attach or replace block ``name`` (a column of ``blocks``); chips without one stay untouched."""
    fresh = blocks.select("chip_id", F.col(name).alias("_new"), F.lit(True).alias("_has"))
    joined = sidecars.join(fresh, "chip_id", "left")
    if name in sidecars.columns:
        value = F.when(F.col("_has"), F.col("_new")).otherwise(F.col(name))
    else:
        value = F.col("_new")
    return joined.withColumn(name, value).drop("_new", "_has")


def orphans(sidecars: DataFrame, blocks: DataFrame) -> DataFrame:
    return sidecars.join(blocks, "chip_id", "left_anti")


def still_to_do(sidecars: DataFrame, block: str, force: bool = False) -> DataFrame:
    """Chips without the block yet; all of them when forced."""
    return sidecars if force else sidecars.filter(F.col(block).isNull())


def flood_sidecar(provenance: Column) -> Column:
    """The flood chip document from chip and event columns."""
    place = F.coalesce("place", "country")
    return F.struct(
        "chip_id", "event_id", "rank", "source", "tier", "continent",
        F.coalesce("country", "place").alias("country"), place.alias("place"), provenance.alias("provenance"),
        F.coalesce("event_date_start", "date_start").alias("event_date_start"),
        F.coalesce("event_date_end", "date_end").alias("event_date_end"),
        "crs", "res_m", "size", "label_path", "flood_persistence_mean", "cropland_frac", "flooded_crop_frac",
        "flooded_crop_px", "excluded_crop_frac", "min_lon", "min_lat", "max_lon", "max_lat")


def image_path(name: str) -> Column:
    """Path below the chips root: event folder, chip id, image name."""
    return F.format_string(f"%s/%s_{name}.tif", "event_id", "chip_id")


def first_check(observed_frac: str) -> Column:
    """The qc block that a new burn chip gets: which images came, and how much of it both windows saw."""
    came = {k: F.coalesce(F.col(f"has_{k}"), F.lit(False)) for k in IMAGES}
    every = came[IMAGES[0]] & came[IMAGES[1]] & came[IMAGES[2]] & came[IMAGES[3]]
    return F.struct(
        every.alias("all_rasters_ok"),
        F.struct(*[F.when(c, "ok").otherwise("missing").alias(k) for k, c in came.items()]).alias("rasters"),
        F.bround(observed_frac, 4).alias("observed_frac"),
        F.when(every & (F.col(observed_frac) > 0.5), "clean").otherwise("check").alias("verdict"),
        F.lit(FIRST_CHECK[0]).alias("source"), F.lit(FIRST_CHECK[1]).alias("method"))


def burn_imagery() -> Column:
    """The four image records (a radar image without a scene is NULL), the radar note and both optical windows."""
    optical = {k: optical_record(f"{k}_date", f"{k}_clear", f"{k}_n", image_path(k), OPTICAL_BANDS) for k in ("s2_pre", "s2_post")}
    radar = {k: radar_record(f"{k}_n", f"{k}_date", image_path(k), f"{k}_pass", f"{k}_orbit", RADAR_BANDS) for k in ("s1_pre", "s1_post")}
    window = lambda k: F.array(*[F.date_format(f"{k}_{end}", "yyyy-MM-dd") for end in ("first", "last")])
    return F.struct(
        *[record.alias(k) for k, record in (optical | radar).items()],
        radar_note("s1_pre_n", "s1_post_n").alias("s1_note"), window("s2_pre").alias("s2_pre_window"), window("s2_post").alias("s2_post_window"))


def burn_sidecar() -> Column:
    """The burn chip document from chip, event and scene columns; shares of the whole chip, but
    ``excluded_crop_frac`` of its cropland; ranks from 1."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return F.struct(
        "chip_id", "event_id", (F.col("rank") + 1).alias("rank"), "source", "tier", "continent", "country", "place",
        burn_provenance("tier", "n_indep", "burn_km2", "modis_frac", "viirs_frac", "af_count").alias("provenance"),
        text("event_date_start"), text("event_date_end"), F.format_string("EPSG:%d", "epsg").alias("crs"), "res_m", "size",
        image_path("label").alias("label_path"), F.bround(F.coalesce("burn_severity_mean", F.lit(0.0)), 2).alias("burn_severity_mean"),
        F.bround("cropland_frac", 4).alias("cropland_frac"), F.bround(F.col("burned_crop_px") / F.col("label_px"), 4).alias("burned_crop_frac"),
        "burned_crop_px", F.bround(F.col("excluded_px") / F.greatest("cropland_px", F.lit(1)), 4).alias("excluded_crop_frac"),
        *[F.bround(c, 6).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")],
        burn_imagery().alias("imagery"), first_check("observed_frac").alias("qc"))
