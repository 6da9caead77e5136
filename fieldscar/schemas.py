"""Column lists and types of the published tables (order is part of the format)."""

from __future__ import annotations

RING_ARRAY = "array<array<struct<x:double,y:double>>>"

CANDIDATE_COLUMNS = {
    "event_id": "string", "source": "string", "tier": "string", "date_start": "date", "date_end": "date",
    "bbox_w": "double", "bbox_s": "double", "bbox_e": "double", "bbox_n": "double",
    "country": "string", "continent": "string", "year": "int", "magnitude": "double", "cause": "string",
    "glide": "string", "area_km2_reported": "double", "match_ems": "boolean", "match_dfo": "boolean",
    "match_ifrc": "boolean", "n_indep": "int", "notes": "string", "rings": RING_ARRAY,
}

FLOOD_MANIFEST = {
    "event_id": "string", "source": "string", "tier": "string",
    "bbox_w": "double", "bbox_s": "double", "bbox_e": "double", "bbox_n": "double",
    "date_start": "date", "date_end": "date", "event_date_start": "date", "event_date_end": "date",
    "year": "int", "continent": "string", "country": "string", "magnitude": "double",
    "cause": "string", "glide": "string", "area_km2_reported": "double", "match_ems": "boolean",
    "match_dfo": "boolean", "match_ifrc": "boolean", "n_indep": "int", "aoi_tightened": "boolean",
    "gfm_n_scenes": "int", "gfm_n_overpass_days": "int", "gfm_flood_px": "int", "gfm_flood_km2": "double",
    "notes": "string",
}

BURN_MANIFEST = {
    "event_id": "string", "source": "string", "tier": "string",
    "bbox_w": "double", "bbox_s": "double", "bbox_e": "double", "bbox_n": "double",
    "date_start": "date", "date_end": "date", "event_date_start": "date", "event_date_end": "date",
    "year": "int", "continent": "string", "country": "string", "place": "string",
    "area_km2_reported": "double", "match_modis": "boolean", "match_viirs": "boolean", "match_af": "boolean",
    "n_indep": "int", "aoi_tightened": "boolean", "modis_frac": "double", "viirs_frac": "double",
    "af_count": "int", "burn_km2": "double", "crop_frac": "double", "n_chips": "int", "notes": "string",
}

CHIP_LIST = ("chip_id", "event_id", "min_lon", "min_lat", "max_lon", "max_lat", "event_date_start",
             "event_date_end", "flooded_crop_frac", "flooded_crop_px", "cropland_frac", "continent", "tier")

QC_IMAGE = ("chip_id", "event_id", "raster", "continent", "country", "year", "clear_frac", "status",
            "nodata_frac", "edge_cc", "white_frac", "vis_med", "valid_std", "is_partial", "is_white",
            "is_corrupt", "is_empty", "is_speckle", "is_cloudy", "note")

QC_CHIP = ("chip_id", "event_id", "continent", "year", "s2_pre_status", "s2_post_status", "s1_pre_status",
           "s1_post_status", "s2_usable", "s1_usable", "is_missing", "is_white", "is_partial", "is_corrupt",
           "is_empty", "is_speckle", "is_cloudy", "n_bad_rasters", "verdict")

LABEL_BANDS = ("label", "damage", "exclusion", "crop", "severity")


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
