"""Label classes of a cell. NULL means nodata inside; 255 is written at the sink."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAMAGED, INTACT, EXCLUDED, NON_CROP, NODATA = 1, 2, 3, 4, 255
WORLDCOVER_CROP = 40
# Crop-type codes that are not cropland.
NON_CROP_CODES = (0, 63, 64, 65, 81, 82, 83, 87, 88, 111, 112, 121, 122, 123, 124, 131, 141, 142, 143,
                  152, 176, 190, 195)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _true(value) -> Column:
    return F.coalesce(_col(value), F.lit(False))


def worldcover_crop(code) -> Column:
    return F.coalesce(_col(code) == WORLDCOVER_CROP, F.lit(False))


def typed_crop(code) -> Column:
    return F.coalesce((_col(code) > 0) & ~_col(code).isin(*NON_CROP_CODES), F.lit(False))


def cropland_mask(kind, code) -> Column:
    return F.when(_col(kind) == "cdl", typed_crop(code)).otherwise(worldcover_crop(code))


def flood_class(extent, crop, exclusion) -> Column:
    """extent NULL = never observed; unobserved crop beats excluded, excluded beats flooded."""
    extent, crop = _col(extent), _true(crop)
    return (
        F.when(~crop, NON_CROP)
        .when(extent.isNull(), NODATA)
        .when(_true(_col(exclusion) == 1), EXCLUDED)
        .when(extent > 0, DAMAGED)
        .otherwise(INTACT)
    )


def observed_or_nodata(value, extent) -> Column:
    """Byte layer value, 255 where the flood extent was never observed or the layer is absent."""
    return F.when(_col(extent).isNull(), NODATA).otherwise(F.coalesce(_col(value), F.lit(NODATA)))


def burn_class(severity, crop, observed, in_perimeter) -> Column:
    crop, observed = _true(crop), _true(observed)
    burned = observed & _true(_col(severity) >= 1) & _true(in_perimeter)
    return (
        F.when(~crop, NON_CROP).when(~observed, EXCLUDED).when(burned, DAMAGED).otherwise(INTACT)
    )


def dnbr_byte(value, observed) -> Column:
    """dNBR stored as (dNBR + 500) / 8, clipped to 0..254 and truncated."""
    scaled = F.least(F.greatest((_col(value) + 500) / 8, F.lit(0.0)), F.lit(254.0))
    return F.when(_true(observed), F.floor(scaled).cast("int")).otherwise(NODATA)


def severity_byte(severity, observed) -> Column:
    clipped = F.least(F.greatest(_col(severity).cast("int"), F.lit(0)), F.lit(4))
    return F.when(_true(observed), clipped).otherwise(NODATA)
