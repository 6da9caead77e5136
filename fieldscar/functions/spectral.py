"""Band arithmetic on optical and radar values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Band order of the optical stack (the index band is always last) and of radar.
OPTICAL_BANDS = ("B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12", "NDVI")
RADAR_BANDS = ("VV", "VH")
# Lower bounds of burn severity 1 to 4 on dNBR x 1000.
SEVERITY_BOUNDS = (100, 270, 440, 660)
SNOW_INDEX_MIN, SNOW_NIR_MIN, CLEAR_SCORE_MIN = 0.42, 1100, 0.60
FIRE_CLASS_MIN = 7


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def normalized_difference(a, b) -> Column:
    a, b = _col(a), _col(b)
    return F.try_divide(a - b, a + b)


def dnbr(nbr_pre, nbr_post) -> Column:
    return (_col(nbr_pre) - _col(nbr_post)) * 1000


def burn_severity(value) -> Column:
    """0 to 4, lower bounds inclusive; an unknown value is 0."""
    value = _col(value)
    rank = sum(F.when(value >= bound, 1).otherwise(0) for bound in SEVERITY_BOUNDS)
    return rank.cast("int")


def is_snow(green, swir, nir) -> Column:
    index = normalized_difference(green, swir)
    return F.coalesce((index > SNOW_INDEX_MIN) & (_col(nir) > SNOW_NIR_MIN), F.lit(False))


def is_clear(score, green, swir, nir) -> Column:
    return F.coalesce(_col(score) >= CLEAR_SCORE_MIN, F.lit(False)) & ~is_snow(green, swir, nir)


def finite_or_zero(value) -> Column:
    value = _col(value)
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(value.isNull() | bad, 0.0).otherwise(value)


def band_stack(columns: dict) -> Column:
    """Optical bands plus the vegetation index as one float array in the fixed order."""
    with_index = {**columns, "NDVI": normalized_difference(columns["B8A"], columns["B4"])}
    return F.array(*[_col(with_index[name]).cast("float") for name in OPTICAL_BANDS])


def burn_present(value) -> Column:
    return F.coalesce(_col(value) > 0, F.lit(False))


def fire_present(value) -> Column:
    return F.coalesce(_col(value) >= FIRE_CLASS_MIN, F.lit(False))


def unmask_zero(value) -> Column:
    return F.coalesce(_col(value), F.lit(0))
