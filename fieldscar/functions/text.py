"""Identifiers, lenient parsing and provenance structs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Name under which a source is published, and the three fire confirmations.
NEWS_ORIGIN = "Groundsource (news)"
BURN_ORIGIN = "MCD64A1 burned-area clustering (GlobFire method)"
BURN_CONFIRMED_BY = ("MODIS MCD64A1", "VIIRS VNP64A1", "VIIRS VNP14A1 active fire")


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_bool(value) -> Column:
    text = F.lower(F.trim(_col(value).cast("string")))
    return F.coalesce(text.isin("true", "1", "yes"), F.lit(False))


def archive_event_id(report_number) -> Column:
    return F.concat(F.lit("DFO"), _col(report_number).cast("long").cast("string"))


def news_event_id(uuid) -> Column:
    return F.concat(F.lit("GS"), F.substring(_col(uuid), 1, 12))


def burn_event_id(lon, lat, year) -> Column:
    """MC + year + 8 digits from a deterministic hash of the rounded place and year."""
    year = _col(year).cast("int")
    place = F.xxhash64(F.bround(_col(lon), 3), F.bround(_col(lat), 3), year)
    return F.format_string("MC%d%08d", year, F.pmod(place, F.lit(100_000_000).cast("long")))


def chip_id(event_id, row, col) -> Column:
    return F.format_string("%s_r%04d_c%04d", _col(event_id), _col(row), _col(col))


def batch_label(number) -> Column:
    return F.format_string("b%02d", _col(number).cast("int"))


def lenient_date(text) -> Column:
    """First ten characters as a date, NULL when they are not one."""
    return F.try_to_date(F.substring(_col(text).cast("string"), 1, 10), "yyyy-MM-dd")


def lenient_double(text) -> Column:
    """Number with thousands commas removed, NULL when it is not one."""
    return F.regexp_replace(_col(text).cast("string"), ",", "").try_cast("double")


def flood_provenance(source, tier, ems, dfo, ifrc, flood_km2) -> Column:
    confirmed = F.array_compact(F.array(
        F.lit("GFM"), F.when(as_bool(ems), "EMS"), F.when(as_bool(dfo), "DFO"), F.when(as_bool(ifrc), "IFRC"),
    ))
    return F.struct(
        F.when(_col(source) == "groundsource", NEWS_ORIGIN).otherwise(_col(source)).alias("origin"),
        confirmed.alias("confirmed_by"),
        F.size(confirmed).alias("n_independent"),
        _col(tier).alias("tier"),
        _col(flood_km2).cast("double").alias("gfm_flood_km2"),
    )


def burn_provenance(tier, n_indep, burn_km2, modis_frac, viirs_frac, af_count) -> Column:
    return F.struct(
        F.lit(BURN_ORIGIN).alias("origin"),
        F.array(*[F.lit(name) for name in BURN_CONFIRMED_BY]).alias("confirmed_by"),
        _col(n_indep).cast("int").alias("n_independent"),
        _col(tier).alias("tier"),
        _col(burn_km2).cast("double").alias("burn_km2"),
        _col(modis_frac).cast("double").alias("modis_frac"),
        _col(viirs_frac).cast("double").alias("viirs_frac"),
        _col(af_count).cast("int").alias("active_fire_px"),
    )


def tier_rank(tier) -> Column:
    """Visit preference of a tier: A and C alike, then B, then anything else."""
    tier = _col(tier)
    return F.when(tier.isin("A", "C"), 0).when(tier == "B", 1).otherwise(2)
