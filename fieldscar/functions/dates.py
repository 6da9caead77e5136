"""Calendar column expressions. Everything is zone-free DATE arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH_2000 = "2000-01-01"

# Imagery search windows in days around ignition (start) and fire end.
BURN_OPTICAL_PRE = (-110, -8)
BURN_OPTICAL_POST = (10, 75)
BURN_RADAR_PRE_SHIFT, BURN_RADAR_PRE_BACK = -5, 60
BURN_RADAR_POST_SHIFT, BURN_RADAR_POST_FORWARD = 8, 75
FLOOD_TOLERANCE_DAYS = 30


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def pad_window(start, end, back: int, forward: int) -> Column:
    return F.struct(
        F.date_sub(_col(start), back).alias("start"), F.date_add(_col(end), forward).alias("end")
    )


def day_of_year_date(year, doy) -> Column:
    first = F.make_date(_col(year).cast("int"), F.lit(1), F.lit(1))
    return F.date_add(first, _col(doy).cast("int") - 1)


def days_since_2000(day) -> Column:
    return F.date_diff(_col(day), F.lit(EPOCH_2000).cast("date"))


def date_from_2000(number) -> Column:
    """Inverse of :func:`days_since_2000`; fractions round half to even."""
    return F.date_add(F.lit(EPOCH_2000).cast("date"), F.bround(_col(number)).cast("int"))


def _window(base: Column, low: int, high: int) -> Column:
    return F.struct(F.date_add(base, low).alias("start"), F.date_add(base, high).alias("end"))


def burn_search_windows(ignition, fire_end) -> Column:
    """Half-open search windows [start, end) of the four burn images."""
    ignition, fire_end = _col(ignition), _col(fire_end)
    s1_pre, s1_post = BURN_RADAR_PRE_SHIFT, BURN_RADAR_POST_SHIFT
    return F.struct(
        _window(ignition, *BURN_OPTICAL_PRE).alias("s2_pre"),
        _window(fire_end, *BURN_OPTICAL_POST).alias("s2_post"),
        _window(ignition, s1_pre - BURN_RADAR_PRE_BACK, s1_pre).alias("s1_pre"),
        _window(fire_end, s1_post, s1_post + BURN_RADAR_POST_FORWARD).alias("s1_post"),
    )


def flood_search_windows(start, end, tolerance: int = FLOOD_TOLERANCE_DAYS) -> Column:
    """Half-open windows before the flood starts and after it ends."""
    return F.struct(
        _window(_col(start), -tolerance, 0).alias("pre"), _window(_col(end), 0, tolerance).alias("post")
    )


def month_window(year, month) -> Column:
    """[first of month, first of next month)."""
    first = F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))
    return F.struct(first.alias("start"), F.add_months(first, 1).alias("end"))
