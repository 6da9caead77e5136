"""Growth-cycle rules. Cycle dates are day numbers since 2000-01-01; 32000 and above is fill."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fill marker, last covered year, stage names, published source and method texts.
FILL = 32000
LAST_YEAR = 2024
STAGES = ("dormant", "green-up", "peak/maturity", "senescence")
SOURCE = "VIIRS VNP22Q2.002 land-surface phenology (500 m, yearly)"
METHOD = ("per-pixel stage from that pixel's own transition dates across 4 candidate cycles "
          "(granules Y-1,Y x cycles 1,2); majority vote over the chip")
NOTE_NO_CYCLE = "no fill-free, monotonic VNP22Q2 cycle over this chip"
NOTE_OUT_OF_RANGE = "VNP22Q2 land-surface phenology covers 2013-2024; no data for event year "


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def coherent(inc, peak, dec, low) -> Column:
    dates = [_col(d) for d in (inc, peak, dec, low)]
    ok = F.lit(True)
    for date in dates:
        ok = ok & (date < FILL)
    for earlier, later in zip(dates, dates[1:]):
        ok = ok & (earlier < later)
    return F.coalesce(ok, F.lit(False))


def contains(inc, low, day) -> Column:
    return F.coalesce((_col(inc) <= _col(day)) & (_col(low) >= _col(day)), F.lit(False))


def stage_code(inc, peak, dec, low, day) -> Column:
    """1 to 3 inside the cycle (both ends inclusive), 0 outside."""
    day = _col(day)
    return (
        F.when(~contains(inc, low, day), 0)
        .when(day < _col(peak), 1).when(day < _col(dec), 2).otherwise(3)
    )


def stage_name(code) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STAGES]), _col(code).cast("int") + 1)


def cycle_name(code) -> Column:
    """Codes are 10 * (0 previous year, 1 event year) + cycle number."""
    code = _col(code).cast("int")
    which = F.when(code < 10, "previous").otherwise("event")
    return F.when(code > 0, F.concat(which, F.lit("-year cycle "), F.pmod(code, F.lit(10)).cast("string")))


def coverage_note(year) -> Column:
    year = _col(year)
    return F.when(year > LAST_YEAR, F.concat(F.lit(NOTE_OUT_OF_RANGE), year.cast("string")))
