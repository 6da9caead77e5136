"""Fire patches, their verification, and acceptance in visiting order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.spectral import burn_present, fire_present, unmask_zero
from ..session import cut_lineage
from . import matching as M
from .components import connected_components
from .ranking import kth_smallest, ranked, top_per_group

MIN_AREA_KM2, MAX_AREA_KM2, MIN_CROP_SHARE = 50.0, 20000.0, 0.15
MIN_VERIFY_SHARE, MIN_ACTIVE_FIRES, VERIFY_PAD_DAYS, MIN_PATCH_CELLS = 0.20, 3, 45, 20
ACCEPTED_PER_CELL = 8


def fire_patches(cells: DataFrame, by: list[str], min_cells: int = MIN_PATCH_CELLS, block: int = 256) -> DataFrame:
    """Patch label of burned cells: 4-neighbour components of the cells whose 8-neighbour
    component has at least ``min_cells`` cells. ``cells``: by..., r, c of burned cells only."""
    wide = connected_components(cells, by, diagonal=True, block=block).withColumnRenamed("label", "_wide")
    big = wide.groupBy(*by, "_wide").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_cells).drop("_n")
    kept = wide.join(big, [*by, "_wide"], "left_semi").drop("_wide")
    return connected_components(kept, by, diagonal=False, block=block)


def enrich_patches(cells: DataFrame, by: list[str]) -> DataFrame:
    """Area, centroid, first and last burn day and mean cropland share per patch.

    ``cells``: by..., label, x, y, km2, doy, crop (0/1).
    """
    return cells.groupBy(*by, "label").agg(
        F.sum("km2").alias("km2"), F.avg("x").alias("lon"), F.avg("y").alias("lat"),
        F.min("doy").alias("doy_min"), F.max("doy").alias("doy_max"), F.avg("crop").alias("crop_frac"),
    )


def patch_gates(patches: DataFrame) -> DataFrame:
    return patches.filter(
        F.col("km2").between(MIN_AREA_KM2, MAX_AREA_KM2) & (F.col("crop_frac") >= MIN_CROP_SHARE)
        & F.col("crop_frac").isNotNull() & F.col("doy_min").isNotNull()
    )


def verify_patches(patches: DataFrame, footprint: DataFrame, observations: DataFrame, key: list[str],
                   place: list[str], pad_days: int = VERIFY_PAD_DAYS) -> DataFrame:
    """Sensor agreement inside each patch within its burn days +- ``pad_days``.

    ``footprint``: key..., place... (the cells of a patch; columns may be in both lists);
    ``observations``: place..., sensor ('modis' | 'viirs' | 'fire'), day, value. Cells without any
    observation count as 0.
    """
    both = list(dict.fromkeys([*key, *place]))
    window = patches.select(*key, F.date_sub("day_min", pad_days).alias("_from"),
                            F.date_add("day_max", pad_days).alias("_to"))
    spots = footprint.select(*both).join(window, key)
    peaks = (
        spots.join(observations, place)
        .filter((F.col("day") >= F.col("_from")) & (F.col("day") < F.col("_to")))
        .groupBy(*both).agg(*[
            F.max(F.when(F.col("sensor") == s, F.col("value"))).alias(s) for s in ("modis", "viirs", "fire")])
    )
    filled = spots.join(peaks, both, "left")
    return filled.groupBy(*key).agg(
        F.avg(unmask_zero(burn_present("modis").cast("int"))).alias("modis_frac"),
        F.avg(unmask_zero(burn_present("viirs").cast("int"))).alias("viirs_frac"),
        F.sum(fire_present("fire").cast("int")).alias("af_count"),
    )


def confirmed(df: DataFrame) -> DataFrame:
    """All three sensors must agree; an absent value is 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return df.filter(
        (zero("modis_frac") >= MIN_VERIFY_SHARE) & (zero("viirs_frac") >= MIN_VERIFY_SHARE)
        & (zero("af_count").cast("int") >= MIN_ACTIVE_FIRES)
    )


def fetch_per_cell(patches: DataFrame, cell: list[str], cap: int | None = None) -> DataFrame:
    """The first ``cap`` patches of every (month, year, region) cell in ``seq`` order; all without a cap."""
    if cap is None:
        return patches
    return top_per_group(patches, cell, ["seq"], cap, "_fetched").drop("_fetched")


def build_order(patches: DataFrame, regions: list[str], position: str) -> DataFrame:
    """Add ``seq``, the turn of every patch: months first, then years, then regions in their order (one that is
    not listed before all), then the ``position`` inside the cell."""
    index = F.coalesce(F.array_position(F.array(*map(F.lit, regions)), F.col("continent")), F.lit(0)).cast("int")
    return ranked(patches.withColumn("_region", index), [], ["month", "year", "_region", position], "seq").drop("_region")


def accept_events(candidates: DataFrame, cell: list[str], per_cell: int = ACCEPTED_PER_CELL,
                  total: int | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """Accept verified candidates in ``seq`` order: not close to an earlier accepted event and
    fewer than ``per_cell`` accepted before it in its cell.

    ``candidates``: seq (unique), lon, lat, day, cell columns. ``accepted`` (lon, lat, day) are
    events of earlier runs. Each round settles, per block, the earliest open row that no earlier
    open row can still suppress; then everything close to a new event is dropped. A block admits
    one event at most, so a round is linear in the open rows. With ``total``, rows after the ``total``-th
    event found so far are dropped as well: events that are found later can only move that place forward.
    """
    columns = candidates.columns
    lean = candidates.select("seq", "lon", "lat", "day", *cell)
    open_rows = M.with_block(lean)
    if accepted is not None:
        old = M.with_block(accepted.select("lon", "lat", "day").distinct().withColumn("seq", F.lit(-1).cast("long")))
        open_rows = _drop_close(open_rows, old)
    open_rows = cut_lineage(open_rows)
    rounds: list[DataFrame] = []
    used, found, last = None, 0, None
    while not open_rows.isEmpty():
        heads = M.block_heads(open_rows)
        waits = M.with_near_head(
            open_rows, heads, (F.col("x.seq") < F.col("h.seq")) & M.close_in_space_and_time("h", "x"),
        ).select(F.col("h.seq").alias("seq")).distinct()
        room = _room_left(open_rows, used, cell, per_cell)
        new = cut_lineage(heads.join(waits, "seq", "left_anti").join(room, "seq", "left_semi"))
        rounds.append(new)
        used = _used_slots(used, new, cell)
        if total is not None:
            found += new.count()
            if found >= total:
                top = used.filter(F.lit(True) if last is None else F.col("seq") <= last)
                high = last if last is not None else top.agg(F.max("seq")).first()[0]
                last = kth_smallest(top, "seq", total, top.agg(F.min("seq")).first()[0] - 1, high) if total else 0
                open_rows = open_rows.filter(F.col("seq") < last)
        open_rows = cut_lineage(_within_cap(_drop_close(open_rows, new), used, new, cell, per_cell))
    if not rounds:
        return candidates.limit(0)
    taken = reduce(DataFrame.unionByName, [r.select("seq") for r in rounds])
    out = candidates.join(taken, "seq", "left_semi").select(*columns)
    return out if last is None else out.filter(F.col("seq") <= last)


def _drop_close(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Open rows that are neither a new event nor close to one."""
    hits = M.with_near_head(
        rows, events, (F.col("x.seq") >= F.col("h.seq")) & M.close_in_space_and_time("x", "h"),
    ).select(F.col("x.seq").alias("seq")).distinct()
    return rows.join(hits, "seq", "left_anti")


def _used_slots(used: DataFrame | None, new: DataFrame, cell: list[str]) -> DataFrame:
    taken = new.select(*cell, "seq")
    return taken if used is None else used.unionByName(taken)


def _room_left(open_rows: DataFrame, used: DataFrame | None, cell: list[str], per_cell: int) -> DataFrame:
    """Rows among the first ``per_cell`` open or accepted rows of their cell."""
    alive = open_rows.select(*cell, "seq")
    if used is not None:
        alive = alive.unionByName(used)
    return top_per_group(alive, cell, ["seq"], per_cell).select("seq")


def _within_cap(rows: DataFrame, used: DataFrame, new: DataFrame, cell: list[str], per_cell: int) -> DataFrame:
    """Drop rows later than the event that filled their cell."""
    full = (
        top_per_group(used, cell, ["seq"], per_cell).filter(F.col("rank") == per_cell)
        .select(*cell, F.col("seq").alias("_last"))
    )
    late = rows.join(full, cell).filter(F.col("seq") > F.col("_last")).select("seq")
    return rows.join(late, "seq", "left_anti")
