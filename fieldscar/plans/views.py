"""Operator inputs derived from the given tables by integer arithmetic.

The given tables hold no geography, so places, dates, masks and tiles are computed from their keys
and values. ``VIEWS`` expressions run unchanged in Spark and in the comparison SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import rect_ring

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "candidates": ("orders", [
        "o_orderkey AS ev",
        "CONCAT(CASE WHEN o_orderkey % 3 = 0 THEN 'DFO' ELSE 'GS' END, CAST(o_orderkey AS STRING)) AS event_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'dfo' ELSE 'groundsource' END AS source",
        "CAST(o_orderdate AS DATE) AS date_start", "CAST(o_custkey % 20 AS INT) AS dur_days",
        "CAST((o_custkey * 7919 + o_orderkey * 31) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon",
        "CAST((o_orderkey * 104729) % 13500 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(60 AS DOUBLE) AS lat",
        "CAST(o_orderkey % 7 + 1 AS DOUBLE) / CAST(10 AS DOUBLE) AS half_deg",
        "o_totalprice / CAST(100 AS DOUBLE) AS area_km2", "CAST(o_custkey % 4 AS INT) AS n_indep",
        "o_orderkey % 5 <> 0 AS passed",
    ]),
    "floods": ("candidates", [
        "ev", "event_id", "source", "date_start", "CAST(date_start + dur_days AS DATE) AS date_end", "lon", "lat",
        "lon - half_deg AS bbox_w", "lat - half_deg AS bbox_s", "lon + half_deg AS bbox_e", "lat + half_deg AS bbox_n",
        "area_km2 AS area_km2_reported", "n_indep", "passed", "CAST(year(date_start) AS INT) AS year",
        "CASE WHEN source = 'dfo' THEN 'C' ELSE 'A' END AS tier", "ev AS pos",
    ]),
    "points": ("customer", [
        "c_custkey AS pt", "CAST((c_custkey * 5449) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon",
        "CAST((c_custkey * 3571) % 13500 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(60 AS DOUBLE) AS lat",
        "CAST((c_custkey * 13) % 2400 AS INT) AS day_no", "c_nationkey AS iso",
    ]),
    "cells": ("events", [
        "CAST(((event_id - event_id % 100) - (event_id - event_id % 100) % 2000) / 2000 AS BIGINT) AS ev",
        "CAST(((event_id - event_id % 100) / 100) % 20 AS INT) AS r", "CAST(event_id % 100 AS INT) AS c",
        "CASE WHEN event_type = 'signup' THEN NULL WHEN event_type IN ('error','purchase') THEN 1 ELSE 0 END AS flood",
        "CASE WHEN user_id % 3 > 0 THEN 1 ELSE 0 END AS crop",
        "CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 1 ELSE 0 END AS excl",
        "CAST(ts AS DATE) AS day", "value",
    ]),
    "scenes": ("lineitem", [
        "CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', "
        "CAST(l_linenumber AS STRING)) AS scene_id",
        "l_orderkey % 200 AS ev", "CAST(l_shipdate AS DATE) AS acq",
        "CASE WHEN l_returnflag = 'A' THEN 'ASCENDING' ELSE 'DESCENDING' END AS pass", "l_suppkey % 5 AS rel_orbit",
        "CASE WHEN l_linestatus = 'O' THEN 'IW' ELSE 'EW' END AS mode", "l_discount AS cloud",
        "l_quantity / CAST(50 AS DOUBLE) AS clear_frac",
        "CAST((l_partkey * 997 + l_orderkey * 131) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon",
        "CAST((l_orderkey * 7907 + l_suppkey * 53) % 13500 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(60 AS DOUBLE) AS lat",
        "CASE WHEN l_suppkey % 5 = 0 AND l_linenumber > 3 THEN 0 ELSE 1 END AS dual",
    ]),
    # optical bands of one pixel per event row; the score is the cloud score
    "bands": ("events", [
        "event_id AS px", "value * 40 + 500 AS b8", "CAST(event_id % 97 AS DOUBLE) * 20 + 100 AS b12",
        "value * 25 + 300 AS b8a", "CAST(user_id % 41 AS DOUBLE) * 30 AS b4", "CAST(event_id % 53 AS DOUBLE) * 60 + 40 AS b3",
        "CAST(user_id % 37 AS DOUBLE) * 45 + 10 AS b11", "CAST(event_id % 20 AS DOUBLE) / 20 AS cs", "event_type",
        "value", "user_id", "event_id",
    ]),
    # label cells with burn inputs
    "burn_cells": ("cells", [
        "ev", "r", "c", "crop", "flood IS NOT NULL AS observed", "CASE WHEN flood IS NOT NULL THEN value * 12 - 150 END AS dnbr",
        "excl = 0 AS in_perimeter", "value",
    ]),
}

SQL_VIEWS = {f"fx_{name}": f"SELECT {', '.join(columns)} FROM {('fx_' + source) if source in VIEWS else source}"
             for name, (source, columns) in VIEWS.items()}
SQL_VIEWS["fx_stack"] = (
    "SELECT ev, r, c, t.day_no, CASE WHEN (r * 7 + c * 3 + t.day_no * 5) % 11 = 0 THEN NULL "
    "WHEN (r * 7 + c * 3 + t.day_no * 5) % 11 < 4 THEN 1 ELSE 0 END AS extent, crop, excl FROM fx_cells "
    "CROSS JOIN (SELECT UNNEST(range(0, 6)) AS day_no) t")
SQL_VIEWS["fx_label"] = (
    "SELECT *, CASE WHEN crop = 0 THEN 4 WHEN flood IS NULL THEN 255 WHEN excl = 1 THEN 3 "
    "WHEN flood = 1 THEN 1 ELSE 2 END AS label FROM fx_cells")
SQL_VIEWS["fx_burn_label"] = (
    "SELECT *, CASE WHEN crop = 0 THEN 4 WHEN NOT observed THEN 3 "
    "WHEN sev >= 1 AND in_perimeter THEN 1 ELSE 2 END AS label FROM ("
    "SELECT *, CASE WHEN dnbr >= 660 THEN 4 WHEN dnbr >= 440 THEN 3 WHEN dnbr >= 270 THEN 2 "
    "WHEN dnbr >= 100 THEN 1 ELSE 0 END AS sev FROM fx_burn_cells)")
SQL_VIEWS["fx_countries"] = (
    "SELECT n_nationkey AS country_id, n_name AS iso_a3, "
    "-180.505 + 72 * (n_nationkey % 5) AS bbox_w, -60.505 + 27 * FLOOR(n_nationkey / 5) AS bbox_s, "
    "-107.505 + 72 * (n_nationkey % 5) AS bbox_e, -32.505 + 27 * FLOOR(n_nationkey / 5) AS bbox_n FROM nation")
SQL_VIEWS["fx_relief"] = (
    "SELECT c_custkey AS id, DATE '1995-01-01' + CAST((c_custkey * 13) % 2400 AS INT) AS date, n_name AS iso3 "
    "FROM customer JOIN nation ON n_nationkey = c_nationkey")
# growth cycles of each cell: 2 granule years x 2 cycles
SQL_VIEWS["fx_cycles"] = (
    "SELECT chip_id, cell_id, gy AS granule_year, cy AS cycle, yr AS year, day, weight, "
    "CASE WHEN (cell_id + cy) % 13 = 0 THEN 32767 ELSE inc END AS inc, "
    "CASE WHEN (cell_id + gy) % 17 = 0 THEN mx + 30 ELSE mx END AS \"max\", "
    "CASE WHEN (cell_id + gy) % 17 = 0 THEN mx ELSE mx + 30 END AS \"dec\", mx + 70 AS \"min\" FROM ("
    "SELECT *, inc + 30 + c % 20 AS mx FROM ("
    "SELECT ev AS chip_id, r * 100 + c AS cell_id, c, yr, yr - 1 + g AS gy, k AS cy, "
    "1.0::DOUBLE + (c % 3) / 4.0::DOUBLE AS weight, "
    "CAST(make_date(yr, 1, 1) - DATE '2000-01-01' AS INT) + 150 + 20 * CAST(ev % 4 AS INT) AS day, "
    "CAST(make_date(yr - 1 + g, 1, 1) - DATE '2000-01-01' AS INT) + 60 + (k - 1) * 120 + r AS inc "
    "FROM (SELECT *, CAST(2021 + ev % 5 AS INT) AS yr FROM fx_cells), (SELECT UNNEST([0, 1]) AS g), (SELECT UNNEST([1, 2]) AS k)))")
# image tiles: one tile per vector, every tenth image slot stays empty
_KEYS = "CASE slot % 4 WHEN 0 THEN 's2_pre' WHEN 1 THEN 's2_post' WHEN 2 THEN 's1_pre' ELSE 's1_post' END"
_SLOT = "SELECT *, vec_id + CAST(FLOOR(vec_id / 9) AS BIGINT) AS slot FROM embeddings"
SQL_VIEWS["fx_slots"] = (
    f"SELECT CAST((slot - slot % 4) / 4 AS BIGINT) AS chip_no, {_KEYS} AS raster, vec_id, embedding, "
    "CASE WHEN vec_id % 41 = 7 THEN 1 ELSE 0 END AS short_by, CAST(vec_id % 20 AS DOUBLE) / 20 AS clear_frac "
    f"FROM ({_SLOT})")
_OPTICAL = (
    "CASE WHEN vec_id % 37 = 5 OR (vec_id % 3 = 0 AND i < vec_id % 13) "
    "OR (vec_id % 7 = 3 AND (i * 5 + vec_id) % 17 = 0) THEN 0.0 "
    "ELSE FLOOR(ABS(CAST(e AS DOUBLE)) * 8000) + b * 10 + "
    "CASE WHEN vec_id % 6 = 1 THEN 2500 WHEN vec_id % 6 = 2 THEN 1500 WHEN vec_id % 12 = 4 THEN 12000 ELSE 300 END END")
_RADAR = (
    "CASE WHEN vec_id % 37 = 5 OR (vec_id % 3 = 0 AND i < vec_id % 13) "
    "OR (vec_id % 7 = 3 AND (i * 5 + vec_id) % 17 = 0) THEN 0.0 "
    "WHEN vec_id % 19 = 2 THEN -7.0 WHEN vec_id % 17 = 4 AND b = 1 AND i % 16 = 3 THEN 0.0 "
    "ELSE -(5 + FLOOR(ABS(CAST(e AS DOUBLE)) * 100) / 4.0 + b * 6) END")
_NOT_FINITE = "vec_id % 31 = 8 AND i = 63 AND b = 0"
SQL_VIEWS["fx_pixels"] = (
    "SELECT chip_no, raster, vec_id, CAST(i AS INT) AS i, CAST(b AS INT) AS b, "
    f"CASE WHEN {_NOT_FINITE} THEN 0.0 WHEN raster LIKE 's2%' THEN {_OPTICAL} ELSE {_RADAR} END AS v "
    "FROM (SELECT *, UNNEST(embedding) AS e, UNNEST(range(0, 64)) AS i FROM fx_slots), "
    "(SELECT UNNEST(range(0, 12)) AS b) WHERE short_by = 0 AND (raster LIKE 's2%' OR b < 2)")


def _stack(t) -> DataFrame:
    code = (F.col("r") * 7 + F.col("c") * 3 + F.col("day_no") * 5) % 11
    days = t.cells.select("ev", "r", "c", "crop", "excl", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("day_no"))
    return days.select(
        "ev", "r", "c", "day_no", F.when(code > 0, (code < 4).cast("int")).alias("extent"), "crop", "excl")


def _with_rings(df: DataFrame) -> DataFrame:
    return df.withColumn("rings", F.array(rect_ring("bbox_w", "bbox_s", "bbox_e", "bbox_n")))


def _countries(t) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = 72 * (k % 5), 27 * F.floor(k / 5)
    return _with_rings(t.nation.select(
        k.alias("country_id"), F.col("n_name").alias("iso_a3"), (x - 180.505).alias("bbox_w"),
        (y - 60.505).alias("bbox_s"), (x - 107.505).alias("bbox_e"), (y - 32.505).alias("bbox_n")))


def _relief(t) -> DataFrame:
    day = F.date_add(F.lit("1995-01-01").cast("date"), ((F.col("c_custkey") * 13) % 2400).cast("int"))
    named = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return named.select(F.col("c_custkey").alias("id"), day.alias("date"), F.col("n_name").alias("iso3"))


def _activations(t) -> DataFrame:
    return t.points.select("lon", "lat", F.date_add(F.lit("1995-01-01").cast("date"), F.col("day_no")).alias("date"))


def _cycles(t) -> DataFrame:
    # day number of 1 January, by leap years (2000 to 2099)
    since = lambda y: ((y - 2000) * 365 + F.shiftright(y - 1997, 2)).cast("int")
    c = t.cells.withColumn("year", (2021 + F.col("ev") % 5).cast("int"))
    for name, pair in (("_g", (0, 1)), ("cycle", (1, 2))):
        c = c.withColumn(name, F.explode(F.array(*[F.lit(v) for v in pair])))
    gy = F.col("year") - 1 + F.col("_g")
    inc = since(gy) + 60 + (F.col("cycle") - 1) * 120 + F.col("r")
    peak = inc + 30 + F.col("c") % 20
    cell = F.col("r") * 100 + F.col("c")
    swapped = (cell + gy) % 17 == 0
    return c.select(
        F.col("ev").alias("chip_id"), cell.alias("cell_id"), gy.alias("granule_year"), "cycle", "year",
        (since(F.col("year")) + 150 + 20 * (F.col("ev") % 4).cast("int")).alias("day"),
        (1.0 + (F.col("c") % 3) / 4.0).alias("weight"),
        F.when((cell + F.col("cycle")) % 13 == 0, 32767).otherwise(inc).alias("inc"),
        F.when(swapped, peak + 30).otherwise(peak).alias("max"),
        F.when(swapped, peak).otherwise(peak + 30).alias("dec"), (peak + 70).alias("min"))


def _tiles(t) -> DataFrame:
    slot = t.embeddings.withColumn("slot", F.col("vec_id") + F.floor(F.col("vec_id") / 9))
    nan = f"WHEN {_NOT_FINITE} THEN CAST('NaN' AS DOUBLE)"
    pixel = lambda body: f"transform(embedding, (e, i) -> CAST(CASE {nan} ELSE {body} END AS FLOAT))"
    bands = (f"CASE WHEN raster LIKE 's2%' THEN transform(sequence(0, 11 - short_by), b -> {pixel(_OPTICAL)}) "
             f"ELSE transform(sequence(0, 1 - short_by), b -> {pixel(_RADAR)}) END")
    keyed = slot.selectExpr(
        "CAST((slot - slot % 4) / 4 AS BIGINT) AS chip_no", f"{_KEYS} AS raster", "vec_id", "embedding",
        "CASE WHEN vec_id % 41 = 7 THEN 1 ELSE 0 END AS short_by", "CAST(vec_id % 20 AS DOUBLE) / 20 AS clear_frac")
    return keyed.withColumn("values", F.expr(bands)).select(
        F.format_string("c%05d", "chip_no").alias("chip_id"), "raster", F.lit(8).alias("h"), F.lit(8).alias("w"),
        F.size("values").alias("n_bands"), "values", F.lit(None).cast("string").alias("read_error"), "clear_frac")


def _tile_chips(t) -> DataFrame:
    """Chips of the image tiles with their clear shares per image."""
    return t.tiles.select("chip_id", "raster", "clear_frac").groupBy("chip_id").agg(
        F.map_from_entries(F.collect_list(F.struct("raster", "clear_frac"))).alias("clear")).select(
        "chip_id", F.concat(F.lit("e"), F.substring("chip_id", 2, 4)).alias("event_id"), F.lit("Europe").alias("continent"),
        F.lit("Nowhere").alias("country"), F.lit(2022).alias("year"), "clear")


BUILT = {
    "stack": _stack, "countries": _countries, "relief": _relief, "activations": _activations, "cycles": _cycles,
    "tiles": _tiles, "tile_chips": _tile_chips,
    "flood_shapes": lambda t: _with_rings(t.floods),
}
