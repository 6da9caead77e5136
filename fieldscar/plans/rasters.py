"""Neighbourhood and grid operators N1 to N9, and connected components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components, raster
from .registry import query
from .scalars import burn_label_cells


@query("n1_nearest_resample", """SELECT ev, CAST(r * 2 + i AS INT) AS r, CAST(c * 2 + j AS INT) AS c, flood FROM fx_cells,
  (SELECT UNNEST([0, 1]) AS i), (SELECT UNNEST([0, 1]) AS j)""")
def _(t):
    return raster.resample_nearest(t.cells.select("ev", "r", "c", "flood"), 2)


@query("n2_bilinear_resample", """WITH src AS (SELECT ev, r, c, CASE WHEN flood IS NOT NULL THEN value END AS v FROM fx_cells),
  tgt AS (SELECT ev, r * 2 + i AS tr, c * 2 + j AS tc, r + a.d AS sr, c + b.d AS sc, a.w * b.w AS w FROM fx_cells,
    (SELECT UNNEST([0, 1]) AS i), (SELECT UNNEST([0, 1]) AS j), (SELECT UNNEST([0, 1]) AS ka), (SELECT UNNEST([0, 1]) AS kb),
    LATERAL (SELECT CASE WHEN ka = 0 THEN 0 WHEN i = 0 THEN -1 ELSE 1 END AS d, CASE WHEN ka = 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS w) a,
    LATERAL (SELECT CASE WHEN kb = 0 THEN 0 WHEN j = 0 THEN -1 ELSE 1 END AS d, CASE WHEN kb = 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS w) b)
  SELECT tgt.ev, CAST(tr AS INT) AS r, CAST(tc AS INT) AS c, ROUND(SUM(w * v) / SUM(CASE WHEN v IS NOT NULL THEN w END), 7) AS value
  FROM tgt LEFT JOIN src ON src.ev = tgt.ev AND src.r = sr AND src.c = sc GROUP BY ALL""")
def _(t):
    cells = t.cells.withColumn("value", F.when(F.col("flood").isNotNull(), F.col("value")))
    return raster.resample_bilinear(cells, ["ev"], ["value"]).withColumn("value", F.round("value", 7))


@query("n3_dilate", """SELECT DISTINCT ev, CAST(r + d.i AS INT) AS r, CAST(c + d.j AS INT) AS c FROM fx_cells,
  (SELECT UNNEST([0, 0, 0, 1, -1]) AS i, UNNEST([0, 1, -1, 0, 0]) AS j) d WHERE flood = 1""")
def _(t):
    return raster.dilate(t.cells.filter("flood = 1"), ["ev"])


@query("n4_mosaic_tiles", """SELECT ev, r, c, MIN_BY(extent, (day_no * 5) % 7) AS value FROM fx_stack WHERE extent IS NOT NULL GROUP BY ALL""")
def _(t):
    tiles = t.stack.filter("extent IS NOT NULL").select(
        "ev", "r", "c", F.col("extent").alias("value"), (F.col("day_no") * 5 % 7).alias("tile"))
    return raster.mosaic_first(tiles, ["ev"], "tile", "value")


@query("n5_fixed_tiling", """SELECT ev, r - r % 8 AS row, c - c % 8 AS col, COUNT(*) AS n_px FROM fx_cells GROUP BY ALL HAVING COUNT(*) = 64""")
def _(t):
    from ..operators.labels import tile_statistics
    cells = t.cells.withColumn("label", F.lit(4))
    tiles = tile_statistics(cells, "ev", 8, persistence=False)
    return tiles.select("ev", "row", "col", F.col("n_valid").alias("n_px"))


@query("n6_cut_out", """SELECT 'E' || CAST(ev AS STRING) || '_r' || LPAD(CAST(r - r % 10 AS STRING), 4, '0') || '_c' || LPAD(CAST(c - c % 10 AS STRING), 4, '0') AS chip_id,
  CAST(r % 10 AS INT) AS r, CAST(c % 10 AS INT) AS c, flood FROM fx_cells WHERE (ev, r - r % 10, c - c % 10) IN
  (SELECT ev, r - r % 10, c - c % 10 FROM fx_cells GROUP BY ALL HAVING COUNT(*) FILTER (flood = 1) >= 40)""")
def _(t):
    from ..functions.text import chip_id
    tiles = t.cells.groupBy("ev", (F.col("r") - F.col("r") % 10).alias("row"), (F.col("c") - F.col("c") % 10).alias("col")).agg(
        F.count_if(F.col("flood") == 1).alias("wet")).filter("wet >= 40")
    named = tiles.withColumn("chip_id", chip_id(F.concat(F.lit("E"), F.col("ev").cast("string")), "row", "col"))
    return raster.cut_out(t.cells.select("ev", "r", "c", "flood"), named, 10).select("chip_id", "r", "c", "flood")


# flood fill by recursion: the smallest row-major key reaches every cell of its component
COMPONENT_SQL = """m AS (SELECT ev, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, r * 4294967296::BIGINT + c AS k FROM fx_cells WHERE {mask}),
  reach(ev, k, root) AS (SELECT ev, k, k FROM m UNION
    SELECT n.ev, n.k, q.root FROM reach q JOIN m n ON n.ev = q.ev AND {near}),
  comp AS (SELECT ev, k, MIN(root) AS label FROM reach GROUP BY ALL)"""
FOUR = "n.k IN (q.k - 1, q.k + 1, q.k - 4294967296, q.k + 4294967296)"


@query("g1_components", "WITH RECURSIVE " + COMPONENT_SQL.format(mask="flood = 1", near=FOUR) + """
  SELECT ev, CAST(k // 4294967296 AS BIGINT) AS r, CAST(k % 4294967296 AS BIGINT) AS c, label FROM comp""")
def _(t):
    return components.connected_components(t.cells.filter("flood = 1"), ["ev"], block=32)


@query("n7_edge_blob", "WITH RECURSIVE " + COMPONENT_SQL.format(mask="flood IS NULL", near=FOUR) + """,
  parts AS (SELECT ev, label, COUNT(*) AS n, BOOL_OR(k // 4294967296 IN (0, 19) OR k % 4294967296 IN (0, 99)) AS rim FROM comp GROUP BY ALL)
  SELECT ev, CAST(SUM(n) AS BIGINT) AS nodata_px, ROUND(MAX(n) / CAST(SUM(n) AS DOUBLE), 6) AS blob_share,
  MAX_BY(rim, (n, -label)) AS touches_border FROM parts GROUP BY ev""")
def _(t):
    blobs = components.edge_blobs(t.cells.filter("flood IS NULL"), ["ev"], 20, 100, block=32)
    return blobs.withColumn("blob_share", F.round("blob_share", 6))


@query("n8_grid_assertion", """SELECT ev FROM fx_candidates WHERE ABS(CASE WHEN n_indep = 3 THEN 20 ELSE 10 END - 10) > 0.000001
  OR CASE WHEN dur_days = 7 THEN 0 ELSE CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + FLOOR((lon + 180) / 6) + 1 END
  <> CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + FLOOR((lon + 180) / 6) + 1""")
def _(t):
    from ..functions.geo import utm_epsg
    res = F.when(F.col("n_indep") == 3, 20.0).otherwise(10.0)
    want = utm_epsg("lon", "lat")
    layers = t.candidates.select(
        "ev", res.alias("xres"), (-res).alias("yres"), want.alias("want_epsg"),
        F.when(F.col("dur_days") == 7, 0).otherwise(want).alias("epsg"))
    return raster.grid_mismatches(layers, 10.0).select("ev")


@query("n9_scout_map", """SELECT ev, CAST(FLOOR(r / 4) AS BIGINT) AS r, CAST(FLOOR(c / 4) AS BIGINT) AS c,
  CAST(MAX(CASE WHEN observed AND sev >= 1 AND crop = 1 AND in_perimeter THEN 1 ELSE 0 END) AS INT) AS burned_crop FROM fx_burn_label GROUP BY ALL""")
def _(t):
    cells = burn_label_cells(t).select(
        "ev", "r", "c", "observed", F.col("sev").alias("severity"), (F.col("crop") == 1).alias("crop"), "in_perimeter")
    return raster.scout_map(cells, ["ev"], 4)
