"""Aggregations G2 to G18 and G24 to G30."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classes as C
from ..operators import components, fire, growth, imagery, labels, raster, release
from .joins import MASTER_SQL, batched_chips, batched_events, flood_targets
from .rasters import COMPONENT_SQL, FOUR
from .registry import query
from .scalars import BOXES_SQL, burn_label_cells
from .windows import CELL_STAGE_SQL, SCORED_SQL, TILES_SQL, flood_tiles, with_continent

PATCH_SQL = ("WITH RECURSIVE " + COMPONENT_SQL.format(mask="flood = 1", near=FOUR)
             + ", big AS (SELECT ev, label FROM comp GROUP BY ALL HAVING COUNT(*) >= 8)"
             + ", patch AS (SELECT comp.ev, k // 4294967296 AS r, k % 4294967296 AS c, label FROM comp JOIN big USING (ev, label))")


def burn_patches(t):
    """Four-neighbour patches with at least 8 cells."""
    labelled = components.connected_components(t.cells.filter("flood = 1"), ["ev"], block=32)
    big = labelled.groupBy("ev", "label").agg(F.count("*").alias("n")).filter("n >= 8").drop("n")
    return labelled.join(big, ["ev", "label"], "left_semi")


@query("g1_fire_patches", "WITH RECURSIVE " + COMPONENT_SQL.format(mask="flood = 1", near=FOUR)
       + ", wide(ev, k, root) AS (SELECT ev, k, k FROM m UNION SELECT n.ev, n.k, q.root FROM wide q JOIN m n ON n.ev = q.ev AND n.k IN ("
         "q.k - 1, q.k + 1, q.k - 4294967296, q.k + 4294967296, q.k - 4294967297, q.k - 4294967295, q.k + 4294967295, q.k + 4294967297)), "
         "wcomp AS (SELECT ev, k, MIN(root) AS label FROM wide GROUP BY ALL), "
         "big AS (SELECT ev, label FROM wcomp GROUP BY ALL HAVING COUNT(*) >= 20), "
         "kept AS (SELECT ev, k FROM wcomp JOIN big USING (ev, label)) "
         "SELECT comp.ev, CAST(k // 4294967296 AS BIGINT) AS r, CAST(k % 4294967296 AS BIGINT) AS c, label FROM comp JOIN kept USING (ev, k)")
def _(t):
    return fire.fire_patches(t.cells.filter("flood = 1").select("ev", "r", "c"), ["ev"], 20, block=32)


@query("g2_patch_enrichment", PATCH_SQL + """ SELECT p.ev, label, COUNT(*) * 0.25::DOUBLE AS km2, ROUND(AVG(p.c * 0.5::DOUBLE), 6) AS lon,
  ROUND(AVG(p.r * 0.5::DOUBLE), 6) AS lat, MIN(CAST(FLOOR(value) AS BIGINT)) AS doy_min, MAX(CAST(FLOOR(value) AS BIGINT)) AS doy_max,
  ROUND(AVG(crop), 6) AS crop_frac FROM patch p JOIN fx_cells x ON x.ev = p.ev AND x.r = p.r AND x.c = p.c GROUP BY ALL""")
def _(t):
    cells = burn_patches(t).join(t.cells.select("ev", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "value", "crop"), ["ev", "r", "c"])
    cells = cells.withColumns({"x": F.col("c") * 0.5, "y": F.col("r") * 0.5, "km2": F.lit(0.25), "doy": F.floor("value")})
    out = fire.enrich_patches(cells, ["ev"])
    return out.withColumns({k: F.round(k, 6) for k in ("lon", "lat", "crop_frac")})


@query("g3_verification", PATCH_SQL + """, w AS (SELECT ev, label, 40 + CAST(label % 7 AS INT) * 10 AS d0, 60 + CAST(label % 7 AS INT) * 10 AS d1 FROM patch GROUP BY ALL),
  obs AS (SELECT ev, r, c, day_no * 30 AS day, day_no % 3 AS s, extent * 8 AS v FROM fx_stack),
  peak AS (SELECT p.ev, p.label, p.r, p.c, MAX(v) FILTER (s = 0) AS m, MAX(v) FILTER (s = 1) AS i, MAX(v) FILTER (s = 2) AS f
    FROM patch p JOIN w USING (ev, label) LEFT JOIN obs o ON o.ev = p.ev AND o.r = p.r AND o.c = p.c AND o.day >= d0 - 45 AND o.day < d1 + 45 GROUP BY ALL)
  SELECT ev, label, ROUND(AVG(CASE WHEN m > 0 THEN 1 ELSE 0 END), 6) AS modis_frac, ROUND(AVG(CASE WHEN i > 0 THEN 1 ELSE 0 END), 6) AS viirs_frac,
  COUNT(*) FILTER (f >= 7) AS af_count FROM peak GROUP BY ALL""")
def _(t):
    cells = burn_patches(t)
    shift = (F.col("label") % 7).cast("int") * 10
    base = F.lit("2020-01-01").cast("date")
    patches = cells.select("ev", "label").distinct().select(
        "ev", "label", F.date_add(base, shift + 40).alias("day_min"), F.date_add(base, shift + 60).alias("day_max"))
    sensor = F.element_at(F.array(F.lit("modis"), F.lit("viirs"), F.lit("fire")), F.col("day_no") % 3 + 1)
    obs = t.stack.select("ev", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), sensor.alias("sensor"),
                         F.date_add(base, F.col("day_no") * 30).alias("day"), (F.col("extent") * 8).alias("value"))
    out = fire.verify_patches(patches, cells, obs, ["ev", "label"], ["ev", "r", "c"])
    return out.withColumns({k: F.round(k, 6) for k in ("modis_frac", "viirs_frac")})


@query("g4_temporal_max", "SELECT ev, r, c, MAX(extent) AS peak FROM fx_stack GROUP BY ALL")
def _(t):
    return raster.temporal_max(t.stack, ["ev"], "extent", "peak")


def event_layers(t):
    """Overpass stack with water, exclusion and likelihood from the same cells."""
    s = t.stack.withColumns({
        "day": F.col("day_no"), "water": F.when(F.col("crop") == 0, F.col("extent")),
        "exclusion": F.when(F.col("extent").isNotNull(), F.when(F.col("day_no") == 3, F.col("excl")).otherwise(0)),
        "likelihood": F.when(F.col("extent").isNotNull(), (F.col("r") * 3 + F.col("c") + F.col("day_no") * 11) % 101)})
    return raster.aggregate_event(s)


@query("g5_flood_extent", "SELECT ev, r, c, MAX(extent) AS extent FROM fx_stack GROUP BY ALL")
def _(t):
    return event_layers(t).select("ev", "r", "c", "extent")


PERSISTENCE_SQL = """SELECT ev, r, c, MAX(extent) AS extent, CASE WHEN COUNT(extent) > 0 THEN
  CAST(round_even(100.0::DOUBLE * COUNT(*) FILTER (extent > 0) / COUNT(extent), 0) AS INT) END AS persistence FROM fx_stack GROUP BY ALL"""


@query("g6_persistence", f"SELECT ev, r, c, persistence FROM ({PERSISTENCE_SQL})")
def _(t):
    return event_layers(t).select("ev", "r", "c", "persistence")


@query("g7_reference_water", "SELECT ev, r, c, MAX(CASE WHEN crop = 0 THEN extent END) AS water FROM fx_stack GROUP BY ALL")
def _(t):
    return event_layers(t).select("ev", "r", "c", "water")


@query("g8_exclusion", """SELECT ev, COUNT(*) FILTER (e = 1) AS excluded_px, COUNT(e) AS inswath_px,
  round_even(COUNT(*) FILTER (e = 1) / CAST(GREATEST(COUNT(e), 1) AS DOUBLE), 4) AS share FROM (
  SELECT ev, r, c, MAX(CASE WHEN extent IS NOT NULL THEN CASE WHEN day_no = 3 THEN excl ELSE 0 END END) AS e FROM fx_stack GROUP BY ALL) GROUP BY ev""")
def _(t):
    seen = F.greatest(F.count("exclusion"), F.lit(1))
    hit = F.count_if(F.col("exclusion") == 1)
    return event_layers(t).groupBy("ev").agg(
        hit.alias("excluded_px"), F.count("exclusion").alias("inswath_px"), F.bround(hit / seen, 4).alias("share"))


@query("g9_peak_likelihood", """SELECT ev, r, c, MAX(CASE WHEN extent IS NOT NULL THEN (r * 3 + c + day_no * 11) % 101 END) AS likelihood
  FROM (SELECT ev, r, c, CAST(day_no AS INT) AS day_no, extent FROM fx_stack) GROUP BY ALL""")
def _(t):
    return event_layers(t).select("ev", "r", "c", "likelihood")


@query("g10_flood_series", """SELECT ev, CAST(day_no AS INT) AS day, COUNT(*) FILTER (extent > 0) AS flood_px, COUNT(extent) AS valid_px,
  round_even(COUNT(*) FILTER (extent > 0) * 0.0004::DOUBLE, 3) AS flood_km2 FROM fx_stack GROUP BY ALL""")
def _(t):
    return raster.flood_series(t.stack.withColumn("day", F.col("day_no")), ["ev"], 0.0004)


@query("g11_event_summary", f"""SELECT a.*, n_overpasses, overpass_days FROM (SELECT ev, COUNT(*) FILTER (extent > 0) AS event_flood_px,
  COUNT(extent) AS event_valid_px, round_even(COUNT(*) FILTER (extent > 0) * 0.0004::DOUBLE, 3) AS event_flood_km2,
  round_even(COUNT(extent) * 0.0004::DOUBLE, 3) AS event_valid_km2,
  COALESCE(round_even(AVG(persistence) FILTER (extent > 0), 1), 0) AS flood_persistence_mean FROM ({PERSISTENCE_SQL}) GROUP BY ev) a
  JOIN (SELECT ev, COUNT(DISTINCT day_no) AS n_overpasses, STRING_AGG(DISTINCT CAST(day_no AS STRING), ',' ORDER BY CAST(day_no AS STRING)) AS overpass_days
  FROM fx_stack GROUP BY ev) USING (ev)""")
def _(t):
    days = t.stack.select("ev", F.col("day_no").alias("day"))
    out = raster.event_summary(event_layers(t), days, "ev", 0.0004)
    return out.withColumn("overpass_days", F.array_join(F.transform("overpass_days", lambda d: d.cast("string")), ","))


@query("g12_flood_screen", """WITH cell AS (SELECT ev, r, c, BOOL_OR(extent = 1) AS wet FROM fx_stack GROUP BY ALL),
  f AS (SELECT ev, COUNT(*) FILTER (wet) AS px, MIN(c) FILTER (wet) AS w, MIN(-r) FILTER (wet) AS s, MAX(c) FILTER (wet) AS e, MAX(-r) FILTER (wet) AS n FROM cell GROUP BY ev),
  sc AS (SELECT ev, COUNT(*) AS n_scenes FROM fx_scenes GROUP BY ev)
  SELECT x.ev, COALESCE(n_scenes, 0) AS n_scenes, CASE WHEN n_scenes >= 1 AND px IS NOT NULL THEN px ELSE 0 END AS flood_px,
  CASE WHEN n_scenes >= 1 AND px IS NOT NULL THEN round_even(px * 0.0064::DOUBLE, 3) ELSE 0 END AS flood_km2,
  COALESCE(n_scenes >= 1 AND px >= 1180, false) AS passed,
  CASE WHEN n_scenes IS NULL OR px IS NULL THEN 'transient' WHEN px >= 1180 THEN 'pass' ELSE 'no_flood' END AS outcome,
  CASE WHEN n_scenes >= 1 THEN w * 80.0::DOUBLE END AS flood_w, CASE WHEN n_scenes >= 1 THEN s * 80.0::DOUBLE END AS flood_s,
  CASE WHEN n_scenes >= 1 THEN e * 80.0::DOUBLE END AS flood_e, CASE WHEN n_scenes >= 1 THEN n * 80.0::DOUBLE END AS flood_n
  FROM (SELECT DISTINCT o_orderkey % 300 AS ev FROM orders) x LEFT JOIN sc USING (ev) LEFT JOIN f USING (ev)""")
def _(t):
    events = t.orders.select((F.col("o_orderkey") % 300).alias("ev")).distinct()
    stack = t.stack.withColumns({"x": F.col("c") * 80.0, "y": F.col("r") * -80.0})
    scenes = t.scenes.groupBy("ev").agg(F.count("*").alias("n_scenes"))
    return raster.flood_screen(events, stack, scenes, "ev", 0.0064, 1180)


@query("g13_class_histogram", """SELECT ev, CASE label WHEN 1 THEN 'flooded_cropland' WHEN 2 THEN 'dry_cropland' WHEN 3 THEN 'excluded_cropland'
  WHEN 4 THEN 'non_cropland' ELSE 'nodata' END AS label_name, COUNT(*) AS px,
  round_even(100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY ev), 3) AS pct FROM fx_label GROUP BY ev, label""")
def _(t):
    return labels.class_histogram(flood_label_cells(t), "ev")


def flood_label_cells(t):
    return t.cells.withColumns({
        "label": C.flood_class("flood", F.col("crop") == 1, "excl"),
        "exclusion": F.when(F.col("flood").isNotNull(), F.col("excl"))})


@query("g14_crop_statistics", """SELECT ev, round_even(COUNT(*) FILTER (flood IS NOT NULL AND excl = 1) / CAST(GREATEST(COUNT(flood), 1) AS DOUBLE), 4) AS aoi_excluded_frac_of_inswath,
  round_even(COUNT(*) FILTER (crop = 1) * 0.0001::DOUBLE, 3) AS cropland_km2, COUNT(*) FILTER (crop = 1 AND flood IS NOT NULL AND excl = 1) AS cropland_in_exclusion_px,
  round_even(100.0::DOUBLE * COUNT(*) FILTER (crop = 1 AND flood IS NOT NULL AND excl = 1) / COUNT(*) FILTER (crop = 1), 3) AS cropland_in_exclusion_pct,
  round_even(COUNT(*) FILTER (label = 1) * 0.0001::DOUBLE, 3) AS cropland_flooded_km2 FROM fx_label GROUP BY ev""")
def _(t):
    return labels.crop_statistics(flood_label_cells(t), "ev", 0.0001)


@query("g15_tile_statistics", f"""SELECT ev, CAST(row AS INT) AS row, CAST(col AS INT) AS col, n_valid, flooded_crop_px,
  round_even(crop_px / CAST(n_valid AS DOUBLE), 4) AS cropland_frac, round_even(flooded_crop_px / CAST(n_valid AS DOUBLE), 4) AS flooded_crop_frac,
  round_even(excluded_px / CAST(n_valid AS DOUBLE), 4) AS excluded_crop_frac FROM ({TILES_SQL})""")
def _(t):
    return labels.publish_shares(flood_tiles(t)).select(
        "ev", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "n_valid", "flooded_crop_px",
        "cropland_frac", "flooded_crop_frac", "excluded_crop_frac")


@query("g16_chip_means", """SELECT ev, CAST(r - r % 10 AS INT) AS row, CAST(c - c % 10 AS INT) AS col,
  COALESCE(round_even(AVG(sev) FILTER (label = 1), 2), 0) AS burn_severity_mean,
  round_even(COUNT(*) FILTER (label = 1) / CAST(COUNT(*) AS DOUBLE), 4) AS burned_crop_frac,
  round_even(COUNT(*) FILTER (label = 3) / CAST(GREATEST(COUNT(*) FILTER (crop = 1), 1) AS DOUBLE), 4) AS excluded_crop_frac
  FROM fx_burn_label GROUP BY ALL""")
def _(t):
    row, col = F.col("r") - F.col("r") % 10, F.col("c") - F.col("c") % 10
    cells = burn_label_cells(t).withColumns({
        "chip_id": F.struct("ev", row.alias("row"), col.alias("col")), "severity": F.when(F.col("observed"), F.col("sev"))})
    return labels.burn_chip_statistics(cells).select(
        "chip_id.*", "burn_severity_mean", "burned_crop_frac", "excluded_crop_frac").withColumns(
        {k: F.col(k).cast("int") for k in ("row", "col")})


@query("g17_phenology_reduce", f"""SELECT chip_id, code, MEDIAN(inc) AS inc, MEDIAN("max") AS peak, MEDIAN("dec") AS dec_day, MEDIAN("min") AS min_day
  FROM ({SCORED_SQL}) WHERE ok GROUP BY ALL""")
def _(t):
    return growth.cycle_medians(growth.score_cycles(t.cycles)).select(
        "chip_id", "code", "inc", F.col("max").alias("peak"), F.col("dec").alias("dec_day"), F.col("min").alias("min_day"))


STAGE_SQL = f"""cell AS ({CELL_STAGE_SQL}), st AS (SELECT chip_id, stage, SUM(weight) AS w FROM cell GROUP BY ALL),
  tot AS (SELECT chip_id, SUM(w) AS total, MAX(w) AS top, MAX_BY(stage, (w, -stage)) AS dom,
    STRING_AGG(CONCAT(CASE stage WHEN 0 THEN 'dormant' WHEN 1 THEN 'green-up' WHEN 2 THEN 'peak/maturity' ELSE 'senescence' END, '=',
      CAST(CAST(round_even(1000 * w / total0, 0) AS BIGINT) AS STRING)), ',' ORDER BY stage) AS fractions
    FROM (SELECT *, SUM(w) OVER (PARTITION BY chip_id) AS total0 FROM st) GROUP BY chip_id),
  cy AS (SELECT chip_id, MAX_BY(code, (w, -code)) AS code FROM (SELECT chip_id, code, SUM(weight) AS w FROM cell WHERE code > 0 GROUP BY ALL) GROUP BY chip_id),
  med AS (SELECT chip_id, code, MEDIAN(inc) AS inc, MEDIAN("min") AS mn FROM ({SCORED_SQL}) WHERE ok GROUP BY ALL),
  res AS (SELECT tot.chip_id, CASE dom WHEN 0 THEN 'dormant' WHEN 1 THEN 'green-up' WHEN 2 THEN 'peak/maturity' ELSE 'senescence' END AS stage,
    round_even(top / total, 3) AS stage_agreement, fractions, CASE WHEN code IS NOT NULL THEN CASE WHEN code < 10 THEN 'previous' ELSE 'event' END
    || '-year cycle ' || CAST(code % 10 AS STRING) END AS growth_cycle, CAST(DATE '2000-01-01' + CAST(round_even(inc, 0) AS INT) AS STRING) AS green_up_onset,
    CAST(DATE '2000-01-01' + CAST(round_even(mn, 0) AS INT) AS STRING) AS dormancy_onset, CAST(round_even(total, 0) AS INT) AS n_valid_pixels
    FROM tot LEFT JOIN cy USING (chip_id) LEFT JOIN med USING (chip_id, code))"""


def flat_stages(df):
    """Stage rows with the nested columns as text."""
    parts = F.transform(F.map_entries("stage_fractions"), lambda e: F.concat(
        e["key"], F.lit("="), F.bround(e["value"] * 1000).cast("long").cast("string")))
    return df.select(
        "chip_id", "stage", "stage_agreement", F.array_join(parts, ",").alias("fractions"), "growth_cycle",
        F.col("transitions.green_up_onset").cast("string").alias("green_up_onset"),
        F.col("transitions.dormancy_onset").cast("string").alias("dormancy_onset"), "n_valid_pixels")


@query("g18_majority_stage", f"WITH {STAGE_SQL} SELECT * FROM res")
def _(t):
    return flat_stages(growth.chip_stages(growth.score_cycles(t.cycles)))


@query("g24_event_counts", f"""SELECT continent, year, COUNT(*) AS n FROM (SELECT {BOXES_SQL} AS continent, year FROM fx_floods)
  GROUP BY GROUPING SETS ((continent), (year))""")
def _(t):
    return release.event_counts(with_continent(t.floods))


@query("g25_run_counters", """SELECT COUNT(*) FILTER (NOT err AND NOT skip) AS events_processed, COUNT(*) FILTER (err) AS failures,
  COUNT(*) FILTER (skip) AS skipped_existing, CAST(COALESCE(SUM(n_indep) FILTER (NOT err AND NOT skip), 0) AS BIGINT) AS scenes_downloaded,
  CAST(COALESCE(SUM(dur_days) FILTER (NOT err AND NOT skip), 0) AS BIGINT) AS chips_written
  FROM (SELECT *, ev % 11 = 0 AS err, ev % 7 = 0 AS skip FROM fx_candidates)""")
def _(t):
    outcomes = t.candidates.select(
        "event_id", F.when(F.col("ev") % 11 == 0, "TimeoutError").alias("error"), F.col("n_indep").alias("n_scenes"),
        F.col("dur_days").alias("n_chips"), (F.col("ev") % 7 == 0).alias("skipped"))
    return release.run_counters(outcomes)


@query("g25_mean_flooded_share", f"""SELECT ev, COUNT(*) AS n_chips, round_even(AVG(share), 6) AS mean_flooded_crop_frac FROM (
  SELECT ev, round_even(flooded_crop_px / CAST(n_valid AS DOUBLE), 4) AS share FROM ({TILES_SQL})) GROUP BY ev""")
def _(t):
    tiles = labels.publish_shares(flood_tiles(t)).withColumnRenamed("ev", "event_id")
    return release.mean_flooded_share(tiles, 6).withColumnRenamed("event_id", "ev")


@query("g26_scenes_per_day", """SELECT ev, CAST(acq AS STRING) AS day, COUNT(*) AS n_scenes, MIN(scene_id) AS first_id, MAX(scene_id) AS last_id
  FROM fx_scenes GROUP BY ev, acq""")
def _(t):
    return release.scenes_per_day(t.scenes).select(
        "ev", F.col("acq").cast("string").alias("day"), "n_scenes", "first_id", "last_id")


@query("g26_overpass_items", "SELECT ev, CAST(acq AS STRING) AS day, scene_id FROM fx_scenes ORDER BY ev, acq, scene_id")
def _(t):
    return release.overpass_items(t.scenes).select("ev", F.col("acq").cast("string").alias("day"), "scene_id")


@query("g27_cluster_size", """SELECT cluster_size, COUNT(*) AS clusters FROM (SELECT COUNT(*) AS cluster_size FROM fx_floods GROUP BY
  round_even((bbox_w + bbox_e) / 2 / (600 / 111.0::DOUBLE), 0), round_even((bbox_s + bbox_n) / 2 / (600 / 111.0::DOUBLE), 0),
  FLOOR((date_start - DATE '1970-01-01') / 150)) GROUP BY 1""")
def _(t):
    from ..operators.catalog import cluster_events
    return cluster_events(t.floods, 600.0, 150).groupBy("cluster_size").agg(F.count("*").alias("clusters"))


@query("g28_clear_share", """SELECT ev, day_no AS scene, ROUND(AVG(extent), 6) AS clear_frac, COUNT(*) FILTER (r + c + day_no > 40) AS valid_px,
  COUNT(*) FILTER (r + c + day_no > 40) >= 0.6 * 800000 / 400.0::DOUBLE AS covers FROM (SELECT ev, r, c, CAST(day_no AS INT) AS day_no, extent FROM fx_stack) GROUP BY ALL""")
def _(t):
    pixels = t.stack.select("ev", F.col("day_no").alias("scene_id"), (F.col("extent") == 1).alias("clear"),
                            (F.col("r") + F.col("c") + F.col("day_no") - 40).alias("red"))
    scored = imagery.clear_share(pixels, ["ev"])
    return scored.withColumn("area", F.lit(800000.0)).select(
        "ev", F.col("scene_id").alias("scene"), F.round("clear_frac", 6).alias("clear_frac"), "valid_px",
        imagery.covers("valid_px", "area").alias("covers"))


@query("g28_nominal_scene", """SELECT event_id, MIN_BY(scene_id, (-clear_frac, scene_id)) AS scene_id, COUNT(*) AS n_scenes FROM (
  SELECT f.event_id, s.scene_id, s.clear_frac FROM fx_floods f JOIN fx_scenes s ON s.ev = f.ev % 200
  AND s.acq >= f.date_start - 110 AND s.acq < f.date_start - 8) GROUP BY event_id""")
def _(t):
    targets = flood_targets(t).select("event_id", "ev", F.col("date_start").alias("target"))
    return imagery.clearest_in_window(targets, t.scenes, -110, -9).select("event_id", "scene_id", "n_scenes")


@query("g29_event_chip_counts", f"""SELECT COUNT(*) AS events, COUNT(*) FILTER (flooded_crops = 1) AS productive,
  COUNT(*) FILTER (flooded_crops = 0) AS zero_chip, CAST(SUM(n_chips) AS BIGINT) AS chips FROM ({MASTER_SQL})""")
def _(t):
    return release.master_totals(release.master_events(batched_events(t), batched_chips(t)))


RELEASE_VIEW_SQL = f"""SELECT CAST(l_orderkey AS STRING) AS event_id, CASE WHEN l_linenumber % 2 = 0 THEN 'Flooded' ELSE 'Burnt' END AS hazard, continent,
  l_quantity > 5 AS has_s1, l_discount < 0.07 AS usable, CASE WHEN l_tax < 0.06 THEN 'stage ' || CAST(l_linenumber % 4 AS STRING) END AS stage,
  CAST(l_shipdate AS DATE) AS event_date, lat, CASE WHEN l_quantity > 25 THEN 'clean' ELSE 'cloudy' END AS verdict
  FROM lineitem JOIN (SELECT ev, lat, {BOXES_SQL} AS continent FROM fx_floods) ON ev = l_orderkey"""


def released(t):
    """Released chips: one per order line, placed at its order's event."""
    place = with_continent(t.floods).select("ev", "lat", "continent")
    n = F.col("l_linenumber")
    return t.lineitem.join(place, F.col("ev") == F.col("l_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("event_id"), F.when(n % 2 == 0, "Flooded").otherwise("Burnt").alias("hazard"),
        "continent", (F.col("l_quantity") > 5).alias("has_s1"), (F.col("l_discount") < 0.07).alias("usable"),
        F.when(F.col("l_tax") < 0.06, F.concat(F.lit("stage "), (n % 4).cast("string"))).alias("stage"),
        F.col("l_shipdate").cast("date").alias("event_date"), "lat",
        F.when(F.col("l_quantity") > 25, "clean").otherwise("cloudy").alias("verdict"))


@query("g30_release_summary", f"""SELECT hazard, continent, COUNT(DISTINCT event_id) AS events, COUNT(*) AS chips,
  round_even(COUNT(*) / CAST(COUNT(DISTINCT event_id) AS DOUBLE), 1) AS chips_per_event,
  round_even(100.0::DOUBLE * COUNT(*) FILTER (has_s1) / COUNT(*), 1) AS pct_radar, round_even(100.0::DOUBLE * COUNT(*) FILTER (usable) / COUNT(*), 1) AS pct_usable,
  round_even(100.0::DOUBLE * COUNT(stage) / COUNT(*), 1) AS pct_stage FROM ({RELEASE_VIEW_SQL}) GROUP BY CUBE (hazard, continent)""")
def _(t):
    return release.summary(released(t))


@query("g30_release_distributions", f"""WITH v AS ({RELEASE_VIEW_SQL}) SELECT facet, value, COUNT(*) AS n FROM (
  SELECT 'stage' AS facet, COALESCE(stage, 'no data') AS value FROM v UNION ALL SELECT 'month', CAST(MONTH(event_date) AS STRING) FROM v
  UNION ALL SELECT 'region', continent FROM v UNION ALL SELECT 'latitude', CAST(CAST(FLOOR(lat / 10) * 10 AS BIGINT) AS STRING) FROM v
  UNION ALL SELECT 'verdict', verdict FROM v) GROUP BY ALL""")
def _(t):
    return release.distributions(released(t))
