"""Join operators J1 to J16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import imagery, matching, raster, release, sidecars
from .registry import query
from .scalars import with_polarisations

_POINT_MATCH = """SELECT f.event_id, EXISTS (SELECT 1 FROM fx_points p
    WHERE DATE '1995-01-01' + p.day_no BETWEEN f.date_start - 15 AND f.date_end + 15
    AND p.lon BETWEEN f.bbox_w - 1.36 AND f.bbox_e + 1.36 AND p.lat BETWEEN f.bbox_s - 1.36 AND f.bbox_n + 1.36
    AND SQRT(POW(GREATEST(f.bbox_w - p.lon, 0, p.lon - f.bbox_e), 2) + POW(GREATEST(f.bbox_s - p.lat, 0, p.lat - f.bbox_n), 2))
      <= 150 / 111.0::DOUBLE) AS {name} FROM fx_floods f"""


@query("j1_activation_match", _POINT_MATCH.format(name="match_ems"))
def _(t):
    return matching.match_points(t.flood_shapes, t.activations).select("event_id", "match_ems")


_POLYGON_MATCH = """SELECT f.event_id, EXISTS (SELECT 1 FROM fx_floods d WHERE d.source = 'dfo'
    AND d.date_start - 15 <= f.date_end AND d.date_end + 15 >= f.date_start
    AND d.bbox_w <= f.bbox_e AND d.bbox_e >= f.bbox_w AND d.bbox_s <= f.bbox_n AND d.bbox_n >= f.bbox_s) AS match_dfo
  FROM fx_floods f WHERE f.source = 'groundsource'"""


@query("j2_archive_match", _POLYGON_MATCH)
def _(t):
    f = t.flood_shapes
    return matching.match_polygons(f.filter("source = 'groundsource'"), f.filter("source = 'dfo'")).select("event_id", "match_dfo")


_COUNTRY = """SELECT f.event_id, f.date_start, f.date_end, (SELECT MIN_BY(iso_a3, country_id) FROM fx_countries k
    WHERE f.lon > k.bbox_w AND f.lon < k.bbox_e AND f.lat > k.bbox_s AND f.lat < k.bbox_n) AS iso3 FROM fx_floods f"""


@query("j3_relief_match", f"""WITH e AS ({_COUNTRY}) SELECT event_id, EXISTS (SELECT 1 FROM fx_relief r WHERE r.iso3 = e.iso3
  AND r.date BETWEEN e.date_start - 15 AND e.date_end + 15) AS match_ifrc FROM e""")
def _(t):
    return matching.match_country_dates(matching.assign_country(t.floods, t.countries), t.relief).select("event_id", "match_ifrc")


@query("j4_country_code", f"SELECT event_id, iso3 FROM ({_COUNTRY})")
def _(t):
    return matching.assign_country(t.floods, t.countries).select("event_id", "iso3")


@query("j5_patch_country", f"SELECT event_id, COALESCE(iso3, '') AS country FROM ({_COUNTRY})")
def _(t):
    return matching.assign_country(t.floods, t.countries, name="country", default="").select("event_id", "country")


def scene_boxes(t):
    lon, lat = F.col("lon"), F.col("lat")
    return t.scenes.select("scene_id", "acq", (lon - 1).alias("bbox_w"), (lat - 1).alias("bbox_s"),
                           (lon + 1).alias("bbox_e"), (lat + 1).alias("bbox_n"))


@query("j6_event_scenes", """SELECT e.event_id, s.scene_id FROM fx_floods e JOIN fx_scenes s
  ON s.acq BETWEEN e.date_start AND e.date_end AND e.bbox_w <= s.lon + 1 AND e.bbox_e >= s.lon - 1
  AND e.bbox_s <= s.lat + 1 AND e.bbox_n >= s.lat - 1""")
def _(t):
    return matching.event_scenes(t.floods, scene_boxes(t)).select("event_id", "scene_id")


@query("j7_score_link", """SELECT s.scene_id, b.cs FROM fx_scenes s LEFT JOIN (SELECT scene_id, ROUND(1 - cloud, 3) AS cs FROM fx_scenes
  WHERE rel_orbit <> 0) b ON s.scene_id = b.scene_id""")
def _(t):
    scores = t.scenes.filter("rel_orbit <> 0").select("scene_id", F.round(1 - F.col("cloud"), 3).alias("cs"))
    return imagery.link_scores(t.scenes.select("scene_id"), scores)


def flood_targets(t):
    return t.floods.select("event_id", (F.col("ev") % 200).alias("ev"), "date_start", "date_end")


@query("j8_nearest_radar", """SELECT f.event_id, MIN_BY(s.scene_id, (ABS(s.acq - (f.date_start - 5)), s.acq, s.scene_id)) AS scene_id,
  CAST(MIN(ABS(s.acq - (f.date_start - 5))) AS INT) AS gap_days, COUNT(*) AS n_scenes
  FROM fx_floods f JOIN fx_scenes s ON s.ev = f.ev % 200 AND s.acq >= f.date_start - 65 AND s.acq < f.date_start - 5
  WHERE s.mode = 'IW' AND s.dual = 1 GROUP BY f.event_id""")
def _(t):
    targets = flood_targets(t).withColumn("target", F.date_sub("date_start", 5))
    return imagery.nearest_radar(targets, with_polarisations(t.scenes), 60, 0).select(
        "event_id", "scene_id", "gap_days", "n_scenes")


@query("j9_radar_pair", """WITH s AS (SELECT * FROM fx_scenes WHERE mode = 'IW' AND dual = 1),
  pre AS (SELECT f.event_id, MAX_BY(s.scene_id, (s.acq, s.scene_id)) AS scene, MAX_BY(s.pass, (s.acq, s.scene_id)) AS pass,
    MAX_BY(s.rel_orbit, (s.acq, s.scene_id)) AS orbit FROM fx_floods f JOIN s ON s.ev = f.ev % 200
    AND s.acq >= f.date_start - 30 AND s.acq < f.date_start GROUP BY f.event_id),
  post AS (SELECT f.event_id, MIN_BY(s.scene_id, (s.acq, s.scene_id)) AS scene FROM fx_floods f LEFT JOIN pre USING (event_id)
    JOIN s ON s.ev = f.ev % 200 AND s.acq >= f.date_end AND s.acq < f.date_end + 30
    AND (pre.scene IS NULL OR (s.pass = pre.pass AND s.rel_orbit = pre.orbit)) GROUP BY f.event_id)
  SELECT f.event_id, pre.scene AS pre_scene, post.scene AS post_scene, pre.pass AS pass, pre.orbit AS rel_orbit
  FROM fx_floods f LEFT JOIN pre USING (event_id) LEFT JOIN post USING (event_id)""")
def _(t):
    return imagery.radar_pair(flood_targets(t), with_polarisations(t.scenes)).select(
        "event_id", "pre_scene", "post_scene", "pass", "rel_orbit")


# the same picks, with scenes found by their boxes instead of an equal key
_BOUNDED = ("e.bbox_w <= s.lon + 1 AND e.bbox_e >= s.lon - 1 AND e.bbox_s <= s.lat + 1 AND e.bbox_n >= s.lat - 1")


def boxed_scenes(t):
    lon, lat = F.col("lon"), F.col("lat")
    return with_polarisations(t.scenes).withColumns({"bbox_w": lon - 1, "bbox_s": lat - 1, "bbox_e": lon + 1, "bbox_n": lat + 1})


@query("j6_scene_counts", f"""SELECT e.event_id, COUNT(*) AS n_scenes, MIN_BY(s.scene_id, (s.acq, s.scene_id)) AS first_scene,
  MAX_BY(s.scene_id, (s.acq, s.scene_id)) AS last_scene FROM fx_floods e JOIN fx_scenes s
  ON s.acq BETWEEN e.date_start AND e.date_end AND {_BOUNDED} GROUP BY e.event_id""")
def _(t):
    return imagery.scenes_between(t.floods, scene_boxes(t))


@query("j8_nearest_radar_by_bounds", f"""SELECT e.event_id, MIN_BY(s.scene_id, (ABS(s.acq - (e.date_start - 5)), s.acq, s.scene_id)) AS scene_id,
  CAST(MIN(ABS(s.acq - (e.date_start - 5))) AS INT) AS gap_days, COUNT(*) AS n_scenes
  FROM fx_floods e JOIN fx_scenes s ON {_BOUNDED} AND s.acq >= e.date_start - 35 AND s.acq < e.date_start + 15
  WHERE s.mode = 'IW' AND s.dual = 1 GROUP BY e.event_id""")
def _(t):
    targets = t.floods.select("event_id", "bbox_w", "bbox_s", "bbox_e", "bbox_n", F.date_sub("date_start", 5).alias("target"))
    return imagery.nearest_radar(targets, boxed_scenes(t), 30, 20, by=imagery.BOUNDS).select("event_id", "scene_id", "gap_days", "n_scenes")


@query("j9_radar_pair_by_bounds", f"""WITH s AS (SELECT * FROM fx_scenes WHERE mode = 'IW' AND dual = 1),
  pre AS (SELECT e.event_id, MAX_BY(s.scene_id, (s.acq, s.scene_id)) AS scene, MAX_BY(s.pass, (s.acq, s.scene_id)) AS pass,
    MAX_BY(s.rel_orbit, (s.acq, s.scene_id)) AS orbit FROM fx_floods e JOIN s ON {_BOUNDED}
    AND s.acq >= e.date_start - 30 AND s.acq < e.date_start GROUP BY e.event_id),
  post AS (SELECT e.event_id, MIN_BY(s.scene_id, (s.acq, s.scene_id)) AS scene FROM fx_floods e LEFT JOIN pre USING (event_id)
    JOIN s ON {_BOUNDED} AND s.acq >= e.date_end AND s.acq < e.date_end + 30
    AND (pre.scene IS NULL OR (s.pass = pre.pass AND s.rel_orbit = pre.orbit)) GROUP BY e.event_id)
  SELECT e.event_id, pre.scene AS pre_scene, post.scene AS post_scene, pre.pass AS pass, pre.orbit AS rel_orbit
  FROM fx_floods e LEFT JOIN pre USING (event_id) LEFT JOIN post USING (event_id)""")
def _(t):
    return imagery.radar_pair(t.floods, boxed_scenes(t), by=imagery.BOUNDS).select("event_id", "pre_scene", "post_scene", "pass", "rel_orbit")


@query("j10_sidecar_patch", """SELECT CAST(o.o_orderkey AS STRING) AS chip_id, CASE WHEN l.n IS NULL THEN o.o_orderstatus ELSE CAST(l.n AS STRING) END AS qc,
  l.n IS NULL AS orphan FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey""")
def _(t):
    docs = t.orders.select(F.col("o_orderkey").cast("string").alias("chip_id"), F.col("o_orderstatus").alias("qc"))
    blocks = t.lineitem.filter("l_quantity > 10").groupBy(F.col("l_orderkey").cast("string").alias("chip_id")).agg(
        F.count("*").cast("string").alias("qc"))
    lost = sidecars.orphans(docs, blocks).select("chip_id", F.lit(True).alias("orphan"))
    return sidecars.patch_block(docs, blocks, "qc").join(lost, "chip_id", "left").withColumn(
        "orphan", F.coalesce("orphan", F.lit(False)))


@query("j11_skip_done", """SELECT event_id FROM fx_floods WHERE NOT (ev IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
  OR ev IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07))""")
def _(t):
    from ..streaming.cycles import without
    ids = lambda cond: t.lineitem.filter(cond).select(F.col("l_orderkey").alias("ev"))
    return without(t.floods, ids("l_quantity > 45"), ids("l_tax > 0.07"), key="ev").select("event_id")


@query("j12_zonal_join", """SELECT f.ev, f.row, f.col, COUNT(*) AS n, CAST(SUM(s.extent) AS BIGINT) AS wet FROM
  (SELECT DISTINCT ev, r - r % 10 AS row, c - c % 10 AS col FROM fx_label WHERE label = 1) f
  JOIN fx_stack s ON s.ev = f.ev AND s.r - s.r % 10 = f.row AND s.c - s.c % 10 = f.col GROUP BY ALL""")
def _(t):
    from ..functions.classes import flood_class
    chips = t.cells.filter(flood_class("flood", F.col("crop") == 1, "excl") == 1).select(
        "ev", (F.col("r") - F.col("r") % 10).alias("row"), (F.col("c") - F.col("c") % 10).alias("col")).distinct()
    named = chips.withColumn("chip_id", F.format_string("%d_%d_%d", "ev", "row", "col"))
    per = raster.cut_out(t.stack, named, 10).groupBy("chip_id").agg(F.count("*").alias("n"), F.sum("extent").alias("wet"))
    return named.join(per, "chip_id").select("ev", "row", "col", "n", "wet")


@query("j13_layer_alignment", """SELECT a.ev, a.r, a.c, a.extent, b.extent AS water, d.extent AS likelihood
  FROM (SELECT * FROM fx_stack WHERE day_no = 0) a
  LEFT JOIN (SELECT * FROM fx_stack WHERE day_no = 1 AND crop = 1) b USING (ev, r, c)
  LEFT JOIN (SELECT * FROM fx_stack WHERE day_no = 2 AND excl = 0) d USING (ev, r, c)""")
def _(t):
    layer = lambda cond: t.stack.filter(cond).select("ev", "r", "c", F.col("extent").alias("value"))
    extent = t.stack.filter("day_no = 0").select("ev", "r", "c", "extent")
    return raster.align_layers(extent, {
        "water": layer("day_no = 1 AND crop = 1"), "likelihood": layer("day_no = 2 AND excl = 0")}, ["ev"])


@query("j14_seen_before", """WITH p AS (SELECT ev AS seq, lon, lat, date_start - DATE '1970-01-01' AS day FROM fx_candidates),
  q AS (SELECT *, FLOOR(day / 31) + UNNEST([-1, 0, 1]) AS k FROM p)
  SELECT p.seq, EXISTS (SELECT 1 FROM q WHERE q.k = FLOOR(p.day / 31) AND q.seq < p.seq AND ABS(p.day - q.day) <= 30
    AND SQRT(POW((p.lon - q.lon) * 111 * COS(RADIANS(p.lat)), 2) + POW((p.lat - q.lat) * 111, 2)) <= 100) AS seen FROM p""")
def _(t):
    return matching.seen_before(dedup_view(t), km=100.0).select("seq", "seen")


def dedup_view(t):
    day = F.date_diff("date_start", F.lit("1970-01-01").cast("date"))
    return t.candidates.select(F.col("ev").alias("seq"), "lon", "lat", day.alias("day"))


@query("j15_release_filter", """SELECT o_orderkey AS chip FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)""")
def _(t):
    excluded = t.lineitem.filter("l_quantity > 48").select(F.col("l_orderkey").alias("chip_id")).distinct()
    return release.released_chips(t.orders.select(F.col("o_orderkey").alias("chip_id")), excluded).withColumnRenamed("chip_id", "chip")


def batched_events(t):
    """Events that recur in several batches: one row per order line."""
    return t.lineitem.select(F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("event_id"),
                             F.col("l_linenumber").alias("batch_no")).distinct()


def batched_chips(t):
    return t.lineitem.filter("l_quantity > 25").select(
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("event_id"),
        F.col("l_linenumber").alias("batch_no"), (F.col("l_discount") > 0.05).alias("has_s2_pre"))


MASTER_SQL = """SELECT e.event_id, e.batch_no, COALESCE(n_chips, 0) AS n_chips, COALESCE(n_imaged, 0) AS n_chips_imaged,
  CASE WHEN COALESCE(n_chips, 0) > 0 THEN 1 ELSE 0 END AS flooded_crops FROM
  (SELECT 'E' || CAST(l_orderkey AS STRING) AS event_id, MIN(l_linenumber) AS batch_no FROM lineitem GROUP BY 1) e
  LEFT JOIN (SELECT 'E' || CAST(l_orderkey AS STRING) AS event_id, l_linenumber AS batch_no, COUNT(*) AS n_chips,
    COUNT(*) FILTER (l_discount > 0.05) AS n_imaged FROM lineitem WHERE l_quantity > 25 GROUP BY ALL) c USING (event_id, batch_no)"""


@query("j16_master_chip_counts", MASTER_SQL)
def _(t):
    return release.master_events(batched_events(t), batched_chips(t))
