"""Composite operators U1 to U8 end to end (U1 is in ``images``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import flood_provenance
from ..operators import catalog, composites, fire, growth, matching, raster, release
from .aggregates import STAGE_SQL
from .joins import _COUNTRY, batched_chips, batched_events, dedup_view
from .registry import query
from .scalars import _INVERSE, BOXES_SQL
from .windows import CLUSTER_SQL, SCREENED_SQL, VISIT_SQL, screen, visits, with_continent


@query("u0_candidate_events", f"""SELECT event_id, CAST(date_start AS STRING) AS date_start, cluster_size, {BOXES_SQL} AS continent,
  CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CAST(FLOOR((lon + 180) / 6) AS INT) + 1 AS INT) AS epsg FROM ({CLUSTER_SQL})""")
def _(t):
    reps = with_continent(catalog.cluster_events(t.floods))
    return reps.select("event_id", F.col("date_start").cast("string").alias("date_start"), "cluster_size", "continent",
                       geo.utm_epsg("lon", "lat").alias("epsg"))


# the sequential rule as a fixpoint: a row is settled once nothing earlier can change its fate
REGIONS = [name for name, _ in geo.CONTINENT_BOXES]
EARLIER, WANTED = "ev % 97 = 5", 3000  # events of an earlier run, and how many new ones to accept
ACCEPT_SQL = f"""WITH RECURSIVE g AS (SELECT ROW_NUMBER() OVER (ORDER BY month, year, COALESCE(LIST_POSITION({REGIONS}, continent), 0), ev) AS seq, * FROM (
    SELECT ev, event_id, lon, lat, date_start - DATE '1970-01-01' AS day, MONTH(date_start) AS month, YEAR(date_start) AS year,
    {BOXES_SQL} AS continent, half_deg, n_indep, dur_days FROM fx_candidates WHERE NOT ({EARLIER}) AND area_km2 BETWEEN 50 AND 20000 AND half_deg >= 0.15)),
  old AS (SELECT lon AS olon, lat AS olat, date_start - DATE '1970-01-01' AS oday FROM fx_candidates WHERE {EARLIER}),
  v AS (SELECT * FROM g WHERE half_deg >= 0.2 AND n_indep / 4.0 >= 0.2 AND dur_days >= 3
    AND NOT EXISTS (SELECT 1 FROM old WHERE ABS(day - oday) <= 30 AND SQRT(POW((lon - olon) * 111 * COS(RADIANS(lat)), 2) + POW((lat - olat) * 111, 2)) <= 25)),
  near AS (SELECT *, FLOOR(day / 31) + UNNEST([-1, 0, 1]) AS k FROM v),
  e AS (SELECT a.seq AS i, b.seq AS j FROM v a JOIN near b ON b.k = FLOOR(a.day / 31) AND b.seq < a.seq AND ABS(a.day - b.day) <= 30
    AND SQRT(POW((a.lon - b.lon) * 111 * COS(RADIANS(a.lat)), 2) + POW((a.lat - b.lat) * 111, 2)) <= 25),
  s(seq, month, year, continent, st, step) AS (SELECT seq, month, year, continent, 0, 0 FROM v UNION ALL
    SELECT c.seq, c.month, c.year, c.continent, CASE WHEN c.st > 0 THEN c.st WHEN h.hit OR c.taken >= 8 THEN 2
      WHEN NOT COALESCE(h.wait, false) AND c.alive < 8 THEN 1 ELSE 0 END, c.step + 1
    FROM (SELECT *, COUNT(*) FILTER (st = 1) OVER w AS taken, COUNT(*) FILTER (st < 2) OVER w AS alive, COUNT(*) FILTER (st = 0) OVER () AS open FROM s
      WINDOW w AS (PARTITION BY month, year, continent ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) c
    LEFT JOIN (SELECT e.i, BOOL_OR(s.st = 1) AS hit, BOOL_OR(s.st = 0) AS wait FROM e JOIN s ON s.seq = e.j GROUP BY e.i) h ON h.i = c.seq WHERE c.open > 0)
  SELECT event_id, s.seq, CAST(s.month AS INT) AS month, CAST(s.year AS INT) AS year, s.continent FROM s JOIN v USING (seq)
  WHERE st = 1 AND step = (SELECT MAX(step) FROM s) ORDER BY s.seq LIMIT {WANTED}"""


@query("u2_fire_acceptance", ACCEPT_SQL)
def _(t):
    seen = dedup_view(t).withColumnRenamed("seq", "ev")
    c = t.candidates.select("ev", "area_km2", "half_deg", "n_indep", "dur_days", "date_start", "event_id")
    patches = seen.join(c, "ev").withColumns({
        "km2": F.col("area_km2"), "crop_frac": F.col("half_deg"), "doy_min": F.dayofyear("date_start"),
        "modis_frac": F.col("half_deg"), "viirs_frac": F.col("n_indep") / 4.0, "af_count": F.col("dur_days"),
        "month": F.month("date_start"), "year": F.year("date_start"), "continent": geo.continent_of("lon", "lat")})
    cell = ["month", "year", "continent"]
    in_turn = fire.build_order(fire.patch_gates(patches.filter(f"NOT ({EARLIER})")), REGIONS, "ev")
    verified = fire.confirmed(in_turn).select("seq", "event_id", "lon", "lat", "day", *cell)
    earlier = patches.filter(EARLIER).select("lon", "lat", "day")
    return fire.accept_events(verified, cell, total=WANTED, accepted=earlier).select("event_id", "seq", *cell)


@query("u3_sampled_events", VISIT_SQL + SCREENED_SQL + """, kept AS (SELECT * FROM k WHERE ok AND running <= 500)
  SELECT event_id, visit, CASE WHEN n_indep > 0 THEN bbox_w + 0.05 ELSE bbox_w END AS bbox_w, n_indep > 0 AS aoi_tightened,
  CAST(date_start AS STRING) AS event_date_start, CAST(date_start - 4 AS STRING) AS date_start, CAST(date_end + 14 AS STRING) AS date_end FROM kept""")
def _(t):
    tight = F.col("n_indep") > 0
    box = F.struct(*[(F.col(f"bbox_{k}") + d).alias(k) for k, d in zip("wsen", (0.05, 0.05, -0.05, -0.05))])
    measured = t.floods.select(
        "event_id", F.when(tight, box).alias("flood_bbox"), F.date_sub("date_start", 4).alias("search_start"),
        F.date_add("date_end", 14).alias("search_end"))
    kept, _log = catalog.sample_and_screen(visits(t).drop("passed"), screen(t).join(measured, "event_id"), 500)
    text = lambda c: F.col(c).cast("string").alias(c)
    return catalog.merge_screen(kept).select(
        "event_id", "visit", "bbox_w", F.coalesce("aoi_tightened", F.lit(False)).alias("aoi_tightened"),
        text("event_date_start"), text("date_start"), text("date_end"))


@query("u3_screen_log", VISIT_SQL + SCREENED_SQL + """, stop AS (SELECT COUNT(*) AS n, MAX(visit) AS last FROM k WHERE ok AND running <= 500)
  SELECT event_id, visit, CASE WHEN ok IS NULL THEN 'error' WHEN ok THEN 'pass' ELSE 'no_flood' END AS outcome
  FROM k, stop WHERE n < 500 OR visit <= last""")
def _(t):
    _kept, log = catalog.sample_and_screen(visits(t).drop("passed"), screen(t), 500)
    return log.select("event_id", "visit", "outcome")


# the raster of an event is that of its number modulo AREAS, 80 m cells from a corner in the event's own zone
AREAS, CORNER_X, CORNER_Y, FLOODED_PX = 5, 480000.0, 5000000.0, 1150
SCREEN_SQL = VISIT_SQL + f""", cell AS (SELECT ev, r, c, BOOL_OR(extent = 1) AS wet FROM fx_stack WHERE ev < {AREAS} GROUP BY ALL),
  px AS (SELECT ev, COUNT(*) FILTER (wet) AS px, MIN(c) FILTER (wet) AS w, MIN(-r) FILTER (wet) AS s, MAX(c) FILTER (wet) AS e, MAX(-r) FILTER (wet) AS n FROM cell GROUP BY ev),
  od AS (SELECT ev, COUNT(DISTINCT day_no) AS days FROM fx_stack GROUP BY ev),
  sc AS (SELECT ev, COUNT(*) AS scenes FROM fx_scenes GROUP BY ev),
  k AS (SELECT v.*, px, w, s, e, n, COALESCE(days, 0) AS days, COALESCE(scenes, 0) AS scenes, COALESCE(px >= {FLOODED_PX} AND scenes >= 1, false) AS ok,
    SUM(CASE WHEN px >= {FLOODED_PX} AND scenes >= 1 THEN 1 ELSE 0 END) OVER (ORDER BY visit) AS running
    FROM v LEFT JOIN px ON px.ev = v.ev % {AREAS} LEFT JOIN od ON od.ev = v.ev % {AREAS} LEFT JOIN sc ON sc.ev = v.ev % {AREAS})"""


def measured_screen(t):
    """The flood screen of candidates (event_id, ev, lon): cells of the areas that they need, once per area."""
    stack = t.stack.withColumns({"x": F.col("c") * 80.0 + CORNER_X, "y": F.col("r") * -80.0 + CORNER_Y, "area": F.col("ev")})
    scenes = t.scenes.groupBy(F.col("ev").alias("area")).agg(F.count("*").alias("n_scenes"))
    days = t.stack.groupBy(F.col("ev").alias("area")).agg(F.count_distinct("day_no").alias("n_overpass_days"))

    def screen_areas(candidates):
        asked = candidates.select("event_id", "lon", "date_start", "date_end", (F.col("ev") % AREAS).alias("area"))
        areas = asked.select("area").distinct()
        found = raster.flood_screen(areas, stack.join(areas, "area", "left_semi"), scenes, "area", 0.0064, FLOODED_PX)
        found = asked.join(found.join(days, "area", "left"), "area").withColumn("epsg", geo.utm_epsg("lon", F.lit(1.0)))
        return raster.lonlat_box(found).select(
            "event_id", "passed", "outcome", "n_scenes", F.coalesce("n_overpass_days", F.lit(0)).alias("n_overpass_days"), "flood_px", "flood_km2", "epsg",
            "flood_bbox", F.date_sub("date_start", 4).alias("search_start"), F.date_add("date_end", 14).alias("search_end"))

    return screen_areas


@query("u3_flood_manifest", SCREEN_SQL + f""", kept AS (SELECT *, CAST(FLOOR((lon + 180) / 6) + 1 AS DOUBLE) * 6 - 183 AS cm FROM k WHERE ok AND running <= 500),
  pts AS (SELECT event_id AS ev, cm, 1 AS lat, UNNEST([w, w, e, e]) * 80.0::DOUBLE + {CORNER_X} AS cx, UNNEST([s, n, s, n]) * 80.0::DOUBLE + {CORNER_Y} AS cy FROM kept),
  {_INVERSE}, box AS (SELECT ev, ROUND(MIN(lo), 5) AS w, ROUND(MIN(la), 5) AS s, ROUND(MAX(lo), 5) AS e, ROUND(MAX(la), 5) AS n FROM ll GROUP BY ev)
  SELECT event_id, visit, box.w AS bbox_w, box.s AS bbox_s, box.e AS bbox_e, box.n AS bbox_n, true AS aoi_tightened, source, tier, CAST(year AS INT) AS year,
  CAST(date_start AS STRING) AS event_date_start, CAST(date_end AS STRING) AS event_date_end, CAST(date_start - 4 AS STRING) AS date_start,
  CAST(date_end + 14 AS STRING) AS date_end, CAST(scenes AS INT) AS gfm_n_scenes, CAST(days AS INT) AS gfm_n_overpass_days, CAST(px AS INT) AS gfm_flood_px,
  round_even(px * 0.0064::DOUBLE, 3) AS gfm_flood_km2, CAST(32601 + FLOOR((lon + 180) / 6) AS INT) AS gfm_epsg, area_km2_reported, n_indep
  FROM kept JOIN box ON box.ev = event_id""")
def _(t):
    kept, _log = catalog.screen_until(visits(t).drop("passed"), measured_screen(t), 500)
    out = catalog.screened_manifest(kept)
    dates = {c: F.col(c).cast("string") for c in ("event_date_start", "event_date_end", "date_start", "date_end")}
    return out.withColumns(dates).select(
        "event_id", "visit", "bbox_w", "bbox_s", "bbox_e", "bbox_n", "aoi_tightened", "source", "tier", "year", *dates, "gfm_n_scenes",
        "gfm_n_overpass_days", "gfm_flood_px", "gfm_flood_km2", "gfm_epsg", "area_km2_reported", "n_indep")


@query("u3_measured_log", SCREEN_SQL + """, stop AS (SELECT COUNT(*) AS kept, MAX(visit) AS last FROM k WHERE ok AND running <= 500)
  SELECT event_id, visit, ok AS passed, CASE WHEN px IS NULL OR scenes = 0 THEN 'transient' WHEN ok THEN 'pass' ELSE 'no_flood' END AS outcome
  FROM k, stop WHERE kept < 500 OR visit <= last""")
def _(t):
    _kept, log = catalog.screen_until(visits(t).drop("passed"), measured_screen(t), 500)
    return log.select("event_id", "visit", "passed", "outcome")


@query("u4_corroboration", f"""WITH e AS ({_COUNTRY.replace('SELECT f.event_id', 'SELECT f.*, f.event_id AS id0', 1).replace(', f.date_start, f.date_end,', ',')} WHERE f.source = 'groundsource'),
  x AS (SELECT event_id, EXISTS (SELECT 1 FROM fx_points p WHERE DATE '1995-01-01' + p.day_no BETWEEN e.date_start - 15 AND e.date_end + 15
      AND SQRT(POW(GREATEST(e.bbox_w - p.lon, 0, p.lon - e.bbox_e), 2) + POW(GREATEST(e.bbox_s - p.lat, 0, p.lat - e.bbox_n), 2)) <= 150 / 111.0::DOUBLE) AS match_ems,
    EXISTS (SELECT 1 FROM fx_floods d WHERE d.source = 'dfo' AND d.date_start - 15 <= e.date_end AND d.date_end + 15 >= e.date_start
      AND d.bbox_w <= e.bbox_e AND d.bbox_e >= e.bbox_w AND d.bbox_s <= e.bbox_n AND d.bbox_n >= e.bbox_s) AS match_dfo,
    EXISTS (SELECT 1 FROM fx_relief r WHERE r.iso3 = e.iso3 AND r.date BETWEEN e.date_start - 15 AND e.date_end + 15) AS match_ifrc FROM e)
  SELECT event_id, match_ems, match_dfo, match_ifrc, CAST(match_ems AS INT) + CAST(match_dfo AS INT) + CAST(match_ifrc AS INT) AS n_indep FROM x""")
def _(t):
    shapes = t.flood_shapes.drop("n_indep")
    out = matching.corroborate(
        shapes.filter("source = 'groundsource'"), t.activations, shapes.filter("source = 'dfo'"), t.relief, t.countries)
    return out.select("event_id", "match_ems", "match_dfo", "match_ifrc", "n_indep")


def label_stack(t):
    return t.stack.withColumns({
        "day": F.col("day_no"), "water": F.col("extent"),
        "exclusion": F.when(F.col("extent").isNotNull(), F.when(F.col("day_no") == 3, F.col("excl")).otherwise(0)),
        "likelihood": F.when(F.col("extent").isNotNull(), (F.col("r") * 3 + F.col("c") + F.col("day_no") * 11) % 101)})


def fine_crop(t):
    return raster.resample_nearest(t.cells.select("ev", "r", "c", (F.col("crop") == 1).alias("crop")))


FLOOD_LABEL_SQL = """red AS (SELECT ev, r, c, crop, MAX(extent) AS extent, MAX(CASE WHEN extent IS NOT NULL THEN CASE WHEN day_no = 3 THEN excl ELSE 0 END END) AS exclusion,
    round_even(100.0::DOUBLE * COUNT(*) FILTER (extent > 0) / COUNT(extent), 0) AS pers FROM fx_stack GROUP BY ALL),
  tgt AS (SELECT ev, r, c, r * 2 + i AS tr, c * 2 + j AS tc, r + CASE WHEN ka = 0 THEN 0 WHEN i = 0 THEN -1 ELSE 1 END AS sr,
    c + CASE WHEN kb = 0 THEN 0 WHEN j = 0 THEN -1 ELSE 1 END AS sc, CASE WHEN ka = 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END * CASE WHEN kb = 0 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS w
    FROM red, (SELECT UNNEST([0, 1]) AS i), (SELECT UNNEST([0, 1]) AS j), (SELECT UNNEST([0, 1]) AS ka), (SELECT UNNEST([0, 1]) AS kb)),
  fine AS (SELECT tgt.ev, tr AS r, tc AS c, tgt.r AS r0, tgt.c AS c0, ROUND(SUM(w * s.pers) / SUM(CASE WHEN s.pers IS NOT NULL THEN w END)) AS pers
    FROM tgt LEFT JOIN red s ON s.ev = tgt.ev AND s.r = sr AND s.c = sc GROUP BY ALL),
  lab AS (SELECT fine.ev, fine.r, fine.c, fine.pers, CASE WHEN crop = 0 THEN 4 WHEN extent IS NULL THEN 255 WHEN exclusion = 1 THEN 3 WHEN extent > 0 THEN 1 ELSE 2 END AS label
    FROM fine JOIN red ON red.ev = fine.ev AND red.r = r0 AND red.c = c0)"""


@query("u5_flood_label_chips", "WITH " + FLOOD_LABEL_SQL + """, tile AS (SELECT ev, r - r % 20 AS row, c - c % 20 AS col, COUNT(*) FILTER (label <> 255) AS nv,
    COUNT(*) FILTER (label IN (1, 2, 3)) AS cp, COUNT(*) FILTER (label = 1) AS fp, AVG(pers) FILTER (label = 1) AS pm FROM lab GROUP BY ALL HAVING COUNT(*) = 400),
  ok AS (SELECT *, round_even(fp / CAST(nv AS DOUBLE), 4) AS share FROM tile WHERE nv >= 200 AND cp / CAST(nv AS DOUBLE) >= 0.2 AND fp / CAST(nv AS DOUBLE) >= 0.02)
  SELECT 'E' || CAST(ev AS STRING) || '_r' || LPAD(CAST(row AS STRING), 4, '0') || '_c' || LPAD(CAST(col AS STRING), 4, '0') AS chip_id,
  CAST(rank - 1 AS INT) AS rank, fp AS flooded_crop_px, share AS flooded_crop_frac, round_even(pm, 1) AS persistence FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ev ORDER BY share DESC, row, col) AS rank FROM ok) WHERE rank <= 5""")
def _(t):
    cells = composites.flood_label(label_stack(t), fine_crop(t))
    return composites.flood_chips(cells, 20).select(
        "chip_id", "rank", "flooded_crop_px", "flooded_crop_frac", F.col("flood_persistence_mean").alias("persistence"))


@query("u5_chip_sidecar", """SELECT event_id, CASE WHEN source = 'groundsource' THEN 'Groundsource (news)' ELSE source END AS origin,
  CASE WHEN n_indep % 2 = 1 THEN 'GFM,EMS' ELSE 'GFM' END AS confirmed_by, 'X' AS country, CAST(date_start AS STRING) AS event_date_start FROM fx_floods""")
def _(t):
    from ..operators.sidecars import flood_sidecar
    lit = {k: F.lit(v) for k, v in {
        "rank": 0, "country": None, "place": "X", "crs": "EPSG:32632", "res_m": 10, "size": 512, "label_path": "p",
        "flood_persistence_mean": None, "cropland_frac": 0.5, "flooded_crop_frac": 0.1, "flooded_crop_px": 1,
        "excluded_crop_frac": 0.0, "min_lon": 0.0, "min_lat": 0.0, "max_lon": 0.0, "max_lat": 0.0}.items()}
    rows = with_continent(t.floods).withColumns({
        **lit, "chip_id": F.col("event_id"), "event_date_start": F.lit(None).cast("date"), "event_date_end": F.col("date_end")})
    p = flood_provenance("source", "tier", F.col("n_indep") % 2, F.lit("no"), F.lit("no"), "area_km2_reported")
    return rows.select(flood_sidecar(p).alias("d")).select(
        "d.event_id", "d.provenance.origin", F.array_join("d.provenance.confirmed_by", ",").alias("confirmed_by"), "d.country",
        F.col("d.event_date_start").cast("string").alias("event_date_start"))


def optical_pixels(t, first: int, last: int):
    """Pixels of the scenes of one window: two bands and a clear flag."""
    r, c, d = F.col("r"), F.col("c"), F.col("day_no")
    return t.stack.filter(d.between(first, last)).select(
        "ev", "r", "c", d.alias("scene_id"), F.col("extent").isNotNull().alias("clear"), F.lit(1).alias("red"),
        (1000.0 + (r * 37 + c * 11 + d * 53) % 2000).alias("b8"), (200.0 + (r * 13 + c * 29 + d * 71) % 2500).alias("b12"))


def burn_cells_built(t):
    pre, post = (composites.optical_mosaic(optical_pixels(t, a, b), ["b8", "b12"]) for a, b in ((0, 0), (3, 4)))
    return composites.burn_label(pre, post, t.cells.select("ev", "r", "c", "crop"), raster.dilate(t.cells.filter("flood = 1"), ["ev"]))


BURN_SQL = """pix AS (SELECT ev, CAST(r AS INT) AS r, CAST(c AS INT) AS c, day_no, extent IS NOT NULL AS clear, 1000.0::DOUBLE + (r * 37 + c * 11 + day_no * 53) % 2000 AS b8,
    200.0::DOUBLE + (r * 13 + c * 29 + day_no * 71) % 2500 AS b12, CASE WHEN day_no = 0 THEN 0 WHEN day_no IN (3, 4) THEN 1 END AS w FROM fx_stack),
  sh AS (SELECT ev, day_no, AVG(CAST(clear AS INT)) AS f FROM pix GROUP BY ALL),
  mos AS (SELECT ev, r, c, w, MAX_BY(b8, (f, day_no)) AS b8, MAX_BY(b12, (f, day_no)) AS b12 FROM pix JOIN sh USING (ev, day_no) WHERE clear AND w IS NOT NULL GROUP BY ALL),
  per AS (SELECT DISTINCT ev, r + d.i AS r, c + d.j AS c FROM fx_cells, (SELECT UNNEST([0, 0, 0, 1, -1]) AS i, UNNEST([0, 1, -1, 0, 0]) AS j) d WHERE flood = 1),
  dn AS (SELECT g.ev, g.r, g.c, g.crop, ((a.b8 - a.b12) / (a.b8 + a.b12) - (b.b8 - b.b12) / (b.b8 + b.b12)) * 1000 AS dnbr, p.ev IS NOT NULL AS inp
    FROM fx_cells g LEFT JOIN mos a ON a.ev = g.ev AND a.r = g.r AND a.c = g.c AND a.w = 0 LEFT JOIN mos b ON b.ev = g.ev AND b.r = g.r AND b.c = g.c AND b.w = 1
    LEFT JOIN per p ON p.ev = g.ev AND p.r = g.r AND p.c = g.c),
  bl AS (SELECT *, CASE WHEN dnbr >= 660 THEN 4 WHEN dnbr >= 440 THEN 3 WHEN dnbr >= 270 THEN 2 WHEN dnbr >= 100 THEN 1 WHEN dnbr IS NOT NULL THEN 0 END AS severity FROM dn)"""


@query("u6_burn_label", "WITH " + BURN_SQL + """ SELECT ev, r, c, severity, CASE WHEN crop = 0 THEN 4 WHEN severity IS NULL THEN 3
  WHEN severity >= 1 AND inp THEN 1 ELSE 2 END AS label FROM bl""")
def _(t):
    return burn_cells_built(t).select("ev", "r", "c", "severity", "label")


def _burn_chip_sql(k: int = 5) -> str:
    parts = ["WITH " + BURN_SQL, "lb AS (SELECT *, CASE WHEN crop = 0 THEN 4 WHEN severity IS NULL THEN 3 WHEN severity >= 1 AND inp THEN 1 ELSE 2 END AS label FROM bl)",
             "d AS (SELECT ev, r, c, SUM(s) OVER (PARTITION BY ev, c ORDER BY r RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS density FROM (SELECT ev, r, c, "
             "SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY ev, r ORDER BY c RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS s FROM lb))",
             "g AS (SELECT * FROM d WHERE density > 0 AND r >= 3 AND r < 17 AND c >= 3 AND c < 97)"]
    for i in range(1, k + 1):
        clear = " ".join(f"AND NOT EXISTS (SELECT 1 FROM p{j} WHERE p{j}.ev = g.ev AND g.r >= p{j}.r - 7 AND g.r < p{j}.r + 7 "
                         f"AND g.c >= p{j}.c - 7 AND g.c < p{j}.c + 7)" for j in range(1, i))
        parts.append(f"p{i} AS (SELECT ev, {i} AS rank, r, c FROM (SELECT g.*, ROW_NUMBER() OVER (PARTITION BY ev ORDER BY density DESC, r, c) AS n FROM g WHERE true {clear}) WHERE n = 1)")
    parts.append("ct AS (" + " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(1, k + 1)) + ")")
    return ", ".join(parts) + """ SELECT 'E' || CAST(ct.ev AS STRING) || '_r' || LPAD(CAST(ct.r AS STRING), 4, '0') || '_c' || LPAD(CAST(ct.c AS STRING), 4, '0') AS chip_id, rank,
  round_even(COUNT(*) FILTER (label = 1) / CAST(COUNT(*) AS DOUBLE), 4) AS burned_crop_frac, round_even(COUNT(*) FILTER (crop = 1) / CAST(COUNT(*) AS DOUBLE), 4) AS cropland_frac,
  COALESCE(round_even(AVG(severity) FILTER (label = 1), 2), 0) AS burn_severity_mean FROM ct JOIN lb ON lb.ev = ct.ev AND lb.r BETWEEN ct.r - 3 AND ct.r + 3 AND lb.c BETWEEN ct.c - 3 AND ct.c + 3
  GROUP BY ct.ev, ct.r, ct.c, rank HAVING COUNT(*) FILTER (crop = 1) / CAST(COUNT(*) AS DOUBLE) >= 0.2 AND COUNT(*) FILTER (label = 1) / CAST(GREATEST(COUNT(*) FILTER (crop = 1), 1) AS DOUBLE) >= 0.02"""


@query("u6_burn_chips", _burn_chip_sql())
def _(t):
    from ..session import cut_lineage
    return composites.burn_chips(cut_lineage(burn_cells_built(t)), 7).select(
        "chip_id", "rank", "burned_crop_frac", "cropland_frac", "burn_severity_mean")


@query("u7_growth_stage", f"""WITH {STAGE_SQL}, ev AS (SELECT DISTINCT ev AS chip_id, CAST(2021 + ev % 5 AS INT) AS y, DATE '2000-01-01' + (CAST(make_date(CAST(2021 + ev % 5 AS INT), 1, 1) - DATE '2000-01-01' AS INT)
    + 150 + 20 * CAST(ev % 4 AS INT)) AS d FROM fx_cells)
  SELECT ev.chip_id, CASE WHEN y <= 2024 THEN stage END AS stage, CASE WHEN y <= 2024 THEN stage_agreement END AS stage_agreement, CASE WHEN y <= 2024 THEN growth_cycle END AS growth_cycle,
  CASE WHEN y <= 2024 THEN CAST(d AS STRING) END AS burn_date, CASE WHEN y > 2024 THEN 'VNP22Q2 land-surface phenology covers 2013-2024; no data for event year ' || CAST(y AS STRING)
    WHEN stage IS NULL THEN 'no fill-free, monotonic VNP22Q2 cycle over this chip' END AS note FROM ev LEFT JOIN res USING (chip_id)""")
def _(t):
    scored = growth.score_cycles(t.cycles)
    chips = t.cycles.select("chip_id", F.date_add(F.lit("2000-01-01").cast("date"), F.col("day")).alias("event_date")).distinct()
    out = growth.attach_growth(chips, growth.chip_stages(scored), burn=True)
    return out.select("chip_id", F.col("phenology.stage_at_burn").alias("stage"), "phenology.stage_agreement",
                      "phenology.growth_cycle", "phenology.burn_date", F.col("phenology_note").alias("note"))


@query("u8_release", """WITH first AS (SELECT l_orderkey, MIN(l_linenumber) AS b FROM lineitem GROUP BY 1),
  chips AS (SELECT l.l_orderkey, l.l_linenumber, l_discount FROM lineitem l JOIN first f ON f.l_orderkey = l.l_orderkey AND f.b = l.l_linenumber WHERE l_quantity > 25),
  kept AS (SELECT * FROM chips WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07))
  SELECT b AS batch_no, COUNT(*) AS events, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS chips, CAST(COALESCE(SUM(im), 0) AS BIGINT) AS imaged FROM first
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, COUNT(*) FILTER (l_discount > 0.05) AS im FROM kept GROUP BY 1) USING (l_orderkey) GROUP BY b""")
def _(t):
    excluded = t.lineitem.filter("l_tax > 0.07").select(F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("chip_id")).distinct()
    chips = release.released_chips(batched_chips(t).withColumn("chip_id", F.col("event_id")), excluded)
    master = release.master_events(batched_events(t), chips)
    return master.groupBy("batch_no").agg(
        F.count("*").alias("events"), F.sum("n_chips").alias("chips"), F.sum("n_chips_imaged").alias("imaged"))


BURN_CHIP = {  # inputs of the burn document, the same expression on both sides
    "chip_id": "CONCAT('MC', CAST(ev AS STRING), '_r0000_c0000')", "rank": "CAST(ev % 5 AS INT)", "tier": "CASE WHEN ev % 2 = 0 THEN 'A' ELSE 'B' END",
    "continent": "CASE WHEN ev % 3 = 0 THEN 'Africa' ELSE 'Asia' END", "country": "CASE WHEN ev % 4 > 0 THEN 'X' END", "place": "'P'",
    "burn_km2": "area_km2", "modis_frac": "half_deg", "viirs_frac": "half_deg / CAST(2 AS DOUBLE)", "af_count": "dur_days",
    "event_date_start": "date_start", "event_date_end": "CAST(date_start + dur_days AS DATE)", "epsg": "CAST(32600 + ev % 60 + 1 AS INT)", "res_m": "10", "size": "512",
    "burn_severity_mean": "CASE WHEN ev % 6 > 0 THEN half_deg * CAST(5 AS DOUBLE) END", "cropland_frac": "half_deg", "burned_crop_px": "CAST(ev % 5000 AS BIGINT)",
    "label_px": "CAST(262144 AS BIGINT)", "excluded_px": "CAST(ev % 7 AS BIGINT)", "cropland_px": "CAST(ev % 100 AS BIGINT)",
    "min_lon": "lon", "min_lat": "lat", "max_lon": "lon + half_deg", "max_lat": "lat + half_deg",
    "s2_pre_date": "CAST(date_start - 9 AS DATE)", "s2_pre_clear": "CASE WHEN ev % 8 > 0 THEN half_deg END", "s2_pre_n": "n_indep",
    "s2_post_date": "CAST(date_start + 9 AS DATE)", "s2_post_clear": "half_deg", "s2_post_n": "n_indep + 1",
    "s1_pre_n": "n_indep", "s1_pre_date": "CAST(date_start - 3 AS DATE)", "s1_pre_pass": "'ASCENDING'", "s1_pre_orbit": "dur_days",
    "s1_post_n": "CAST(ev % 2 AS INT)", "s1_post_date": "CAST(date_start + 3 AS DATE)", "s1_post_pass": "'DESCENDING'", "s1_post_orbit": "dur_days + 1",
    "s2_pre_first": "CAST(date_start - 60 AS DATE)", "s2_pre_last": "CAST(date_start - 1 AS DATE)",
    "s2_post_first": "CAST(date_start + 1 AS DATE)", "s2_post_last": "CAST(date_start + 60 AS DATE)",
    "has_s2_pre": "ev % 9 > 0", "has_s2_post": "true", "has_s1_pre": "n_indep > 0", "has_s1_post": "ev % 2 = 1", "observed_frac": "half_deg"}
BURN_CHIP_SQL = "SELECT ev, event_id, source, n_indep, " + ", ".join(f"{v.replace('STRING', 'VARCHAR')} AS {k}" for k, v in BURN_CHIP.items()) + " FROM fx_candidates"
_DAY = "STRFTIME({}, '%Y-%m-%d')".format
_R = "round_even({}, {})".format


@query("u6_burn_sidecar", f"""SELECT chip_id, event_id, CAST(rank + 1 AS INT) AS rank, source, tier, continent, country, place, 'MCD64A1 burned-area clustering (GlobFire method)' AS origin,
  'MODIS MCD64A1,VIIRS VNP64A1,VIIRS VNP14A1 active fire' AS confirmed_by, n_indep AS n_independent, burn_km2, modis_frac, viirs_frac, af_count AS active_fire_px,
  {_DAY('event_date_start')} AS event_date_start, {_DAY('event_date_end')} AS event_date_end, 'EPSG:' || epsg AS crs, event_id || '/' || chip_id || '_label.tif' AS label_path,
  {_R('COALESCE(burn_severity_mean, 0)', 2)} AS burn_severity_mean, {_R('cropland_frac', 4)} AS cropland_frac, {_R('burned_crop_px / 262144.0::DOUBLE', 4)} AS burned_crop_frac, burned_crop_px,
  {_R('excluded_px / CAST(GREATEST(cropland_px, 1) AS DOUBLE)', 4)} AS excluded_crop_frac, {_R('min_lon', 6)} AS min_lon, {_R('max_lat', 6)} AS max_lat,
  {_DAY('s2_pre_date')} AS s2_date, {_R('COALESCE(s2_pre_clear, 0)', 4)} AS s2_clear, CAST(s2_post_n AS BIGINT) AS s2_post_n, event_id || '/' || chip_id || '_s2_post.tif' AS s2_post_path,
  CASE WHEN s1_pre_n > 0 THEN {_DAY('s1_pre_date')} END AS s1_date, CASE WHEN s1_pre_n > 0 THEN 'ASCENDING' END AS s1_pass, CASE WHEN s1_post_n > 0 THEN s1_post_orbit END AS s1_post_orbit,
  CASE WHEN s1_pre_n = 0 OR s1_post_n = 0 THEN 'no Sentinel-1 IW VV+VH acquisition over this AOI in the pre and/or post window (genuine SAR coverage gap)' END AS s1_note,
  {_DAY('s2_pre_first')} || ',' || {_DAY('s2_pre_last')} AS pre_window, {_DAY('s2_post_first')} || ',' || {_DAY('s2_post_last')} AS post_window,
  has_s2_pre AND has_s1_pre AND has_s1_post AS all_ok, CASE WHEN has_s1_post THEN 'ok' ELSE 'missing' END AS s1_post,
  CASE WHEN has_s2_pre AND has_s1_pre AND has_s1_post AND observed_frac > 0.5 THEN 'clean' ELSE 'check' END AS verdict FROM ({BURN_CHIP_SQL})""")
def _(t):
    from ..operators.sidecars import burn_sidecar
    rows = t.candidates.selectExpr("ev", "event_id", "source", "n_indep", "area_km2", "half_deg", "dur_days", "lon", "lat", "date_start").selectExpr(
        "event_id", "source", "n_indep", *[f"{v} AS {k}" for k, v in BURN_CHIP.items()])
    d = rows.select(burn_sidecar().alias("d")).select("d.*")
    i, joined = "imagery", lambda c: F.array_join(c, ",")
    return d.select(
        "chip_id", "event_id", "rank", "source", "tier", "continent", "country", "place", "provenance.origin", joined("provenance.confirmed_by").alias("confirmed_by"),
        "provenance.n_independent", "provenance.burn_km2", "provenance.modis_frac", "provenance.viirs_frac", "provenance.active_fire_px",
        "event_date_start", "event_date_end", "crs", "label_path", "burn_severity_mean", "cropland_frac", "burned_crop_frac", "burned_crop_px",
        "excluded_crop_frac", "min_lon", "max_lat", F.col(f"{i}.s2_pre.date").alias("s2_date"), F.col(f"{i}.s2_pre.clear_frac").alias("s2_clear"),
        F.col(f"{i}.s2_post.n_scenes").alias("s2_post_n"), F.col(f"{i}.s2_post.path").alias("s2_post_path"), F.col(f"{i}.s1_pre.date").alias("s1_date"),
        F.col(f"{i}.s1_pre.pass").alias("s1_pass"), F.col(f"{i}.s1_post.rel_orbit").alias("s1_post_orbit"), f"{i}.s1_note",
        joined(f"{i}.s2_pre_window").alias("pre_window"), joined(f"{i}.s2_post_window").alias("post_window"), F.col("qc.all_rasters_ok").alias("all_ok"),
        F.col("qc.rasters.s1_post").alias("s1_post"), "qc.verdict")
