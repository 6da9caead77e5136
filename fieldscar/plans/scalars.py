"""Scalar operators P1 to P44 over the candidate, pixel and cell views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classes as C, dates as D, geo, growth as G, quality as Q, spectral as B, text as T
from ..operators import catalog, fire, imagery, labels
from ..sources import catalogues
from .registry import query

BOXES_SQL = """CASE
  WHEN lon BETWEEN -170 AND -50 AND lat BETWEEN 12 AND 84 THEN 'NorthAmerica'
  WHEN lon BETWEEN -95 AND -58 AND lat BETWEEN 5 AND 27 THEN 'CentralAmericaCaribbean'
  WHEN lon BETWEEN -93 AND -32 AND lat BETWEEN -57 AND 13 THEN 'SouthAmerica'
  WHEN lon BETWEEN -25 AND 45 AND lat BETWEEN 34 AND 72 THEN 'Europe'
  WHEN lon BETWEEN -20 AND 52 AND lat BETWEEN -37 AND 38 THEN 'Africa'
  WHEN lon BETWEEN 34 AND 63 AND lat BETWEEN 12 AND 42 THEN 'MiddleEast'
  WHEN lon BETWEEN 60 AND 98 AND lat BETWEEN 5 AND 38 THEN 'SouthAsia'
  WHEN lon BETWEEN 98 AND 150 AND lat BETWEEN 18 AND 55 THEN 'EastAsia'
  WHEN lon BETWEEN 92 AND 142 AND lat BETWEEN -11 AND 21 THEN 'SoutheastAsia'
  WHEN lon BETWEEN 45 AND 180 AND lat BETWEEN 40 AND 78 THEN 'CentralAsiaRussia'
  WHEN lon BETWEEN 110 AND 180 AND lat BETWEEN -50 AND -10 THEN 'Oceania' ELSE 'Other' END"""


@query("p1_continent_of", f"SELECT event_id, {BOXES_SQL} AS continent FROM fx_candidates")
def _(t):
    return t.candidates.select("event_id", geo.continent_of("lon", "lat").alias("continent"))


@query("p2_scope_filter", "SELECT event_id, year, area_km2_reported FROM fx_floods "
       "WHERE year >= 1996 AND year <= 2000 AND area_km2_reported >= 10 AND area_km2_reported <= 2000")
def _(t):
    return catalog.in_scope(t.floods, 1996, 2000, 10.0, 2000.0).select("event_id", "year", "area_km2_reported")


@query("p3_archive_filter", """SELECT event_id, area_km2_reported / 1000 AS severity FROM fx_floods
  WHERE date_start IS NOT NULL AND year BETWEEN 1996 AND 2000 AND area_km2_reported / 1000 >= 1.5""")
def _(t):
    f = t.floods.withColumn("severity", F.col("area_km2_reported") / 1000)
    return f.filter(catalogues.archive_valid(F.col("severity"), F.col("date_start"), 1996, 2000, 1.5)).select(
        "event_id", "severity")


def _patch_view(t):
    return t.candidates.select(
        "event_id", (F.col("area_km2") * 10).alias("km2"),
        F.when(F.col("n_indep") > 0, F.col("half_deg") / 2).alias("crop_frac"),
        F.when(F.col("dur_days") > 0, F.col("dur_days")).alias("doy_min"))


@query("p4_patch_gates", """SELECT event_id, km2, crop_frac FROM (
  SELECT event_id, area_km2 * 10 AS km2, CASE WHEN n_indep > 0 THEN half_deg / 2 END AS crop_frac,
  CASE WHEN dur_days > 0 THEN dur_days END AS doy_min FROM fx_candidates)
  WHERE km2 >= 50 AND km2 <= 20000 AND crop_frac >= 0.15 AND doy_min IS NOT NULL""")
def _(t):
    return fire.patch_gates(_patch_view(t)).select("event_id", "km2", "crop_frac")


@query("p5_three_way_confirmation", """SELECT event_id FROM (
  SELECT event_id, half_deg AS m, CASE WHEN n_indep > 0 THEN n_indep / 4.0 END AS v, dur_days / 2.0 AS a FROM fx_candidates)
  WHERE COALESCE(m, 0) >= 0.2 AND COALESCE(v, 0) >= 0.2 AND TRUNC(COALESCE(a, 0)) >= 3""")
def _(t):
    v = t.candidates.select(
        "event_id", F.col("half_deg").alias("modis_frac"),
        F.when(F.col("n_indep") > 0, F.col("n_indep") / 4.0).alias("viirs_frac"), (F.col("dur_days") / 2.0).alias("af_count"))
    return fire.confirmed(v).select("event_id")


@query("p6_chip_gates", """WITH f AS (SELECT ev, r - r % 10 AS row, c - c % 10 AS col,
    COUNT(*) FILTER (label <> 255) AS n_valid, COUNT(*) FILTER (label IN (1, 2, 3)) AS crop, COUNT(*) FILTER (label = 1) AS wet
  FROM fx_label GROUP BY ALL HAVING COUNT(*) = 100),
  b AS (SELECT ev, r - r % 10 AS row, c - c % 10 AS col, COUNT(*) AS n, COUNT(*) FILTER (crop = 1) AS crop,
    COUNT(*) FILTER (label = 1) AS burned FROM fx_burn_label GROUP BY ALL)
  SELECT 'flood' AS hazard, ev, row, col FROM f
    WHERE n_valid >= 50 AND crop * 1.0::DOUBLE / n_valid >= 0.2 AND wet * 1.0::DOUBLE / n_valid >= 0.02
  UNION ALL SELECT 'burn', ev, row, col FROM b
    WHERE crop * 1.0::DOUBLE / n >= 0.2 AND burned * 1.0::DOUBLE / GREATEST(crop, 1) >= 0.02""")
def _(t):
    label = C.flood_class("flood", F.col("crop") == 1, "excl")
    flood = labels.flood_chip_gate(
        labels.tile_statistics(t.cells.withColumn("label", label), "ev", 10, persistence=False), 10)
    burn = burn_label_cells(t).withColumns({"row": F.col("r") - F.col("r") % 10, "col": F.col("c") - F.col("c") % 10})
    counts = burn.groupBy("ev", "row", "col").agg(
        F.count("*").alias("n_px"), F.count_if(F.col("crop") == 1).alias("crop_px"),
        F.count_if(F.col("label") == 1).alias("burned_crop_px"))
    pick = lambda df, hazard: df.select(
        F.lit(hazard).alias("hazard"), "ev", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))
    return pick(flood, "flood").unionByName(pick(labels.burn_chip_gate(counts), "burn"))


def burn_label_cells(t):
    cells = t.burn_cells.withColumn("sev", B.burn_severity("dnbr"))
    return cells.withColumn("label", C.burn_class("sev", F.col("crop") == 1, "observed", "in_perimeter"))


@query("p7_utm_epsg", """SELECT event_id, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END
  + CAST(FLOOR((lon + 180) / 6) AS INT) + 1 AS INT) AS epsg FROM fx_candidates""")
def _(t):
    return t.candidates.select("event_id", geo.utm_epsg("lon", "lat").alias("epsg"))


@query("p8_pad_bbox", """SELECT event_id, ROUND(bbox_w - d, 7) AS w, ROUND(bbox_s - 8 / 111.0::DOUBLE, 7) AS s,
  ROUND(bbox_e + d, 7) AS e, ROUND(bbox_n + 8 / 111.0::DOUBLE, 7) AS n FROM (
  SELECT *, 8 / (111.0::DOUBLE * GREATEST(COS(RADIANS((bbox_s + bbox_n) / 2)), 0.1)) AS d FROM fx_floods)""")
def _(t):
    p = t.floods.withColumn("p", geo.pad_bbox_km("bbox_w", "bbox_s", "bbox_e", "bbox_n", 8.0))
    return p.select("event_id", *[F.round(f"p.{k}", 7).alias(k) for k in "wsen"])


@query("p9_pad_window", """SELECT event_id, CAST(date_start - 4 AS STRING) AS first, CAST(date_end + 14 AS STRING) AS last FROM fx_floods""")
def _(t):
    p = t.floods.withColumn("p", D.pad_window("date_start", "date_end", 4, 14))
    return p.select("event_id", F.col("p.start").cast("string").alias("first"), F.col("p.end").cast("string").alias("last"))


@query("p10_day_of_year", "SELECT event_id, CAST(make_date(year, 1, 1) + CAST(ev % 366 AS INT) AS STRING) AS day FROM fx_floods")
def _(t):
    return t.floods.select("event_id", D.day_of_year_date("year", F.col("ev") % 366 + 1).cast("string").alias("day"))


@query("p11_epoch_2000", """SELECT event_id, CAST(date_start - DATE '2000-01-01' AS INT) AS k,
  CAST(DATE '2000-01-01' + CAST(round_even((date_start - DATE '2000-01-01') + n_indep * 0.5::DOUBLE, 0) AS INT) AS STRING) AS back
  FROM fx_floods""")
def _(t):
    k = D.days_since_2000("date_start")
    return t.floods.select("event_id", k.alias("k"), D.date_from_2000(k + F.col("n_indep") * 0.5).cast("string").alias("back"))


@query("p12_bbox_of_rings", """SELECT event_id, round_even(bbox_w, 5) AS w, round_even(bbox_s, 5) AS s,
  round_even(bbox_e, 5) AS e, round_even(bbox_n, 5) AS n FROM fx_floods""")
def _(t):
    return t.flood_shapes.select("event_id", geo.bbox_of_rings("rings").alias("b")).select("event_id", "b.*")


@query("p13_normalized_difference", """SELECT px, (b8 - b12) / (b8 + b12) AS nbr,
  CASE WHEN b8a + b4 <> 0 THEN (b8a - b4) / (b8a + b4) END AS ndvi, (b3 - b11) / (b3 + b11) AS ndsi FROM fx_bands""")
def _(t):
    nd = B.normalized_difference
    return t.bands.select("px", nd("b8", "b12").alias("nbr"), nd("b8a", "b4").alias("ndvi"), nd("b3", "b11").alias("ndsi"))


@query("p14_burn_severity", """SELECT px, d AS dnbr, CASE WHEN d >= 660 THEN 4 WHEN d >= 440 THEN 3 WHEN d >= 270 THEN 2
  WHEN d >= 100 THEN 1 ELSE 0 END AS severity FROM (
  SELECT px, ((b8 - b12) / (b8 + b12) - (b8a - b11) / (b8a + b11)) * 1000 AS d FROM fx_bands)""")
def _(t):
    d = B.dnbr(B.normalized_difference("b8", "b12"), B.normalized_difference("b8a", "b11"))
    return t.bands.select("px", d.alias("dnbr")).withColumn("severity", B.burn_severity("dnbr"))


@query("p15_snow_mask", "SELECT px, (b3 - b11) / (b3 + b11) > 0.42 AND b8 > 1100 AS snow FROM fx_bands")
def _(t):
    return t.bands.select("px", B.is_snow("b3", "b11", "b8").alias("snow"))


@query("p16_clear_mask", "SELECT px, cs >= 0.60 AND NOT ((b3 - b11) / (b3 + b11) > 0.42 AND b8 > 1100) AS clear FROM fx_bands")
def _(t):
    return t.bands.select("px", B.is_clear("cs", "b3", "b11", "b8").alias("clear"))


@query("p17_burn_label", """SELECT ev, r, c, label,
  CASE WHEN observed THEN CAST(TRUNC(LEAST(GREATEST((dnbr + 500) / 8, 0), 254)) AS INT) ELSE 255 END AS dnbr_byte,
  CASE WHEN crop = 1 AND NOT observed THEN 1 ELSE 0 END AS excluded, crop,
  CASE WHEN observed THEN LEAST(sev, 4) ELSE 255 END AS severity FROM fx_burn_label""")
def _(t):
    return burn_label_cells(t).select(
        "ev", "r", "c", "label", C.dnbr_byte("dnbr", "observed").alias("dnbr_byte"),
        ((F.col("crop") == 1) & ~F.col("observed")).cast("int").alias("excluded"), "crop",
        C.severity_byte("sev", "observed").alias("severity"))


@query("p18_flood_label", """SELECT ev, r, c, label, CASE WHEN flood IS NULL THEN 255 ELSE CAST(FLOOR(value) AS INT) % 101 END AS likelihood
  FROM fx_label""")
def _(t):
    return t.cells.select(
        "ev", "r", "c", C.flood_class("flood", F.col("crop") == 1, "excl").alias("label"),
        C.observed_or_nodata(F.floor("value").cast("int") % 101, "flood").alias("likelihood"))


@query("p19_cropland_mask", """SELECT event_id AS px, CASE WHEN event_type = 'click' THEN
    user_id % 200 > 0 AND user_id % 200 NOT IN (0, 63, 64, 65, 81, 82, 83, 87, 88, 111, 112, 121, 122, 123, 124, 131, 141, 142, 143, 152, 176, 190, 195)
  ELSE (event_id % 10) * 10 = 40 END AS crop FROM events""")
def _(t):
    kind = F.when(F.col("event_type") == "click", "cdl").otherwise("worldcover")
    code = F.when(F.col("event_type") == "click", F.col("user_id") % 200).otherwise(F.col("event_id") % 10 * 10)
    return t.events.select(F.col("event_id").alias("px"), C.cropland_mask(kind, code).alias("crop"))


@query("p20_cropland_source", """SELECT event_id, CASE WHEN us THEN 'cdl' ELSE 'worldcover' END AS kind,
  CASE WHEN us THEN 'CDL' || CAST(GREATEST(y, 2008) AS STRING) WHEN y <= 2020 THEN 'v100-WorldCover' ELSE 'v200-WorldCover' END AS product,
  CAST(CASE WHEN us THEN GREATEST(y, 2008) WHEN y <= 2020 THEN 2020 ELSE 2021 END AS INT) AS product_year
  FROM (SELECT event_id, lon BETWEEN -125 AND -66.5 AND lat BETWEEN 24 AND 50 AS us, CAST(2005 + dur_days AS INT) AS y FROM fx_candidates)""")
def _(t):
    return t.candidates.select(
        "event_id", geo.cropland_source("lon", "lat", F.col("dur_days") + 2005).alias("s")).select("event_id", "s.*")


@query("p21_provenance", """SELECT event_id, CASE WHEN source = 'groundsource' THEN 'Groundsource (news)' ELSE source END AS origin,
  CONCAT('GFM', CASE WHEN n_indep % 2 = 1 THEN ',EMS' ELSE '' END, CASE WHEN n_indep >= 2 THEN ',DFO' ELSE '' END,
    CASE WHEN passed THEN ',IFRC' ELSE '' END) AS confirmed_by,
  CAST(1 + n_indep % 2 + CASE WHEN n_indep >= 2 THEN 1 ELSE 0 END + CASE WHEN passed THEN 1 ELSE 0 END AS INT) AS n_independent,
  tier, area_km2_reported AS km2 FROM fx_floods""")
def _(t):
    p = T.flood_provenance("source", "tier", F.col("n_indep") % 2, F.when(F.col("n_indep") >= 2, "Yes").otherwise("no"),
                           "passed", "area_km2_reported")
    return t.floods.select("event_id", p.alias("p")).select(
        "event_id", "p.origin", F.array_join("p.confirmed_by", ",").alias("confirmed_by"), "p.n_independent", "p.tier",
        F.col("p.gfm_flood_km2").alias("km2"))


_SPELLING = "CASE ev % 5 WHEN 0 THEN ' True ' WHEN 1 THEN '1' WHEN 2 THEN 'YES' WHEN 3 THEN 'no' ELSE NULL END"


@query("p22_text_boolean", f"SELECT event_id, COALESCE(LOWER(TRIM({_SPELLING})) IN ('true', '1', 'yes'), false) AS flag FROM fx_candidates")
def _(t):
    return t.candidates.select("event_id", T.as_bool(F.expr(_SPELLING)).alias("flag"))


@query("p23_identifiers", """SELECT ev, 'DFO' || CAST(ev AS STRING) AS archive_id, 'GS' || SUBSTRING(md5_like, 1, 12) AS news_id,
  'E' || CAST(ev AS STRING) || '_r' || LPAD(CAST(ev % 900 AS STRING), 4, '0') || '_c' || LPAD(CAST(ev % 77 AS STRING), 4, '0') AS chip_id,
  'b' || LPAD(CAST(ev % 40 AS STRING), 2, '0') AS batch, 'MC' || CAST(year AS STRING) AS burn_prefix, CAST(14 AS INT) AS burn_length
  FROM (SELECT ev, md5(CAST(ev AS STRING)) AS md5_like, year FROM fx_floods)""")
def _(t):
    ev = F.col("ev")
    burn = T.burn_event_id("lon", "lat", "year")
    return t.floods.select(
        "ev", T.archive_event_id(ev.cast("double")).alias("archive_id"),
        T.news_event_id(F.md5(ev.cast("string").cast("binary"))).alias("news_id"),
        T.chip_id(F.concat(F.lit("E"), ev.cast("string")), ev % 900, ev % 77).alias("chip_id"),
        T.batch_label(ev % 40).alias("batch"), F.substring(burn, 1, 6).alias("burn_prefix"), F.length(burn).alias("burn_length"))


@query("p24_tiers", """SELECT event_id, 'A' AS tier FROM fx_floods WHERE source = 'groundsource' AND (n_indep % 2 = 1 OR n_indep >= 2)
  UNION ALL SELECT event_id, 'C' FROM fx_floods WHERE source = 'dfo'""")
def _(t):
    return catalog.tiered_union(*news_and_archive(t)).select("event_id", "tier")


def news_and_archive(t):
    f = t.floods.drop("tier", "n_indep").join(t.candidates.select("event_id", "n_indep"), "event_id")
    news = f.filter("source = 'groundsource'").withColumns({
        "match_ems": F.col("n_indep") % 2 == 1, "match_dfo": F.col("n_indep") >= 2, "match_ifrc": F.col("passed")})
    return news, f.filter("source = 'dfo'").drop("n_indep")


@query("p25_schema_normalisation", """SELECT event_id, source, CAST(date_start AS STRING) AS date_start, year, area_km2_reported, n_indep,
  CAST(NULL AS VARCHAR) AS glide, CAST(22 AS INT) AS n_columns FROM fx_floods""")
def _(t):
    n = catalog.normalise(t.floods)
    return n.select("event_id", "source", F.col("date_start").cast("string").alias("date_start"), "year",
                    "area_km2_reported", "n_indep", "glide", F.lit(len(n.columns)).alias("n_columns"))


_DATE_TEXT = ("CASE ev % 4 WHEN 0 THEN CONCAT(CAST(date_start AS STRING), 'T00:00:00Z') WHEN 1 THEN 'unknown' "
              "WHEN 2 THEN '2021-02-30' ELSE CAST(date_start AS STRING) END")
_NUMBER_TEXT = "CASE ev % 3 WHEN 0 THEN CONCAT(CAST(ev AS STRING), ',000') WHEN 1 THEN 'n/a' ELSE CAST(ev AS STRING) END"


@query("p26_lenient_casts", f"""SELECT event_id, CAST(TRY_CAST(SUBSTRING({_DATE_TEXT}, 1, 10) AS DATE) AS STRING) AS day,
  TRY_CAST(REPLACE({_NUMBER_TEXT}, ',', '') AS DOUBLE) AS num FROM fx_floods""")
def _(t):
    return t.floods.select(
        "event_id", T.lenient_date(F.expr(_DATE_TEXT)).cast("string").alias("day"),
        T.lenient_double(F.expr(_NUMBER_TEXT)).alias("num"))


_ODD = ("CASE WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 11 = 0 THEN CAST('Infinity' AS DOUBLE) "
        "WHEN event_id % 13 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END")


@query("p27_finite_or_zero", """SELECT event_id AS px, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0
  THEN 0.0::DOUBLE ELSE value END AS v FROM events""")
def _(t):
    return t.events.select(F.col("event_id").alias("px"), B.finite_or_zero(F.expr(_ODD)).alias("v"))


@query("p29_partial_severity", """SELECT px, CASE WHEN cs < 0.05 THEN 'partial_minor' WHEN cs < 0.15 THEN 'partial_moderate'
  ELSE 'partial_severe' END AS severity FROM fx_bands""")
def _(t):
    return t.bands.select("px", Q.partial_severity("cs").alias("severity"))


_STATUS = ("CASE event_id % 11 WHEN 0 THEN 'ok' WHEN 1 THEN 'cloudy' WHEN 2 THEN 'speckled' WHEN 3 THEN 'partial_minor' "
           "WHEN 4 THEN 'partial_moderate' WHEN 5 THEN 'partial_severe' WHEN 6 THEN 'blank_white' WHEN 7 THEN 'corrupt' "
           "WHEN 8 THEN 'empty' WHEN 9 THEN 'missing' ELSE 'unreadable' END")


@query("p30_usability", """SELECT event_id AS px, CASE WHEN event_id % 11 >= 5 THEN 'unusable' WHEN event_id % 11 = 4 THEN 'compromised'
  ELSE 'usable' END AS usability FROM events""")
def _(t):
    return t.events.select(F.col("event_id").alias("px"), Q.usability(F.expr(_STATUS)).alias("usability"))


@query("p31_cycle_coherence", """SELECT chip_id, cell_id, granule_year, cycle, inc < 32000 AND "max" < 32000 AND "dec" < 32000 AND "min" < 32000
  AND inc < "max" AND "max" < "dec" AND "dec" < "min" AS ok FROM fx_cycles""")
def _(t):
    return t.cycles.select("chip_id", "cell_id", "granule_year", "cycle", G.coherent("inc", "max", "dec", "min").alias("ok"))


@query("p32_stage_in_cycle", """SELECT chip_id, cell_id, granule_year, cycle, CASE WHEN NOT (inc <= day AND "min" >= day) THEN 0
  WHEN day < "max" THEN 1 WHEN day < "dec" THEN 2 ELSE 3 END AS stage FROM fx_cycles""")
def _(t):
    return t.cycles.select(
        "chip_id", "cell_id", "granule_year", "cycle", G.stage_code("inc", "max", "dec", "min", "day").alias("stage"))


@query("p33_coverage_rule", """SELECT event_id, CASE WHEN y > 2024 THEN
  'VNP22Q2 land-surface phenology covers 2013-2024; no data for event year ' || CAST(y AS STRING) END AS note
  FROM (SELECT event_id, year + 26 AS y FROM fx_floods)""")
def _(t):
    return t.floods.select("event_id", G.coverage_note(F.col("year") + 26).alias("note"))


# third flattening f = 1/298.257223563; e' = 2 sqrt(n) / (1 + n); k0 * A of the rectifying radius
_N = "0.0016792203863837047::DOUBLE"
_ECC = "0.0818191908426215::DOUBLE"
_KA = "6364902.1661650655::DOUBLE"
_FORWARD = f"""SELECT *, CASE WHEN lat >= 0 THEN 0 ELSE 10000000 END + {_KA} * (xi
    + a1 * SIN(2 * xi) * COSH(2 * eta) + a2 * SIN(4 * xi) * COSH(4 * eta) + a3 * SIN(6 * xi) * COSH(6 * eta)) AS y,
  500000 + {_KA} * (eta + a1 * COS(2 * xi) * SINH(2 * eta) + a2 * COS(4 * xi) * SINH(4 * eta) + a3 * COS(6 * xi) * SINH(6 * eta)) AS x
  FROM (SELECT *, {_N} / 2 - 2.0::DOUBLE / 3 * {_N} * {_N} + 5.0::DOUBLE / 16 * {_N} * {_N} * {_N} AS a1,
    13.0::DOUBLE / 48 * {_N} * {_N} - 3.0::DOUBLE / 5 * {_N} * {_N} * {_N} AS a2, 61.0::DOUBLE / 240 * {_N} * {_N} * {_N} AS a3,
    ATAN2(tt, COS(dl)) AS xi, ATANH(SIN(dl) / SQRT(1 + tt * tt)) AS eta
  FROM (SELECT *, SINH(ATANH(SIN(RADIANS(lat))) - {_ECC} * ATANH({_ECC} * SIN(RADIANS(lat)))) AS tt,
    RADIANS(lon - ((FLOOR((lon0 + 180) / 6) + 1) * 6 - 183)) AS dl FROM {{source}}))"""


# lon, lat (lo, la) of UTM points (ev, cm, lat, cx, cy) of the CTE pts, as CTE ll
_INVERSE = """inv AS (SELECT *, (cy - CASE WHEN lat >= 0 THEN 0 ELSE 10000000 END) / {ka} AS xi, (cx - 500000) / {ka} AS eta FROM pts),
  base AS (SELECT ev, cm,
    xi - b1 * SIN(2 * xi) * COSH(2 * eta) - b2 * SIN(4 * xi) * COSH(4 * eta) - b3 * SIN(6 * xi) * COSH(6 * eta) AS x0,
    eta - b1 * COS(2 * xi) * SINH(2 * eta) - b2 * COS(4 * xi) * SINH(4 * eta) - b3 * COS(6 * xi) * SINH(6 * eta) AS e0
    FROM (SELECT *, {n} / 2 - 2.0::DOUBLE / 3 * POW({n}, 2) + 37.0::DOUBLE / 96 * POW({n}, 3) AS b1,
      1.0::DOUBLE / 48 * POW({n}, 2) + 1.0::DOUBLE / 15 * POW({n}, 3) AS b2, 17.0::DOUBLE / 480 * POW({n}, 3) AS b3 FROM inv)),
  ll AS (SELECT ev, DEGREES(ATAN2(SINH(e0), COS(x0))) + cm AS lo,
    DEGREES(chi + d1 * SIN(2 * chi) + d2 * SIN(4 * chi) + d3 * SIN(6 * chi)) AS la
    FROM (SELECT *, ASIN(SIN(x0) / COSH(e0)) AS chi, 2 * {n} - 2.0::DOUBLE / 3 * POW({n}, 2) - 2 * POW({n}, 3) AS d1,
      7.0::DOUBLE / 3 * POW({n}, 2) - 8.0::DOUBLE / 5 * POW({n}, 3) AS d2, 56.0::DOUBLE / 15 * POW({n}, 3) AS d3 FROM base))""".replace(
    "{ka}", _KA).replace("{n}", _N)


@query("p34_chip_footprint", """WITH g AS (SELECT ev, lon, lat, lon AS lon0 FROM fx_candidates), f AS (""" + _FORWARD.format(source="g") + """),
  zone AS (SELECT *, CAST(FLOOR((lon0 + 180) / 6) + 1 AS DOUBLE) * 6 - 183 AS cm FROM f),
  corner AS (SELECT ev, cm, lat, UNNEST([x, x + 5120]) AS cx, y AS y0, UNNEST([0, 1]) AS k FROM zone),
  pts AS (SELECT ev, cm, cx, lat, y0 - 5120 * d AS cy FROM corner, (SELECT UNNEST([0, 1]) AS d)),
  """ + _INVERSE + """
  SELECT ev, ROUND(MIN(lo), 5) AS min_lon, ROUND(MIN(la), 5) AS min_lat, ROUND(MAX(lo), 5) AS max_lon, ROUND(MAX(la), 5) AS max_lat
  FROM ll GROUP BY ev""")
def _(t):
    epsg = geo.utm_epsg("lon", "lat")
    p = t.candidates.select("ev", epsg.alias("epsg"), geo.utm_forward("lon", "lat", epsg).alias("p"))
    foot = geo.chip_footprint("p.x", "p.y", F.lit(0), F.lit(0), 512, 10.0, "epsg", digits=None)
    return p.select("ev", foot.alias("f")).select(
        "ev", *[F.round(f"f.{k}", 5).alias(k) for k in ("min_lon", "min_lat", "max_lon", "max_lat")])


@query("p35_event_grid", """WITH g AS (SELECT ev, lon AS lon0, UNNEST([bbox_w, bbox_w, bbox_e, bbox_e]) AS lon,
    UNNEST([bbox_s, bbox_n, bbox_s, bbox_n]) AS la, lat AS mid FROM (SELECT ev, bbox_w, bbox_s, bbox_e, bbox_n,
    (bbox_w + bbox_e) / 2 AS lon, (bbox_s + bbox_n) / 2 AS lat FROM fx_floods)),
  s AS (SELECT ev, lon0, lon, la AS lat, mid FROM g), f AS (""" + _FORWARD.format(source="s").replace(
    "CASE WHEN lat >= 0 THEN 0", "CASE WHEN mid >= 0 THEN 0") + """)
  SELECT ev, CAST(ANY_VALUE(CASE WHEN mid >= 0 THEN 32600 ELSE 32700 END + FLOOR((lon0 + 180) / 6) + 1) AS INT) AS epsg,
  CAST(CEIL(MAX(y) / 80 - 0.000001) - FLOOR(MIN(y) / 80 + 0.000001) AS BIGINT) AS n_rows, CAST(CEIL(MAX(x) / 80 - 0.000001) - FLOOR(MIN(x) / 80 + 0.000001) AS BIGINT) AS n_cols,
  FLOOR(MIN(x) / 80 + 0.000001) * 80 AS x0, CEIL(MAX(y) / 80 - 0.000001) * 80 AS y0 FROM f GROUP BY ev""")
def _(t):
    grid = geo.event_grid("bbox_w", "bbox_s", "bbox_e", "bbox_n", 80.0)
    return t.floods.select("ev", grid.alias("g")).select("ev", "g.*")


@query("p36_pixel_area", "SELECT ev, (10 + n_indep * 10.0::DOUBLE) * (10 + n_indep * 10.0::DOUBLE) / 1000000 AS km2 FROM fx_floods")
def _(t):
    res = 10 + F.col("n_indep") * 10.0
    return t.floods.select("ev", geo.pixel_area_km2(res, -res).alias("km2"))


@query("p37_search_windows", """SELECT event_id, CAST(date_start - 110 AS STRING) AS s2_pre_from, CAST(date_start - 8 AS STRING) AS s2_pre_to,
  CAST(date_end + 10 AS STRING) AS s2_post_from, CAST(date_end + 75 AS STRING) AS s2_post_to,
  CAST(date_start - 65 AS STRING) AS s1_pre_from, CAST(date_start - 5 AS STRING) AS s1_pre_to,
  CAST(date_end + 8 AS STRING) AS s1_post_from, CAST(date_end + 83 AS STRING) AS s1_post_to,
  CAST(date_start - 30 AS STRING) AS pre_from, CAST(date_start AS STRING) AS pre_to,
  CAST(date_end AS STRING) AS post_from, CAST(date_end + 30 AS STRING) AS post_to FROM fx_floods""")
def _(t):
    w = t.floods.select("event_id", D.burn_search_windows("date_start", "date_end").alias("b"),
                        D.flood_search_windows("date_start", "date_end").alias("f"))
    names = [("b", k) for k in ("s2_pre", "s2_post", "s1_pre", "s1_post")] + [("f", "pre"), ("f", "post")]
    return w.select("event_id", *[
        F.col(f"{s}.{k}.{end}").cast("string").alias(f"{k}_{word}") for s, k in names
        for end, word in (("start", "from"), ("end", "to"))])


@query("p38_initial_verdict", """SELECT event_id AS px, CASE WHEN event_id % 3 > 0 AND event_id % 5 > 0 AND value / 100 > 0.5
  THEN 'clean' ELSE 'check' END AS verdict FROM events""")
def _(t):
    from ..operators.quality import initial_verdict
    ok = F.create_map(F.lit("s2_pre"), F.col("event_id") % 3 > 0, F.lit("s2_post"), F.col("event_id") % 5 > 0)
    e = t.events.withColumns({"ok": ok, "observed": F.col("value") / 100})
    return e.select(F.col("event_id").alias("px"), initial_verdict("ok", "observed").alias("verdict"))


@query("p39_tier_rank", """SELECT event_id, CASE WHEN t IN ('A', 'C') THEN 0 WHEN t = 'B' THEN 1 ELSE 2 END AS tier_rank FROM (
  SELECT event_id, CASE n_indep WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS t FROM fx_candidates)""")
def _(t):
    tier = F.when(F.col("n_indep") == 0, "A").when(F.col("n_indep") == 1, "B").when(F.col("n_indep") == 2, "C")
    return t.candidates.select("event_id", T.tier_rank(tier).alias("tier_rank"))


@query("p40_unmask_zero", "SELECT ev, r, c, COALESCE(flood, 0) AS flood FROM fx_cells")
def _(t):
    return t.cells.select("ev", "r", "c", B.unmask_zero("flood").alias("flood"))


@query("p41_presence", """SELECT ev, r, c, COALESCE(flood > 0, false) AS burned, CAST(FLOOR(value) AS BIGINT) % 10 >= 7 AS fire FROM fx_cells""")
def _(t):
    return t.cells.select("ev", "r", "c", B.burn_present("flood").alias("burned"),
                          B.fire_present(F.floor("value") % 10).alias("fire"))


@query("p42_band_stack", """SELECT px, CONCAT_WS(',', CAST(CAST(FLOOR(b3) AS BIGINT) AS STRING), CAST(CAST(FLOOR(b4) AS BIGINT) AS STRING)) AS first_two,
  CAST(12 AS INT) AS n_bands, ROUND(CAST(CAST(CASE WHEN b8a + b4 <> 0 THEN (b8a - b4) / (b8a + b4) END AS FLOAT) AS DOUBLE), 5) AS ndvi FROM fx_bands""")
def _(t):
    columns = {"B2": "b3", "B3": "b4", "B4": "b4", "B5": "b8", "B6": "b8", "B7": "b8", "B8": "b8", "B8A": "b8a",
               "B9": "b8", "B11": "b11", "B12": "b12"}
    s = t.bands.select("px", B.band_stack(columns).alias("s"))
    whole = lambda i: F.floor(F.get("s", F.lit(i))).cast("string")
    return s.select("px", F.concat_ws(",", whole(0), whole(1)).alias("first_two"), F.size("s").alias("n_bands"),
                    F.round(F.get("s", F.lit(11)).cast("double"), 5).alias("ndvi"))


@query("p43_scene_record", """SELECT scene_id, CAST(acq AS STRING) AS date, round_even(CASE WHEN rel_orbit = 0 THEN 0 ELSE clear_frac END, 4) AS clear_frac,
  CASE WHEN dual = 1 THEN pass END AS radar_pass, CASE WHEN dual = 0 THEN
  'no Sentinel-1 IW VV+VH acquisition over this AOI in the pre and/or post window (genuine SAR coverage gap)' END AS note FROM fx_scenes""")
def _(t):
    s = t.scenes.withColumns({
        "clear": F.when(F.col("rel_orbit") != 0, F.col("clear_frac")), "path": F.concat("scene_id", F.lit(".tif")),
        "three": F.lit(3)})
    optical = imagery.optical_record(F.col("acq"), "clear", "three", "path", B.OPTICAL_BANDS)
    radar = imagery.radar_record("dual", F.col("acq"), "path", "pass", "rel_orbit", B.RADAR_BANDS)
    return s.select("scene_id", optical.alias("o"), radar.alias("s"), imagery.radar_note("dual", "three").alias("note")).select(
        "scene_id", "o.date", "o.clear_frac", F.col("s.pass").alias("radar_pass"), "note")


@query("p44_radar_predicate", """SELECT scene_id FROM fx_scenes WHERE mode = 'IW' AND dual = 1 AND pass = 'ASCENDING' AND rel_orbit = 3""")
def _(t):
    return with_polarisations(t.scenes).filter(imagery.radar_usable() & (F.col("pass") == "ASCENDING") & (F.col("rel_orbit") == 3)).select("scene_id")


def with_polarisations(scenes):
    both = F.array(F.lit("VV"), F.lit("VH"))
    return scenes.withColumn("polarisations", F.when(F.col("dual") == 1, both).otherwise(F.array(F.lit("VV"))))
