"""Image quality queries: P28, G19 to G23 and U1, on 8 x 8 tiles with matching thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.quality import FLAGS, QualitySpec
from ..operators import quality as Q
from ..session import cut_lineage
from .registry import query

SPEC = QualitySpec(height=8, width=8, min_valid_px=10)

MEASURE_SQL = """WITH RECURSIVE px AS (SELECT chip_no, raster, vec_id, i, BOOL_AND(v = 0) FILTER (b < 11) AS hole,
    MAX(v) FILTER (b = 0) AS p0, MAX(v) FILTER (b = 1) AS p1, MAX(v) FILTER (b = 2) AS p2, MAX(v) FILTER (b = 9) AS p9
    FROM fx_pixels GROUP BY ALL),
  m AS (SELECT vec_id, CAST(i AS BIGINT) AS i FROM px WHERE hole),
  reach(vec_id, i, root) AS (SELECT vec_id, i, i FROM m UNION SELECT n.vec_id, n.i, q.root FROM reach q JOIN m n ON n.vec_id = q.vec_id
    AND (n.i IN (q.i - 8, q.i + 8) OR (n.i = q.i + 1 AND n.i % 8 > 0) OR (n.i = q.i - 1 AND q.i % 8 > 0))),
  part AS (SELECT vec_id, label, COUNT(*) AS n, BOOL_OR(i < 8 OR i >= 56 OR i % 8 IN (0, 7)) AS rim FROM
    (SELECT vec_id, i, MIN(root) AS label FROM reach GROUP BY ALL) GROUP BY ALL),
  blob AS (SELECT vec_id, MAX(n) / CAST(SUM(n) AS DOUBLE) AS blob_share, MAX_BY(rim, (n, -label)) AS rim FROM part GROUP BY vec_id),
  core AS (SELECT v.vec_id, STDDEV_POP(v) AS std, STDDEV_POP(v) FILTER (b = 0) AS std_0, STDDEV_POP(v) FILTER (b = 1) AS std_1
    FROM fx_pixels v JOIN px ON px.vec_id = v.vec_id AND px.i = v.i WHERE NOT hole AND b < 11 GROUP BY ALL),
  st AS (SELECT chip_no, raster, vec_id, COUNT(*) FILTER (hole) / 64.0::DOUBLE AS share, COUNT(*) FILTER (NOT hole) AS n_valid,
    COUNT(*) FILTER (p0 = 0) / 64.0::DOUBLE AS z0, COUNT(*) FILTER (p1 = 0) / 64.0::DOUBLE AS z1,
    MEDIAN((p0 + p1 + p2) / 3) FILTER (NOT hole) AS vis,
    COUNT(*) FILTER (NOT hole AND LEAST(p0, p1, p2) > 2000 AND p9 > 800
      AND (GREATEST(p0, p1, p2) - LEAST(p0, p1, p2)) / GREATEST((p0 + p1 + p2) / 3, 1) < 0.25) AS white_px
    FROM px GROUP BY ALL),
  msr AS (SELECT st.*, white_px / CAST(n_valid AS DOUBLE) AS white, blob_share, rim, std, std_0, std_1 FROM st
    LEFT JOIN blob USING (vec_id) LEFT JOIN core USING (vec_id))"""

IMAGES_SQL = MEASURE_SQL + """,
  slot AS (SELECT chip_no, k.raster, k.ord FROM (SELECT DISTINCT chip_no FROM fx_slots), (SELECT UNNEST(['s2_pre', 's2_post', 's1_pre', 's1_post']) AS raster,
    UNNEST([1, 2, 3, 4]) AS ord) k),
  j AS (SELECT slot.chip_no, slot.raster, slot.raster LIKE 's2%' AS opt, x.vec_id IS NULL AS mis, x.short_by = 1 AS bad, x.vec_id, x.clear_frac,
    share, n_valid, z0, z1, vis, white, blob_share, rim, std, std_0, std_1 FROM slot
    LEFT JOIN fx_slots x ON x.chip_no = slot.chip_no AND x.raster = slot.raster LEFT JOIN msr ON msr.vec_id = x.vec_id),
  e AS (SELECT *, NOT mis AND NOT bad AND share >= 0.98 AS emp FROM j),
  k AS (SELECT *, NOT mis AND NOT bad AND NOT emp AND NOT opt AND n_valid >= 10 AND (std_0 < 1 OR std_1 < 1) AS con FROM e),
  s AS (SELECT *, NOT mis AND NOT bad AND NOT emp AND NOT con AS scan FROM k),
  h AS (SELECT *, COALESCE(scan AND share >= CASE WHEN opt THEN 0.005 ELSE 0.02 END, false) AS holes, COALESCE(scan AND opt AND NOT clear_frac >= 0.9, false) AS jud FROM s),
  f AS (SELECT *, COALESCE(holes AND blob_share >= 0.95 AND rim, false) AS is_partial,
    COALESCE((jud AND vis > 10000) OR (scan AND NOT opt AND ABS(z0 - z1) > 0.0001), false) AS is_corrupt,
    COALESCE(jud AND vis <= 10000 AND white >= 0.8, false) AS is_white,
    COALESCE(jud AND vis <= 10000 AND white >= 0.35 AND white < 0.8, false) AS is_cloudy, COALESCE(emp, false) AS is_empty FROM h),
  img AS (SELECT *, COALESCE(scan AND share > 0 AND NOT is_partial, false) AS is_speckle,
    CASE WHEN mis THEN 'missing' WHEN bad OR con THEN 'unreadable' WHEN emp THEN 'empty' WHEN is_corrupt THEN 'corrupt'
      WHEN is_partial THEN CASE WHEN share < 0.05 THEN 'partial_minor' WHEN share < 0.15 THEN 'partial_moderate' ELSE 'partial_severe' END
      WHEN is_white THEN 'blank_white' WHEN scan AND share > 0 THEN 'speckled' WHEN is_cloudy THEN 'cloudy' ELSE 'ok' END AS status FROM f)"""


def statistics(t):
    return Q.image_statistics(t.tiles, SPEC)


def images(t):
    return Q.image_status(Q.image_slots(t.tile_chips), statistics(t), SPEC)


CHIP = "'c' || LPAD(CAST(chip_no AS STRING), 5, '0') AS chip_id"


@query("g19_image_statistics", MEASURE_SQL + f""" SELECT {CHIP}, raster, CAST(n_valid AS INT) AS n_valid, share AS nodata_share, ROUND(std, 4) AS std, ROUND(blob_share, 4) AS blob_share,
  CASE WHEN raster LIKE 's2%' THEN ROUND(COALESCE(vis, 0), 3) END AS vis_median, CASE WHEN raster LIKE 's2%' THEN ROUND(CASE WHEN n_valid = 0 THEN 0 ELSE white END, 4) END AS white_share FROM msr""")
def _(t):
    s = statistics(t).filter("m IS NOT NULL")
    return s.select("chip_id", "raster", "m.n_valid", "m.nodata_share", F.round("m.std", 4).alias("std"),
                    F.round("m.blob_share", 4).alias("blob_share"), F.round("m.vis_median", 3).alias("vis_median"),
                    F.round("m.white_share", 4).alias("white_share"))


@query("p28_image_status", IMAGES_SQL + f""" SELECT {CHIP}, raster, status, round_even(CASE WHEN NOT mis AND NOT bad THEN share END, 6) AS nodata_frac,
  round_even(CASE WHEN holes THEN blob_share END, 4) AS edge_cc, round_even(CASE WHEN scan AND opt THEN white END, 4) AS white_frac,
  CAST(is_partial AS INT) AS is_partial, CAST(is_white AS INT) AS is_white, CAST(is_corrupt AS INT) AS is_corrupt, CAST(is_empty AS INT) AS is_empty,
  CAST(is_speckle AS INT) AS is_speckle, CAST(is_cloudy AS INT) AS is_cloudy,
  CASE WHEN mis THEN '' WHEN bad THEN CASE WHEN opt THEN '11 bands != 12' ELSE '1 bands != 2' END WHEN con THEN 'constant-valued S1'
    WHEN scan AND NOT opt AND ABS(z0 - z1) > 0.0001 THEN PRINTF('band dropout |dz|=%.4f', round_even(ABS(z0 - z1), 4))
    WHEN vec_id % 31 = 8 THEN CASE WHEN opt THEN 'nonfinite=0.0013' ELSE 'nonfinite=0.0078' END ELSE '' END AS note FROM img""")
def _(t):
    return images(t).select("chip_id", "raster", "status", "nodata_frac", "edge_cc", "white_frac", *FLAGS, "note")


ROLLUP_SQL = IMAGES_SQL + f""",
  w AS (SELECT *, status IN ('missing', 'empty', 'unreadable', 'corrupt', 'blank_white', 'partial_severe') AS un FROM img),
  chip AS (SELECT chip_no, {", ".join(f"MAX(status) FILTER (raster = '{k}') AS {k}_status" for k in ('s2_pre', 's2_post', 's1_pre', 's1_post'))},
    BOOL_OR(un) FILTER (opt) AS s2b, BOOL_OR(un) FILTER (NOT opt) AS s1b, BOOL_AND(status IN ('missing', 'empty')) AS dead,
    BOOL_OR(is_partial) AS ip, BOOL_OR(is_cloudy) AS ic, BOOL_OR(is_white) AS iw, BOOL_OR(is_corrupt) AS ix, BOOL_OR(is_empty) AS ie, BOOL_OR(is_speckle) AS isp,
    BOOL_OR(mis) AS im, BOOL_OR(status IN ('speckled', 'partial_minor')) AS slight, COUNT(*) FILTER (NOT un) AS n_usable,
    BOOL_AND(status = 'ok') AS all_ok, STRING_AGG(DISTINCT status, ',' ORDER BY status) FILTER (status <> 'ok') AS defects,
    COUNT(*) FILTER (un OR status IN ('partial_moderate', 'cloudy')) AS n_bad FROM w GROUP BY chip_no),
  roll AS (SELECT *, CASE WHEN dead THEN 'dead' WHEN s2b AND s1b THEN 'both_unusable' WHEN s2b THEN 's2_unusable' WHEN s1b THEN 's1_unusable'
    WHEN ip THEN 'partial_edge' WHEN ic THEN 'cloudy' WHEN slight THEN 'minor' ELSE 'clean' END AS verdict FROM chip)"""


@query("g20_chip_rollup", ROLLUP_SQL + f""" SELECT {CHIP}, s2_pre_status, s2_post_status, s1_pre_status, s1_post_status,
  CASE WHEN s2b THEN 'unusable' ELSE 'usable' END AS s2_usable, CASE WHEN s1b THEN 'unusable' ELSE 'usable' END AS s1_usable,
  CAST(im AS INT) AS is_missing, CAST(ip AS INT) AS is_partial, CAST(iw AS INT) AS is_white, CAST(n_bad AS INT) AS n_bad_rasters, verdict FROM roll""")
def _(t):
    return Q.chip_rollup(images(t)).select(
        "chip_id", "s2_pre_status", "s2_post_status", "s1_pre_status", "s1_post_status", "s2_usable", "s1_usable",
        "is_missing", "is_partial", "is_white", "n_bad_rasters", "verdict")


@query("g21_status_crosstab", IMAGES_SQL + """, c AS (SELECT status, COUNT(*) FILTER (raster = 's2_pre') AS s2_pre, COUNT(*) FILTER (raster = 's2_post') AS s2_post,
  COUNT(*) FILTER (raster = 's1_pre') AS s1_pre, COUNT(*) FILTER (raster = 's1_post') AS s1_post, COUNT(*) AS total FROM img GROUP BY status)
  SELECT * FROM c UNION ALL SELECT 'any defect', CAST(SUM(s2_pre) AS BIGINT), CAST(SUM(s2_post) AS BIGINT), CAST(SUM(s1_pre) AS BIGINT), CAST(SUM(s1_post) AS BIGINT),
  CAST(SUM(total) AS BIGINT) FROM c WHERE status <> 'ok'""")
def _(t):
    return Q.status_crosstab(images(t))


COUNTERS_SQL = ROLLUP_SQL + """, cnt AS (SELECT 'verdict' AS counter, verdict AS name, COUNT(*) AS n FROM roll GROUP BY verdict
  UNION ALL SELECT 'flag', 'is_partial', COUNT(*) FILTER (ip) FROM roll UNION ALL SELECT 'flag', 'is_white', COUNT(*) FILTER (iw) FROM roll
  UNION ALL SELECT 'flag', 'is_corrupt', COUNT(*) FILTER (ix) FROM roll UNION ALL SELECT 'flag', 'is_empty', COUNT(*) FILTER (ie) FROM roll
  UNION ALL SELECT 'flag', 'is_speckle', COUNT(*) FILTER (isp) FROM roll UNION ALL SELECT 'flag', 'is_cloudy', COUNT(*) FILTER (ic) FROM roll
  UNION ALL SELECT 'flag', 'is_missing', COUNT(*) FILTER (im) FROM roll UNION ALL SELECT 'pair', 's2_usable', COUNT(*) FILTER (NOT s2b) FROM roll
  UNION ALL SELECT 'pair', 's1_usable', COUNT(*) FILTER (NOT s1b) FROM roll)"""


@query("g22_quality_counters", COUNTERS_SQL + " SELECT * FROM cnt")
def _(t):
    return Q.quality_counters(Q.chip_rollup(images(t)))


@query("g23_usability_ladder", ROLLUP_SQL + """ SELECT CASE WHEN all_ok THEN 'all_ok' WHEN n_usable = 4 THEN 'minor' ELSE CAST(n_usable AS STRING) || '_usable' END AS rung,
  COUNT(*) AS n FROM roll GROUP BY 1 UNION ALL SELECT 'hard_defects', COUNT(*) FROM img WHERE status IN ('partial_severe', 'blank_white', 'missing', 'corrupt', 'empty')
  UNION ALL SELECT 'soft_defects', COUNT(*) FROM img WHERE status IN ('cloudy', 'partial_moderate', 'speckled', 'partial_minor')""")
def _(t):
    found = cut_lineage(images(t))  # used twice: scan the tiles once
    return Q.usability_ladder(Q.chip_rollup(found), found)


@query("u1_image_quality", ROLLUP_SQL + f""" SELECT {CHIP}, all_ok AS all_rasters_ok, NOT s2b AND NOT s1b AS all_rasters_usable, NOT s2b AS s2_usable, NOT s1b AS s1_usable,
  CAST(n_usable AS INT) AS n_usable_rasters, verdict, COALESCE(defects, '') AS defects, s1_post_status AS s1_post FROM roll""")
def _(t):
    from ..operators.sidecars import patch_block
    found = cut_lineage(images(t))  # used twice: scan the tiles once
    blocks = Q.qc_block(found, Q.chip_rollup(found))
    patched = patch_block(t.tile_chips.select("chip_id"), blocks, "qc")
    return patched.select(
        "chip_id", "qc.all_rasters_ok", "qc.all_rasters_usable", "qc.s2_usable", "qc.s1_usable", "qc.n_usable_rasters",
        "qc.verdict", F.array_join("qc.defects", ",").alias("defects"),
        F.element_at("qc.rasters", "s1_post")["status"].alias("s1_post"))


@query("k8_quality_tables", IMAGES_SQL + f""" SELECT {CHIP}, raster, status FROM img ORDER BY chip_id, CASE raster WHEN 's2_pre' THEN 1
  WHEN 's2_post' THEN 2 WHEN 's1_pre' THEN 3 ELSE 4 END""")
def _(t):
    from ..schemas import QC_IMAGE
    from ..sources.sinks import image_order
    return images(t).select(*QC_IMAGE).orderBy("chip_id", image_order()).select("chip_id", "raster", "status")


@query("k9_quality_statistics", COUNTERS_SQL + " SELECT counter, name, n, ROUND(100.0::DOUBLE * n / (SELECT COUNT(*) FROM roll), 1) AS pct FROM cnt")
def _(t):
    return Q.quality_shares(Q.chip_rollup(images(t)))


@query("x3_tile_kernel", """SELECT 'c' || LPAD(CAST(chip_no AS STRING), 5, '0') AS chip_id, raster, COUNT(*) FILTER (b = 0 AND v = 0) / 64.0::DOUBLE AS zero_0,
  COUNT(*) FILTER (b = 1 AND v = 0) / 64.0::DOUBLE AS zero_1 FROM fx_pixels WHERE raster LIKE 's1%' GROUP BY ALL""")
def _(t):
    return statistics(t).filter("m IS NOT NULL AND raster LIKE 's1%'").select("chip_id", "raster", "m.zero_0", "m.zero_1")
