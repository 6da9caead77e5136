"""Boundaries of every threshold and the published facts."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fieldscar.functions import classes as C, dates as D, geo, growth as G, quality as Q, spectral as B, text as T
from fieldscar.operators import growth, labels, quality


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("lon,lat,want", [
    (-80, 20, "NorthAmerica"), (-60, 8, "CentralAmericaCaribbean"), (-60, -10, "SouthAmerica"), (10, 36, "Europe"),
    (20, 0, "Africa"), (55, 30, "MiddleEast"), (100, 19, "EastAsia"), (141, -11, "SoutheastAsia"), (145, -30, "Oceania"),
    (-170, 12, "NorthAmerica"), (0, -80, "Other")])
def test_continent_order_and_bounds(spark, lon, lat, want):
    assert value(spark, geo.continent_of(lit(float(lon)), lit(float(lat)))) == want


@pytest.mark.parametrize("lon,lat,want", [(10.97, 45.0, 32632), (75.38, 20.0, 32643), (11.0, -0.1, 32732), (11.0, 0.0, 32632)])
def test_utm_zone(spark, lon, lat, want):
    assert value(spark, geo.utm_epsg(lit(lon), lit(lat))) == want


def test_utm_of_a_surveyed_tower(spark):
    p = value(spark, geo.utm_forward(lit(-79.387139), lit(43.642566), lit(32617)))
    assert math.isclose(p.x, 630084, abs_tol=1) and math.isclose(p.y, 4833438, abs_tol=1)


@pytest.mark.parametrize("lon,lat", [(10.97, 45.1), (-71.2, -33.4), (179.9, 60.0), (3.0, 0.0)])
def test_utm_round_trip(spark, lon, lat):
    epsg = geo.utm_epsg(lit(lon), lit(lat))
    p = geo.utm_forward(lit(lon), lit(lat), epsg)
    back = value(spark, geo.utm_inverse(p["x"], p["y"], epsg))
    assert math.isclose(back.lon, lon, abs_tol=1e-8) and math.isclose(back.lat, lat, abs_tol=1e-8)


@pytest.mark.parametrize("v,want", [(99.9, 0), (100.0, 1), (270.0, 2), (440.0, 3), (659.9, 3), (660.0, 4), (None, 0)])
def test_severity_bounds(spark, v, want):
    assert value(spark, B.burn_severity(lit(v).cast("double"))) == want


@pytest.mark.parametrize("v,want", [(-600.0, 0), (-500.0, 0), (0.0, 62), (1532.0, 254), (9000.0, 254)])
def test_dnbr_byte(spark, v, want):
    assert value(spark, C.dnbr_byte(lit(v), lit(True))) == want
    assert value(spark, C.dnbr_byte(lit(v), lit(False))) == 255


@pytest.mark.parametrize("extent,crop,exc,want", [
    (1, True, 0, 1), (0, True, 0, 2), (1, True, 1, 3), (None, True, 1, 255), (None, False, 0, 4), (1, False, 1, 4), (1, True, None, 1)])
def test_flood_class_precedence(spark, extent, crop, exc, want):
    assert value(spark, C.flood_class(lit(extent).cast("int"), lit(crop), lit(exc).cast("int"))) == want


@pytest.mark.parametrize("sev,crop,obs,per,want", [
    (2, True, True, True, 1), (2, True, True, False, 2), (0, True, True, True, 2), (2, True, False, True, 3), (4, False, True, True, 4)])
def test_burn_class(spark, sev, crop, obs, per, want):
    assert value(spark, C.burn_class(lit(sev), lit(crop), lit(obs), lit(per))) == want


@pytest.mark.parametrize("share,want", [(0.0499, "partial_minor"), (0.05, "partial_moderate"), (0.15, "partial_severe")])
def test_partial_severity(spark, share, want):
    assert value(spark, Q.partial_severity(lit(share))) == want


@pytest.mark.parametrize("text,want", [(" TRUE ", True), ("1", True), ("Yes", True), ("0", False), ("", False), (None, False)])
def test_text_booleans(spark, text, want):
    assert value(spark, T.as_bool(lit(text).cast("string"))) is want


def test_ids(spark):
    assert value(spark, T.chip_id(lit("GS1"), lit(512), lit(1024))) == "GS1_r0512_c1024"
    burn = value(spark, T.burn_event_id(lit(10.1234), lit(5.0), lit(2021)))
    assert burn.startswith("MC2021") and len(burn) == 14
    assert burn == value(spark, T.burn_event_id(lit(10.1230), lit(5.0), lit(2021)))


def test_day_numbers(spark):
    assert value(spark, D.days_since_2000(lit(dt.date(2000, 3, 1)))) == 60
    assert value(spark, D.date_from_2000(lit(0.5))) == dt.date(2000, 1, 1)
    assert value(spark, D.date_from_2000(lit(1.5))) == dt.date(2000, 1, 3)
    assert value(spark, D.day_of_year_date(lit(2020), lit(366))) == dt.date(2020, 12, 31)
    december = value(spark, D.month_window(lit(2021), lit(12)))
    assert (december.start, december.end) == (dt.date(2021, 12, 1), dt.date(2022, 1, 1))


PUBLISHED = [
    ("2022-09-17", ("2022-07-12", "2022-08-25", "2022-09-30", "2022-12-03"), 1, "peak/maturity", "event-year cycle 1"),
    ("2020-10-14", ("2020-07-21", "2020-08-18", "2020-10-06", "2020-11-14"), 2, "senescence", "event-year cycle 2"),
]


@pytest.mark.parametrize("day,dates,cycle,stage,name", PUBLISHED)
def test_published_growth_stages(spark, day, dates, cycle, stage, name):
    k = lambda s: (dt.date.fromisoformat(s) - dt.date(2000, 1, 1)).days
    year = int(day[:4])
    rows = [("c", 1, year, cycle, *map(k, dates), 1.0, year, k(day)), ("c", 1, year - 1, 1, 32767, 1, 2, 3, 1.0, year, k(day))]
    schema = "chip_id string, cell_id long, granule_year int, cycle int, inc int, max int, dec int, min int, weight double, year int, day int"
    scored = growth.score_cycles(spark.createDataFrame(rows, schema))
    got = growth.chip_stages(scored).first()
    assert (got.stage, got.growth_cycle, got.stage_agreement, got.n_valid_pixels) == (stage, name, 1.0, 1)
    assert str(got.transitions.dormancy_onset) == dates[3]


@pytest.mark.parametrize("day,want", [(9, 0), (10, 1), (19, 1), (20, 2), (30, 3), (40, 3), (41, 0)])
def test_stage_ends_are_inclusive(spark, day, want):
    assert value(spark, G.stage_code(lit(10), lit(20), lit(30), lit(40), lit(day))) == want


@pytest.mark.parametrize("dates,want", [((1, 2, 3, 4), True), ((1, 2, 2, 4), False), ((1, 2, 3, 32000), False), ((1, 2, 3, None), False)])
def test_coherence(spark, dates, want):
    assert value(spark, G.coherent(*[lit(d).cast("int") for d in dates])) is want


def test_published_stage_shares(spark):
    rows = [("c", i, s, 11, w) for i, (s, w) in enumerate([(0, 58.0), (1, 138.0), (2, 610.0), (3, 194.0)])]
    cells = spark.createDataFrame(rows, "chip_id string, cell_id long, stage int, code int, weight double")
    top = growth.dominant(growth.weighted_counts(cells, "stage"), "stage", "stage").first()
    assert top.stage == 2


@pytest.mark.parametrize("year,burn,note", [(2025, True, "no data for event year 2025"), (2020, True, "no fill-free")])
def test_growth_notes(spark, year, burn, note):
    chips = spark.createDataFrame([("a", dt.date(year, 5, 1))], "chip_id string, event_date date")
    scored = growth.score_cycles(spark.createDataFrame(
        [], "chip_id string, cell_id long, granule_year int, cycle int, inc int, max int, dec int, min int, weight double, year int, day int"))
    row = growth.attach_growth(chips, growth.chip_stages(scored), burn).first()
    assert row.phenology is None and note in row.phenology_note


def test_published_shares(spark):
    cells = spark.range(512 * 512).select(
        F.lit(1).alias("ev"), F.floor(F.col("id") / 512).cast("int").alias("r"), (F.col("id") % 512).cast("int").alias("c"),
        F.when(F.col("id") < 93323, 1).otherwise(2).alias("label"), F.lit(50).alias("persistence"))
    row = labels.publish_shares(labels.tile_statistics(cells, "ev")).first()
    assert (row.flooded_crop_frac, row.flooded_crop_px, row.cropland_frac) == (0.3560, 93323, 1.0)
    burn = cells.select(F.lit("c").alias("chip_id"), F.when(F.col("r") * 512 + F.col("c") < 225045, 1).otherwise(2).alias("label"),
                        F.lit(1).alias("crop"), F.lit(True).alias("observed"), F.lit(2).alias("severity"))
    assert labels.burn_chip_statistics(burn).first().burned_crop_frac == 0.8585


def test_archive_provenance(spark):
    p = value(spark, T.flood_provenance(lit("dfo"), lit("C"), lit(None), lit(None), lit(None), lit("12.5")))
    assert (p.confirmed_by, p.n_independent, p.tier, p.gfm_flood_km2) == (["GFM"], 1, "C", 12.5)


VERDICTS = [
    (("ok", "ok", "ok", "ok"), "clean"), (("missing", "empty", "missing", "empty"), "dead"),
    (("missing", "ok", "unreadable", "ok"), "both_unusable"), (("blank_white", "ok", "ok", "ok"), "s2_unusable"),
    (("ok", "ok", "partial_severe", "ok"), "s1_unusable"), (("partial_minor", "cloudy", "ok", "ok"), "partial_edge"),
    (("cloudy", "speckled", "ok", "ok"), "cloudy"), (("ok", "ok", "speckled", "ok"), "minor")]


@pytest.mark.parametrize("statuses,want", VERDICTS)
def test_verdict_precedence(spark, statuses, want):
    rows = [("c", "e", "X", 2020, k, s, int(s.startswith("partial")), 0, int(s == "corrupt"), int(s == "empty"),
             int(s == "speckled"), int(s == "cloudy"), 0.0, None, "") for k, s in zip(Q.IMAGES, statuses)]
    images = spark.createDataFrame(rows, "chip_id string, event_id string, continent string, year int, raster string, status string, "
                                   "is_partial int, is_white int, is_corrupt int, is_empty int, is_speckle int, is_cloudy int, "
                                   "nodata_frac double, white_frac double, note string")
    chip = quality.chip_rollup(images)
    assert chip.first().verdict == want
    block = quality.qc_block(images, chip).first().qc
    assert block.n_usable_rasters == sum(s not in Q.UNUSABLE for s in statuses)
    assert block.defects == sorted({s for s in statuses if s != "ok"})


def tile(bands, fill):
    return [[float(fill(b, i)) for i in range(64)] for b in range(bands)]


TILES = [
    ("ok", "s2_pre", tile(12, lambda b, i: 500 + b + i), 0.5),
    ("blank_white", "s2_pre", tile(12, lambda b, i: 3000 + b), 0.5), ("ok", "s2_pre", tile(12, lambda b, i: 3000 + b), 0.9),
    ("corrupt", "s2_pre", tile(12, lambda b, i: 12000 + b), 0.5), ("ok", "s2_pre", tile(12, lambda b, i: 12000 + b), 0.95),
    ("cloudy", "s2_pre", tile(12, lambda b, i: 3000 + b if i < 30 else 400), 0.5),
    ("empty", "s2_pre", tile(12, lambda b, i: 0), None),
    ("partial_minor", "s2_pre", tile(12, lambda b, i: 0 if i < 3 else 500 + i), None),
    ("partial_severe", "s2_pre", tile(12, lambda b, i: 0 if i < 16 else 500 + i), None),
    ("speckled", "s2_pre", tile(12, lambda b, i: 0 if i in (9, 27, 45) else 500 + i), None),
    ("unreadable", "s2_pre", tile(11, lambda b, i: 5), None),
    ("unreadable", "s1_pre", tile(2, lambda b, i: -7), None),
    ("corrupt", "s1_pre", tile(2, lambda b, i: 0 if (b, i) == (1, 5) else -7 - i), None),
    ("ok", "s1_pre", tile(2, lambda b, i: -7 - i), None), ("missing", "s1_pre", None, None)]


def test_image_cascade(spark):
    spec = Q.QualitySpec(height=8, width=8, min_valid_px=10)
    rows = [(f"c{i:02d}", r, 8, 8, len(v), v, None) for i, (_, r, v, _) in enumerate(TILES) if v is not None]
    tiles = spark.createDataFrame(rows, "chip_id string, raster string, h int, w int, n_bands int, values array<array<float>>, read_error string")
    slots = spark.createDataFrame([(f"c{i:02d}", r, cf) for i, (_, r, _, cf) in enumerate(TILES)],
                                  "chip_id string, raster string, clear_frac double")
    got = quality.image_status(slots, quality.image_statistics(tiles, spec), spec).orderBy("chip_id").collect()
    assert [r.status for r in got] == [t[0] for t in TILES]
    assert got[2].is_white == 0 and got[4].is_corrupt == 0  # a clear scene vetoes both
