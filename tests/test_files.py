"""File sources, sinks and cycle state on small written tables."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fieldscar import schemas
from fieldscar.functions.geo import rect_ring
from fieldscar.operators import raster, release
from fieldscar.sources import catalogues as S, sinks as K
from fieldscar.streaming import cycles, publish as P


def flood_rows(spark):
    return spark.createDataFrame([
        ("GS1", "groundsource", dt.date(2021, 5, 1), dt.date(2021, 5, 3), 1.0, 2.0, 3.0, 4.0, "yes", None),
        ("DFO2", "dfo", dt.date(2022, 6, 1), dt.date(2022, 6, 9), 5.0, 6.0, 7.0, 8.0, None, 12.25)],
        "event_id string, source string, date_start date, date_end date, bbox_w double, bbox_s double, bbox_e double, "
        "bbox_n double, match_ems string, gfm_flood_km2 double")


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    K.write_manifest(flood_rows(spark), path)
    back = {r.event_id: r for r in S.read_manifest(spark, path).collect()}
    assert back["GS1"].match_ems is True and back["DFO2"].match_ems is None
    assert back["DFO2"].gfm_flood_km2 == 12.25 and back["GS1"].year == 2021 and back["GS1"].bbox == [1.0, 2.0, 3.0, 4.0]
    assert set(schemas.FLOOD_MANIFEST) <= set(S.read_manifest(spark, path).columns)


def test_features_are_closed_boxes(spark, tmp_path):
    path = str(tmp_path / "f")
    K.write_features(flood_rows(spark), path, ["event_id", "gfm_flood_km2"])
    docs = {d["properties"]["event_id"]: d for d in (json.loads(r.value) for r in spark.read.text(path).collect())}
    ring = docs["GS1"]["geometry"]["coordinates"][0]
    assert ring[0] == ring[-1] == [1.0, 2.0] and len(ring) == 5
    assert docs["GS1"]["properties"]["gfm_flood_km2"] is None


def test_catalogue_files(spark, tmp_path):
    (tmp_path / "ems.json").write_text(json.dumps([
        {"code": "A", "eventTime": "2021-05-02T00:00:00", "centroid": "POINT (1.5 2.5)", "countries": ["X", "Y"]},
        {"code": "B", "eventTime": "?", "centroid": "POINT (3 4)"}, {"code": "C", "centroid": "LINE"}]))
    got = {r.code: r for r in S.activations(S.read_activations(spark, str(tmp_path / "ems.json"))).collect()}
    assert set(got) == {"A", "B"} and got["A"].countries == "X;Y" and got["A"].lon == 1.5 and got["B"].date is None
    (tmp_path / "ifrc.json").write_text(json.dumps([
        {"id": 1, "disaster_start_date": "2021-01-05T00:00:00Z", "countries": [{"iso3": "AAA"}, {"iso3": ""}, {"iso3": "BBB"}], "name": "n"}]))
    relief = S.relief_events(S.read_relief(spark, str(tmp_path / "ifrc.json"))).first()
    assert relief.iso3 == "AAA;BBB" and relief.date == dt.date(2021, 1, 5)


def test_news_and_archive_scans(spark, tmp_path):
    base = spark.range(1).select(F.array(rect_ring(F.lit(1.0), F.lit(2.0), F.lit(3.0), F.lit(4.0))).alias("rings"))
    news = base.select(F.lit("abcdef0123456789").alias("uuid"), F.explode(F.array(*map(F.lit, (9.9, 10.0, 2000.0, 2000.1)))).alias("area_km2"),
                       F.lit("2021-03-04").alias("start_date"), F.lit("2021-03-09").alias("end_date"), "rings")
    news.write.parquet(str(tmp_path / "news"))
    got = S.news_floods(S.read_news(spark, str(tmp_path / "news"))).collect()
    assert sorted(r.area_km2_reported for r in got) == [10.0, 2000.0]
    assert got[0].event_id == "GSabcdef012345" and got[0].continent == "Africa"
    archive = base.select(F.lit(7.0).alias("ReportNumber"), F.lit("2021-03-04").alias("BeginDate"), F.lit("bad").alias("EndDate"),
                          F.explode(F.array(F.lit("1.4"), F.lit("1.5"))).alias("Severity"), F.lit("P").alias("Country"), F.lit("m").alias("MainCause"),
                          F.lit("").alias("GlideNumber"), F.lit("1,234").alias("Area"), F.lit(None).cast("string").alias("SubdivisionName"), "rings")
    archive.write.parquet(str(tmp_path / "archive"))
    row, = S.archive_floods(S.read_archive(spark, str(tmp_path / "archive"))).collect()
    assert (row.event_id, row.area_km2_reported, row.notes, row.glide) == ("DFO7", 1234.0, "DFO Severity 1.5", None)
    assert row.date_end == row.date_start


DOCUMENT = "event_id string, chip_id string, n int, phenology struct<stage:string>"


def test_sidecars_survive_the_round_trip(spark, tmp_path):
    rows = [(f"e{i % 7}", f"c{i}", i, None if i % 3 else ("late",)) for i in range(60)]
    K.write_sidecars(spark.createDataFrame(rows, DOCUMENT), str(tmp_path / "s"), folders=2)
    assert len(list((tmp_path / "s").glob("part=*"))) == 2
    good, bad = S.read_sidecars(spark, str(tmp_path / "s"), DOCUMENT)
    back = sorted((r.event_id, r.chip_id, r.n, r.phenology and tuple(r.phenology)) for r in good.collect())
    assert back == sorted(rows) and bad.count() == 0
    line = json.loads(spark.read.text(str(tmp_path / "s")).filter("value like '%\"c1\"%'").first().value)
    assert line == {"event_id": "e1", "chip_id": "c1", "n": 1, "phenology": None}


def test_unreadable_sidecars_are_counted(spark, tmp_path):
    texts = {"a": '{"chip_id": "a", "n": 1}', "b": "{broken", "c": '{"chip_id": "c"}\n{"chip_id": "d"}', "d": '{\n"chip_id": "e"\n}'}
    for name, text in texts.items():
        (tmp_path / "ev").mkdir(exist_ok=True)
        (tmp_path / "ev" / f"{name}.json").write_text(text)
    good, bad = S.read_sidecars(spark, str(tmp_path), "chip_id string, n int", whole_files=True)
    assert sorted(r.chip_id for r in good.collect()) == ["a", "e"] and bad.count() == 2
    (tmp_path / "ev" / "d.json").unlink()
    good, bad = S.read_sidecars(spark, str(tmp_path), "chip_id string, n int")
    assert sorted(r.chip_id for r in good.collect()) == ["a", "c", "d"] and bad.count() == 1


def test_news_years_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("u", 50.0, f"{y}-05-01", f"{y}-05-02", [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]) for y in (2019, 2020, 2026, 2027)],
                          S.NEWS_SCHEMA).write.parquet(str(tmp_path / "n"))
    df = S.news_floods(S.read_news(spark, str(tmp_path / "n")))
    assert sorted(r.year for r in df.collect()) == [2020, 2026]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = S.news_floods(S.read_news(spark, str(tmp_path / "n")))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(start_date,2020)" in plan and "LessThan(start_date,2027)" in plan


def test_ledger_grows_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ids = spark.createDataFrame([("b",), ("a",), ("a",)], "event_id string")
    assert P.publish_ids(ids, path, "01") == 2
    assert P.publish_ids(ids, path, "01") == 2  # repeated
    assert P.publish_ids(ids.unionByName(spark.createDataFrame([("c",)], "event_id string")), path, "02") == 1
    assert sorted(r.event_id for r in P.published(spark, path, "ledger").collect()) == ["a", "b", "c"]


def test_batches_are_left_as_they_are(spark, tmp_path):
    path = str(tmp_path / "batches")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "event_id string, batch int")
    second = spark.createDataFrame([("c", 1), ("d", 2)], "event_id string, batch int")
    for events, run in ((first, "1"), (first, "1"), (second, "2"), (second, "2"), (first, "3")):
        P.publish_batches(events, path, run)
    assert sorted((r.event_id, r.batch) for r in P.published(spark, path, "batches").collect()) == [("a", 1), ("b", 1), ("d", 2)]


def test_a_failed_run_is_not_seen_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "run")
    good, more = (spark.createDataFrame([(i,)], "event_id string") for i in "ab")
    broken = good.select(F.raise_error(F.lit("lost")).cast("string").alias("event_id"))
    try:
        P.publish({"manifest": good, "ledger": broken}, path, "x")
        raise AssertionError("the run must fail")
    except Exception as e:
        assert "lost" in str(e)
    assert P.published(spark, path, "manifest") is None and not P.is_published(spark, path, "x")
    assert P.publish({"manifest": more, "ledger": good}, path, "x") and not P.publish({"manifest": good, "ledger": good}, path, "x")
    assert [r.event_id for r in P.published(spark, path, "manifest").collect()] == ["b"]


def test_cycles_are_published_whole(spark, tmp_path):
    path, ids = str(tmp_path / "cycle"), lambda *x: spark.createDataFrame([(i,) for i in x], "event_id string")
    log = spark.createDataFrame([("a", "flood"), ("b", "no_flood"), ("c", "error")], "event_id string, outcome string")
    chips = ids("a", "a")
    for run in ("1", "1", "2"):
        P.publish_cycle(ids("a", "b", "c"), log, ids("a"), chips, path, run)
    read = lambda name: sorted(tuple(r)[:-1] for r in P.published(spark, path, name).collect())
    assert read("manifest") == [("a",)] and read("ledger") == [("b",)] and read("done") == [("a", 2)]


def test_quality_tables_are_read_back_in_order(spark, tmp_path):
    path, images = str(tmp_path / "qc"), []
    kind = lambda c: "string" if c in ("chip_id", "event_id", "raster", "status", "defects", "note") else "double"
    for chip in ("c2", "c1"):
        for raster_ in reversed(K.IMAGES):
            images.append(tuple({"chip_id": chip, "raster": raster_}.get(c, "x" if kind(c) == "string" else 0.5) for c in schemas.QC_IMAGE))
    chips = [tuple("c2" if c == "chip_id" else "x" if kind(c) == "string" else None for c in schemas.QC_CHIP),
             tuple("c1" if c == "chip_id" else "x" if kind(c) == "string" else 1.0 for c in schemas.QC_CHIP)]
    frame = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"`{c}` {kind(c)}" for c in names))
    K.write_quality(frame(images, schemas.QC_IMAGE).withColumn("more", F.lit(1)), frame(chips, schemas.QC_CHIP), path)
    rows = spark.read.option("header", True).csv(f"{path}/images").collect()
    assert list(rows[0].asDict()) == list(schemas.QC_IMAGE)
    assert [(r.chip_id, r.raster) for r in rows] == [(c, k) for c in ("c1", "c2") for k in K.IMAGES]
    back = spark.read.option("header", True).csv(f"{path}/chips").collect()
    assert list(back[0].asDict()) == list(schemas.QC_CHIP) and [r.chip_id for r in back] == ["c1", "c2"]
    assert all(v is None for c, v in back[1].asDict().items() if kind(c) == "double")


def test_other_sinks_write(spark, tmp_path):
    series = raster.flood_series(spark.createDataFrame([(1, dt.date(2022, 8, 1), 1), (1, dt.date(2022, 8, 1), None)],
                                                       "ev int, day date, extent int"), ["ev"], 0.0004)
    K.write_series(series, str(tmp_path / "series"))
    row = spark.read.option("header", True).csv(str(tmp_path / "series")).first()
    assert (row.overpass_day, row.flood_px, row.valid_px) == ("20220801", "1", "1")
    cells = spark.createDataFrame([(1, 0, 0, 4, None, 0, 0, None)], "ev int, r int, c int, label int, damage int, exclusion int, crop int, severity int")
    K.write_labels(cells, str(tmp_path / "labels"))
    got = spark.read.parquet(str(tmp_path / "labels")).first()
    assert (got.damage, got.severity) == (255, 255)
    (tmp_path / "x.csv").write_text("chip_id,event_id,hazard,reason\nc1,e1,Flooded,\"missing_required:s2_pre,s2_post\"\n")
    chips = spark.createDataFrame([("c1",), ("c2",)], "chip_id string")
    assert [r.chip_id for r in release.released_chips(chips, S.read_exclusions(spark, str(tmp_path / "x.csv"))).collect()] == ["c2"]


def test_cycle_is_idempotent(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "event_id string")
    log = spark.createDataFrame([("c", "no_flood"), ("d", "transient"), ("b", "pass")], "event_id string, outcome string")
    still, manifest, ledger = cycles.append_cycle(ids("a", "b", "c", "d"), ids("a"), ids("z"), log, ids("b"))
    names = lambda df: sorted(r.event_id for r in df.collect())
    assert names(still) == ["b", "c", "d"] and names(manifest) == ["a", "b"] and names(ledger) == ["c", "z"]
    again, manifest2, ledger2 = cycles.append_cycle(ids("a", "b", "c", "d"), manifest, ledger, log, ids("b"))
    assert names(again) == ["d"] and names(manifest2) == names(manifest) and names(ledger2) == names(ledger)


def test_run_report_equals_a_recount(spark, tmp_path):
    rows = [(f"e{i}", "timeout" if i % 7 == 0 else None, i % 5 == 1, i % 4, i % 3, ("Asia", "Europe", None)[i % 3], 2020 + i % 2) for i in range(60)]
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x)
    outcomes = spark.createDataFrame(rows, "event_id string, error string, skipped boolean, n_scenes int, n_chips int, continent string, year int")
    path = str(tmp_path / "run")
    report = K.write_run(outcomes.repartition(4).withColumn("event_id", count("event_id")), path, "sample", {"n": 3}, ["Asia", "Europe", "Africa"], [2020, 2022])
    assert seen.value == len(rows)  # computed once
    assert report["counters"] == release.run_counters(outcomes).first().asDict()
    assert (report["n_events"], report["n_failures"]) == (60 - 9, 9)
    assert report["by_continent"] == {"Asia": 20, "Europe": 20, "Africa": 0} and report["by_year"] == {"2020": 30, "2022": 0}
    assert json.loads(spark.read.text(f"{path}/report").first().value) == report
    back = spark.read.json(f"{path}/records")
    assert {(r.event_id, r.kind) for r in back.collect()} == {(r[0], "failures" if r[1] else "events") for r in rows}
    empty = K.write_run(outcomes.filter("false"), str(tmp_path / "none"), "sample")
    assert empty["n_events"] == 0 and set(empty["counters"].values()) == {0}


def test_chip_lists_imagery_and_report(spark, tmp_path):
    chips = spark.createDataFrame([("c1", "e1", None), ("c2", "e1", "x")], "chip_id string, event_id string, note string")
    K.write_chip_lists(chips, str(tmp_path / "j"), str(tmp_path / "c"))
    assert sorted(json.loads(r.value)["chip_id"] for r in spark.read.text(str(tmp_path / "j")).collect()) == ["c1", "c2"]
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert back.columns == list(schemas.CHIP_LIST) and back.count() == 2
    assert S.read_chips(spark, str(tmp_path / "j"), "chip_id string, event_id string, note string", "e1", 1).first().chip_id == "c1"
    scenes = spark.createDataFrame([("c1", "2021-01-01", "2021-01-02", "s1_pre", ("p",)), ("c1", "2021-01-01", "2021-01-02", "s2_pre", None)],
                                   "chip_id string, flood_start string, flood_end string, raster string, scene struct<path:string>")
    K.write_imagery(scenes, str(tmp_path / "i"))
    line, = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "i")).collect()]
    assert line["chip_id"] == "c1" and line["imagery"]["s1_pre"] == {"path": "p"} and line["flood_end"] == "2021-01-02"
    counters = spark.createDataFrame([(3, 1)], "events_processed long, failures long")
    counts = spark.createDataFrame([("Asia", None, 2), (None, 2021, 2)], "continent string, year int, n long")
    failures = spark.createDataFrame([("e9", "timeout")], "event_id string, error string")
    K.write_report({"counters": K.report_rows(counters, counts), "failures": failures}, str(tmp_path / "r"))
    rows = {(r.section, r.name): r.n for r in spark.read.json(str(tmp_path / "r" / "counters")).collect()}
    assert rows == {("counters", "events_processed"): 3, ("counters", "failures"): 1, ("by_continent", "Asia"): 2, ("by_year", "2021"): 2}
    assert spark.read.json(str(tmp_path / "r" / "failures")).first().error == "timeout"


def test_release_and_cells_round_trip(spark, tmp_path):
    master = spark.createDataFrame([("e1", 2), ("e2", 0)], "event_id string, n_chips int")
    chips = spark.createDataFrame([("c1", "e1"), ("c2", "e1")], "chip_id string, event_id string")
    K.write_release(master, chips, str(tmp_path / "rel"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "rel" / "events_master")).collect())) == [("e1", 2), ("e2", 0)]
    back = spark.read.parquet(str(tmp_path / "rel" / "chips"))
    assert sorted((r.chip_id, r.event_id) for r in back.collect()) == [("c1", "e1"), ("c2", "e1")]
    spark.createDataFrame([(1, dt.date(2022, 8, d)) for d in (1, 2, 3)], "ev int, day date").write.parquet(str(tmp_path / "cells"))
    assert S.read_cells(spark, str(tmp_path / "cells"), "2022-08-02", "2022-08-03").count() == 1


def test_release_summary_counts_an_event_once_in_every_total(spark):
    """Events of several hazards and regions, and rows without one; no set of events is kept beside the rows."""
    rng = random.Random(12)
    rows = [(rng.choice([None, *[f"e{i}" for i in range(40)]]), rng.choice([None, "Flooded", "Burnt"]), rng.choice([None, "Asia", "Europe", "Other"]),
             rng.random() < 0.7, rng.random() < 0.4, rng.choice([None, "stage 1"])) for _ in range(300)]
    rows.append((None, "Unknown", "Nowhere", True, True, None))  # chips of no event
    df = spark.createDataFrame(rows, "event_id string, hazard string, continent string, has_s1 boolean, usable boolean, stage string")
    got = sorted((tuple(r) for r in release.summary(df).collect()), key=repr)

    def line(hazard, continent, part):
        n, events = len(part), len({r[0] for r in part} - {None})
        share = lambda k: round(100.0 * k / n, 1)
        return (hazard, continent, events, n, round(n / events, 1) if events else None,
                share(sum(r[3] for r in part)), share(sum(r[4] for r in part)), share(sum(r[5] is not None for r in part)))

    want = [line(None, None, rows)]
    want += [line(h, None, [r for r in rows if r[1] == h]) for h in {r[1] for r in rows}]
    want += [line(None, c, [r for r in rows if r[2] == c]) for c in {r[2] for r in rows}]
    want += [line(h, c, [r for r in rows if r[1:3] == (h, c)]) for h, c in {r[1:3] for r in rows}]
    assert [(r[:4], [v for v in r[4:]]) for r in got] == [(r[:4], [v if v is None else pytest.approx(v, abs=0.11) for v in r[4:]]) for r in sorted(want, key=repr)]
    assert "distinct" not in release.summary(df)._jdf.queryExecution().executedPlan().toString()
