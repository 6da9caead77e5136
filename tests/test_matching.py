"""Matches on the cell tree against plain loops over all pairs, with hot places and polygons of many edges."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fieldscar.operators import cells, imagery, matching, spatial

DAY = dt.date(2021, 3, 1)
SHAPES = ("event_id string, bbox_w double, bbox_s double, bbox_e double, bbox_n double, "
          "rings array<array<struct<x:double,y:double>>>, date_start date, date_end date, lon double, lat double")


def blob(rng, x, y, size, corners):
    """A star-shaped ring, concave as a rule."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = [(x + size * rng.uniform(0.3, 1) * math.cos(t), y + size * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]
    return [*ring, ring[0]]


def row(i, ring, start, length):
    xs, ys = zip(*ring)
    return (f"e{i}", min(xs), min(ys), max(xs), max(ys), [ring], DAY + dt.timedelta(start), DAY + dt.timedelta(start + length),
            sum(xs) / len(xs), sum(ys) / len(ys))


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            odd = not odd
    return odd


def distance(ring, x, y):
    if inside(ring, x, y):
        return 0.0
    best = math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


def meet(a, b):
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for p in zip(a, a[1:]):
        for q in zip(b, b[1:]):
            if side(*p, q[0]) * side(*p, q[1]) <= 0 and side(*q, p[0]) * side(*q, p[1]) <= 0:
                return True
    return inside(a, *b[0]) or inside(b, *a[0])


def overlap(a, b, pad):
    return a[6] - dt.timedelta(pad) <= b[7] and a[7] + dt.timedelta(pad) >= b[6]


@pytest.mark.parametrize("bound,levels", [(64, 8), (3, 5), (1, 9)])
def test_points_within_reach(spark, bound, levels):
    rng = random.Random(bound)
    events = [row(i, blob(rng, rng.gauss(10, 4), rng.gauss(-3, 4), rng.choice([0.2, 1, 4]), rng.randrange(3, 9)), rng.randrange(200), rng.randrange(40))
              for i in range(120)]
    events += [row(500 + i, blob(rng, 10, -3, 0.5, 5), rng.randrange(200), 3) for i in range(60)]  # a hot place
    points = [(rng.gauss(10, 6), rng.gauss(-3, 6), DAY + dt.timedelta(rng.randrange(250))) for _ in range(80)]
    points += [(10.0, -3.0, DAY + dt.timedelta(rng.randrange(100))) for _ in range(30)]
    points += [(10 + rng.gauss(0, 0.01), -3 + rng.gauss(0, 0.01), DAY) for _ in range(60)] + [(1.0, 1.0, None)]
    got = matching.match_points(spark.createDataFrame(events, SHAPES), spark.createDataFrame(points, "lon double, lat double, date date"),
                                radius_km=60, days=4, bound=bound, levels=levels)
    want = {e[0]: any(d is not None and e[6] - dt.timedelta(4) <= d <= e[7] + dt.timedelta(4) and distance(e[5][0], x, y) <= 60 / 111
                      for x, y, d in points) for e in events}
    assert {r.event_id: r.match_ems for r in got.collect()} == want and 20 < sum(want.values()) < 160


@pytest.mark.parametrize("bound,levels", [(64, 8), (3, 5), (1, 7)])
def test_polygons_that_share_a_point(spark, bound, levels):
    rng = random.Random(bound)
    shape = lambda hot: blob(rng, 10, -3, 0.6, 6) if hot else blob(
        rng, rng.gauss(10, 3), rng.gauss(-3, 3), rng.choice([0.1, 0.5, 3, 9]), rng.randrange(3, 9))
    events = [row(i, shape(i % 3 == 0), rng.randrange(400), rng.randrange(20)) for i in range(150)]
    archive = [row(900 + i, shape(i % 3 == 0), rng.randrange(400), rng.randrange(20)) for i in range(90)]
    archive += [(f"x{i}", *archive[0][1:6], DAY + dt.timedelta(i * 20), DAY + dt.timedelta(i * 20), 0.0, 0.0) for i in range(30)]  # one shape, many dates
    got = matching.match_polygons(spark.createDataFrame(events, SHAPES), spark.createDataFrame(archive, SHAPES), days=3, bound=bound, levels=levels)
    want = {e[0]: any(overlap(a, e, 3) and meet(e[5][0], a[5][0]) for a in archive) for e in events}
    assert {r.event_id: r.match_dfo for r in got.collect()} == want and 20 < sum(want.values()) < 140


def test_country_of_many_edges(spark):
    """100,000 edges: no row of a cell carries more than meet it, and centres are where the plain test says."""
    rng = random.Random(1)
    turns = [2 * math.pi * k / 100_000 for k in range(100_000)]
    ring = [((20 + 3 * math.sin(9 * t)) * math.cos(t) + 5, (20 + 3 * math.cos(7 * t)) * math.sin(t) + 2) for t in turns]
    ring.append(ring[0])
    square = [(-30.0, -30.0), (-10.0, -30.0), (-10.0, -10.0), (-30.0, -10.0), (-30.0, -30.0)]
    countries = spark.createDataFrame([(1, "AAA", [[{"x": x, "y": y} for x, y in ring]]), (2, "BBB", [[{"x": x, "y": y} for x, y in square]])],
                                      "country_id long, iso_a3 string, rings array<array<struct<x:double,y:double>>>")
    found = cells.rasterised(countries, "country_id", 1.0)
    size = found.agg(F.max(F.size("edges")).alias("most"), F.sum(F.size("edges")).alias("all"), F.count_if(F.size("edges") == 0).alias("whole")).first()
    assert size["most"] < 5_000 and size["all"] < 130_000 and size["whole"] > 1_000
    spots = [(i, rng.uniform(-32, 32), rng.uniform(-32, 32)) for i in range(400)]
    got = matching.assign_country(spark.createDataFrame(spots, "event_id long, lon double, lat double"), countries).collect()
    want = {i: "AAA" if inside(ring, x, y) else "BBB" if inside(square, x, y) else None for i, x, y in spots}
    assert {r.event_id: r.iso3 for r in got} == want and {"AAA", "BBB", None} == set(want.values())


def test_scene_picks_by_bounds_equal_plain_loops(spark):
    """Many events under a few shared footprints and many footprints over one event; equal days and ids decide ties."""
    rng = random.Random(6)
    box = lambda x, y, h: (x - h, y - h, x + h, y + h)
    events = [(f"e{i}", *box(rng.uniform(-9, 9), rng.uniform(-9, 9), rng.choice([0.1, 1.5, 6])), DAY + dt.timedelta(rng.randrange(90)),
               DAY + dt.timedelta(90 + rng.randrange(30))) for i in range(60)]
    places = [box(rng.uniform(-9, 9), rng.uniform(-9, 9), rng.choice([1, 3])) for _ in range(12)]
    scenes = [(f"s{i:03d}", *rng.choice(places), DAY + dt.timedelta(rng.randrange(-40, 160)), rng.choice(["A", "D"]), rng.randrange(2), "IW", ["VV", "VH"])
              for i in range(400)]
    bounds = "bbox_w double, bbox_s double, bbox_e double, bbox_n double"
    ev = spark.createDataFrame(events, f"event_id string, {bounds}, date_start date, date_end date")
    sc = spark.createDataFrame(scenes, f"scene_id string, {bounds}, acq date, pass string, rel_orbit int, mode string, polarisations array<string>")
    meets = lambda e, s: e[1] <= s[3] and e[3] >= s[1] and e[2] <= s[4] and e[4] >= s[2]
    met = {e[0]: [s for s in scenes if meets(e, s)] for e in events}
    pairs, counts, nearest = {}, {}, {}
    for e in events:
        before = [s for s in met[e[0]] if e[5] - dt.timedelta(20) <= s[5] < e[5]]
        pre = max(before, key=lambda s: (s[5], s[0]), default=None)
        after = [s for s in met[e[0]] if e[6] <= s[5] < e[6] + dt.timedelta(20) and (pre is None or s[6:8] == pre[6:8])]
        post = min(after, key=lambda s: (s[5], s[0]), default=None)
        pairs[e[0]] = (pre and pre[0], post and post[0])
        within = sorted((s[5], s[0]) for s in met[e[0]] if e[5] <= s[5] <= e[6])
        if within:
            counts[e[0]] = (len(within), within[0][1], within[-1][1])
        near = [(abs((s[5] - e[5]).days), s[5], s[0]) for s in met[e[0]] if e[5] - dt.timedelta(9) <= s[5] < e[5] + dt.timedelta(7)]
        if near:
            nearest[e[0]] = (min(near)[2], len(near))
    got = imagery.radar_pair(ev, sc, tolerance=20, by=imagery.BOUNDS).collect()
    assert {r.event_id: (r.pre_scene, r.post_scene) for r in got} == pairs and len(got) == len(events)
    assert {r.event_id: tuple(r)[1:] for r in imagery.scenes_between(ev, sc).collect()} == counts
    found = imagery.nearest_radar(ev.withColumn("target", F.col("date_start")), sc, 9, 7, by=imagery.BOUNDS).collect()
    assert {r.event_id: (r.scene_id, r.n_scenes) for r in found} == nearest


def rows_shuffled(spark, run) -> int:
    """Rows that the stages of ``run`` write for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def stages(at):
        while True:
            try:
                yield store.lastStageAttempt(at)
            except Exception:  # no such stage
                return
            at += 1
    first = sum(1 for _ in stages(0))
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(stage.shuffleWriteRecords() for stage in stages(first))


def test_pairs_of_boxes_are_not_shuffled(spark):
    """Every event meets every scene, and no two footprints are equal: the rows shuffled stay near the rows given."""
    n, bounds = 300, "bbox_w double, bbox_s double, bbox_e double, bbox_n double"
    box = lambda i: (i / 1000, i / 2000, i / 1000 + 1, i / 2000 + 1)
    ev = spark.createDataFrame([(f"e{i}", *box(i), DAY, DAY + dt.timedelta(9)) for i in range(n)], f"event_id string, {bounds}, date_start date, date_end date")
    sc = spark.createDataFrame([(f"s{i:03d}", *box(i), DAY + dt.timedelta(i % 10), "A", 1, "IW", ["VV", "VH"], 0.5) for i in range(n)],
                               f"scene_id string, {bounds}, acq date, pass string, rel_orbit int, mode string, polarisations array<string>, clear_frac double")
    at = ev.withColumn("target", F.col("date_start"))
    for found in (lambda: imagery.scenes_between(ev, sc), lambda: imagery.radar_pair(ev, sc, by=imagery.BOUNDS),
                  lambda: imagery.nearest_radar(at, sc, 0, 10, by=imagery.BOUNDS), lambda: imagery.clearest_in_window(at, sc, 0, 9, by=imagery.BOUNDS),
                  lambda: matching.event_scenes(ev, sc)):
        assert rows_shuffled(spark, lambda: found().collect()) < 40 * n  # noqa: B023
    assert matching.event_scenes(ev, sc).count() == n * n
    wide = sc.withColumn("bbox_e", F.col("bbox_e") + 60)  # boxes over many cells are not copied to them
    assert rows_shuffled(spark, lambda: matching.event_scenes(ev, wide).collect()) < 12 * n
    assert matching.event_scenes(ev, wide).count() == n * n


def test_boxes_settle_polygons_apart(spark):
    """Many polygons of a cell whose boxes lie apart share nothing; one that holds, crosses or touches the other does."""
    square = lambda x, y, h: [(x, y), (x + h, y), (x + h, y + h), (x, y + h), (x, y)]
    shapes = [row(i, square(0.1 + i % 8 * 0.4, 0.1 + i // 8 * 0.4, 0.1), 0, 5) for i in range(64)]
    asked = [row(100, square(0.25, 0.25, 0.05), 0, 5), row(101, square(0.2, 0.1, 0.05), 0, 5), row(102, square(0.12, 0.12, 0.02), 0, 5),
             row(103, square(0.0, 0.0, 0.15), 0, 5)]
    got = matching.match_polygons(spark.createDataFrame(asked, SHAPES), spark.createDataFrame(shapes, SHAPES)).collect()
    assert {r.event_id: r.match_dfo for r in got} == {"e100": False, "e101": True, "e102": True, "e103": True}


def test_boxes_settle_what_edges_would(spark):
    """Places near, inside and around concave polygons, whose edges are looked at only where the box does not tell."""
    rng = random.Random(11)
    events = [row(i, blob(rng, rng.uniform(-2, 2), rng.uniform(-2, 2), rng.choice([0.1, 0.5, 2.0]), rng.randrange(3, 8)), 0, 0) for i in range(60)]
    bare = ("none", -0.1, -0.1, 0.1, 0.1, [], DAY, DAY, 0.0, 0.0)  # a box without a polygon
    spots = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(40)] + [(0.0, 0.0)]
    shapes = spark.createDataFrame([*events, bare], SHAPES).drop("lon", "lat")
    pairs = shapes.crossJoin(spark.createDataFrame(spots, "lon double, lat double"))
    got = {(r.event_id, r.lon, r.lat): r.near for r in pairs.select(
        "event_id", "lon", "lat", F.coalesce(matching._within(F.col("lon"), F.col("lat"), 1.0), F.lit(False)).alias("near")).collect()}
    want = {(e[0], x, y): distance(e[5][0], x, y) <= 1.0 for e in events for x, y in spots} | {("none", x, y): False for x, y in spots}
    assert got == want and 200 < sum(want.values()) < 2000
    dated = spark.createDataFrame([(x, y, DAY) for x, y in spots], "lon double, lat double, date date")
    hit = {r.event_id: r.match_ems for r in matching.match_points(shapes, dated, radius_km=111.0, days=0).collect()}
    assert hit == {i: any(want[i, x, y] for x, y in spots) for i in hit} and not hit["none"] and len(hit) == 61


def test_events_are_not_copied_to_cells_in_shuffles(spark):
    """Events that ask in many cells and buckets of days are shuffled about once, and so are scenes."""
    rng = random.Random(8)
    n, bounds = 400, "bbox_w double, bbox_s double, bbox_e double, bbox_n double"
    box = lambda x, y, h: (x - h, y - h, x + h, y + h)
    ev = spark.createDataFrame([(f"e{i}", *box(rng.uniform(-150, 150), rng.uniform(-60, 60), 0.7), DAY + dt.timedelta(i), DAY + dt.timedelta(i + 40)) for i in range(n)],
                               f"event_id string, {bounds}, date_start date, date_end date")
    sc = spark.createDataFrame([(f"s{i:03d}", *box(rng.uniform(-150, 150), rng.uniform(-60, 60), 1.9), DAY + dt.timedelta(i), 0.5) for i in range(n)],
                               f"scene_id string, {bounds}, acq date, clear_frac double")
    at = ev.withColumn("target", F.col("date_start"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (lambda: imagery.scenes_between(ev, sc), lambda: imagery.clearest_in_window(at, sc, 0, 39, by=imagery.BOUNDS).select("event_id", "scene_id")):
            assert rows_shuffled(spark, lambda: found().collect()) < 10 * n  # noqa: B023
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("rows", [7, 40])
def test_crowded_regions_are_dealt_to_tasks(spark, rows):
    """Parts of a region, boxes on several grids and a rank of its own: each pair counts once, ties go by the order."""
    rng = random.Random(rows)
    bounds = "bbox_w double, bbox_s double, bbox_e double, bbox_n double"
    box = lambda x, y, h: (x - h, y - h, x + h, y + h)
    asked = [(f"p{i}", *box(rng.gauss(3, 6), rng.gauss(-2, 6), rng.choice([0.2, 2, 9])), DAY + dt.timedelta(lo := rng.randrange(60)), DAY + dt.timedelta(lo + rng.randrange(40)))
             for i in range(70)] + [("none", None, None, None, None, DAY, DAY)]
    held = [(f"q{i % 90:02d}", *box(float(round(rng.gauss(3, 6))), float(round(rng.gauss(-2, 6))), rng.choice([1.0, 1.0, 3.0, 20.0])), DAY + dt.timedelta(rng.randrange(90))) for i in range(150)]
    p, q = spark.createDataFrame(asked, f"id string, {bounds}, low date, high date"), spark.createDataFrame(held, f"name string, {bounds}, acq date")
    late = F.date_diff("p.high", "q.acq")
    got = spatial.picked(p, q, "id", ("acq", "name"), {"first": (None, False), "last": (None, True), "near": (late, False)}, rows=rows).collect()
    want = {}
    for a in asked[:-1]:
        met = [(s[5], s[0]) for s in held if a[1] <= s[3] and a[3] >= s[1] and a[2] <= s[4] and a[4] >= s[2] and a[5] <= s[5] <= a[6]]
        if met:
            want[a[0]] = (len(met), min(met), max(met), min(((a[6] - d).days, d, name) for d, name in met))
    assert {r.id: (r.n, tuple(r.first)[1:], tuple(r.last)[1:], tuple(r.near)) for r in got} == want and len(want) > 40
    assert spatial.picked(p, q.limit(0), "id", ("acq", "name"), {"first": (None, False)}).count() == 0


@pytest.mark.parametrize("box_bound", [8192, 6])
def test_boxes_and_other_polygons_share_a_point(spark, box_bound):
    """Polygons that are their box, round either way, among concave ones and boxes with a hole; a hot place."""
    rng = random.Random(box_bound)

    def square(x, y, h):
        ring = [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h)]
        start, way = rng.randrange(4), rng.choice([1, -1])
        ring = [ring[(start + way * k) % 4] for k in range(4)]
        return [*ring, ring[0]]
    shape = lambda: square(rng.gauss(10, 5), rng.gauss(-3, 5), rng.choice([0.1, 0.5, 2])) if rng.random() < 0.8 else blob(
        rng, rng.gauss(10, 5), rng.gauss(-3, 5), rng.choice([0.5, 3]), rng.randrange(3, 9))
    hot = lambda: square(10 + rng.gauss(0, 0.5), -3 + rng.gauss(0, 0.5), 0.02)
    events = [row(i, hot() if i % 3 == 0 else shape(), rng.randrange(200), rng.randrange(20)) for i in range(120)]
    boxes = [row(900 + i, hot() if i % 3 == 0 else square(rng.gauss(10, 5), rng.gauss(-3, 5), 0.5), rng.randrange(200), rng.randrange(20)) for i in range(90)]
    others = [row(2000 + i, shape(), rng.randrange(200), 5) for i in range(30)]
    for archive in (boxes, boxes + others):
        want = {e[0]: any(overlap(a, e, 3) and meet(e[5][0], a[5][0]) for a in archive) for e in events}
        got = matching.match_polygons(spark.createDataFrame(events, SHAPES), spark.createDataFrame(archive, SHAPES), days=3, box_bound=box_bound)
        assert {r.event_id: r.match_dfo for r in got.collect()} == want and 10 < sum(want.values()) < 110
    ring, hole = square(0.0, 0.0, 3.0), square(0.0, 0.0, 2.0)
    flags = spark.createDataFrame([("a", -3.0, -3.0, 3.0, 3.0, [ring]), ("b", -3.0, -3.0, 3.0, 3.0, [ring, hole]), ("c", -3.0, -3.0, 3.0, 4.0, [ring]),
                                   ("d", -3.0, -3.0, 3.0, 3.0, [[ring[0], ring[2], ring[1], ring[3], ring[0]]]), ("e", None, None, None, None, None)],
                                  "id string, bbox_w double, bbox_s double, bbox_e double, bbox_n double, rings array<array<struct<x:double,y:double>>>")
    assert {r.id for r in flags.filter(spatial.is_box()).collect()} == {"a"}


def test_boxes_need_no_edges(spark, monkeypatch):
    """Where all polygons are their boxes, none is cut to cells or looked at by its edges."""
    square = lambda x, y, h: [(x, y), (x + h, y), (x + h, y + h), (x, y + h), (x, y)]
    events = spark.createDataFrame([row(i, square(float(i), 0.0, 1.0), 0, 5) for i in range(9)], SHAPES)
    archive = spark.createDataFrame([row(i, square(2.0 * i, 1.0, 0.5), 0, 5) for i in range(2)], SHAPES)
    monkeypatch.setattr(matching, "_cut_to_cells", None)
    got = matching.match_polygons(events, archive).collect()
    assert {r.event_id for r in got if r.match_dfo} == {"e0", "e1", "e2"} and len(got) == 9


def test_corroboration_of_boxes_needs_no_edges(spark, monkeypatch):
    """All three flags and their number, with polygons that are their boxes and are not cut to cells."""
    square = lambda x, y, h: [(x, y), (x + h, y), (x + h, y + h), (x, y + h), (x, y)]
    news = spark.createDataFrame([row(i, square(6.0 * i, 0.0, 1.0), 0, 5) for i in range(4)], SHAPES)
    archive = spark.createDataFrame([row(9, square(0.5, 0.5, 3.0), 18, 2), row(8, square(6.5, 0.5, 1.0), 40, 2)], SHAPES)
    places = spark.createDataFrame([(0.2, 0.2, DAY), (18.5, 2.0, DAY)], "lon double, lat double, date date")
    land = [{"x": x, "y": y} for x, y in square(-1.0, -1.0, 9.0)]
    countries = spark.createDataFrame([(1, "AAA", [land])], "country_id long, iso_a3 string, rings array<array<struct<x:double,y:double>>>")
    relief = spark.createDataFrame([("BBB;AAA", DAY)], "iso3 string, date date")
    monkeypatch.setattr(matching, "_cut_to_cells", None)
    got = matching.corroborate(news, places, archive, relief, countries).collect()
    assert {r.event_id: (r.match_ems, r.match_dfo, r.match_ifrc, r.n_indep) for r in got} == {
        "e0": (True, True, True, 3), "e1": (False, False, True, 1), "e2": (False, False, False, 0), "e3": (True, False, False, 1)}
