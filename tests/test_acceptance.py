"""Order-dependent acceptance, near-duplicates, ranks and sampling against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldscar.operators import catalog, fire, matching
from fieldscar.operators.ranking import ranked


def close(new, old, km=25.0, days=30):
    dy = (new[1] - old[1]) * 111.0
    dx = (new[0] - old[0]) * 111.0 * math.cos(math.radians(new[1]))
    return abs(new[2] - old[2]) <= days and math.hypot(dx, dy) <= km


def accept_loop(rows, cap, total, before):
    points, count, kept = list(before), {}, []
    for seq, lon, lat, day, cell in rows:
        if len(kept) >= total or count.get(cell, 0) >= cap:
            continue
        if any(close((lon, lat, day), p) for p in points):
            continue
        points.append((lon, lat, day))
        count[cell] = count.get(cell, 0) + 1
        kept.append(seq)
    return kept


def draw(rng, n, spread):
    lat0 = rng.choice([0.0, -35.0, 62.0])
    return [(i, rng.uniform(0, spread), lat0 + rng.uniform(-spread / 2, spread / 2), rng.randrange(0, 120), rng.randrange(3))
            for i in range(n)]


@pytest.mark.parametrize("seed,n,spread,cap,total,old", [
    (1, 60, 1.0, 3, 99, 0), (2, 120, 3.0, 8, 12, 2), (3, 200, 0.2, 5, 99, 0), (4, 150, 6.0, 2, 99, 3)])
def test_acceptance_equals_the_loop(spark, seed, n, spread, cap, total, old):
    rng = random.Random(seed)
    rows = draw(rng, n, spread)
    before = [(x[1], x[2], x[3]) for x in draw(rng, old, spread)]
    df = spark.createDataFrame(rows, "seq long, lon double, lat double, day int, cell int")
    done = spark.createDataFrame(before, "lon double, lat double, day int") if before else None
    got = sorted(r.seq for r in fire.accept_events(df, ["cell"], cap, total, done).collect())
    assert got == accept_loop(rows, cap, total, before)


@pytest.mark.parametrize("seed,spread", [(5, 0.5), (6, 4.0)])
def test_seen_before_equals_the_loop(spark, seed, spread):
    rows = [x[:4] for x in draw(random.Random(seed), 150, spread)]
    df = spark.createDataFrame(rows, "seq long, lon double, lat double, day int")
    got = {r.seq: r.seen for r in matching.seen_before(df).collect()}
    want = {r[0]: any(close(r[1:], q[1:]) for q in rows if q[0] < r[0]) for r in rows}
    assert got == want


def test_one_hot_place_keeps_one_event_and_its_neighbours(spark):
    """A third of the rows at one spot: one is accepted there, the others elsewhere survive."""
    rows = [(i, 10.0, 20.0, 5, 0) for i in range(2000)] + [(2000 + i, float(i), -40.0, 5, 1 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, lon double, lat double, day int, cell int")
    got = sorted(r.seq for r in fire.accept_events(df, ["cell"]).collect())
    assert got == [0] + [2000 + i for i in range(50)]


def test_ranked_is_a_row_number_per_group(spark):
    rng = random.Random(7)
    rows = [(rng.choice("aab"), rng.randrange(50), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, v int, id long")
    got = {r.id: r.rank for r in ranked(df, ["k"], ["v", "id"]).collect()}
    want = {}
    for k in "ab":
        for n, (_, _, i) in enumerate(sorted((x for x in rows if x[0] == k), key=lambda x: (x[1], x[2])), 1):
            want[i] = n
    assert got == want


def turns(sequence, queues):
    """Check that ``sequence`` (queue names) deals the queues in turn: the k-th visit of a queue comes after the
    k-1 st of every queue that has so many members, in name order inside a turn."""
    seen, keys = {}, []
    for name in sequence:
        seen[name] = seen.get(name, 0) + 1
        keys.append((seen[name], name))
    assert seen == queues and keys == sorted(keys)


def check_visits(order, rows):
    """Continents are dealt in turn, inside one the years, inside a year by agreement, area and id."""
    by_id = {r[0]: r for r in rows}
    assert sorted(order) == sorted(by_id)
    continents = [by_id[e][1] for e in order]
    turns(continents, {c: continents.count(c) for c in set(continents)})
    for continent in set(continents):
        mine = [by_id[e] for e in order if by_id[e][1] == continent]
        years = [r[2] for r in mine]
        turns(years, {y: years.count(y) for y in set(years)})
        for year in set(years):
            rank = [(-r[3], -r[4], r[0]) for r in mine if r[2] == year]
            assert rank == sorted(rank)


def test_visit_order_and_quota(spark):
    rng = random.Random(8)
    rows = [(f"e{i:03d}", rng.choice(["A", "A", "A", "B", "C"]), rng.choice([2020, 2021, 2022]), rng.randrange(3),
             float(rng.randrange(100)), "A") for i in range(160)]
    df = spark.createDataFrame(rows, "event_id string, continent string, year int, n_indep int, area_km2_reported double, tier string")
    ordered = catalog.visit_order(df, lambda *c: F.lit(0))
    got = [r.event_id for r in ordered.orderBy("visit").collect()]
    check_visits(got, rows)
    answers = [(e, int(e[1:]) % 3 == 0, "pass" if int(e[1:]) % 3 == 0 else "no_flood") for e in got if int(e[1:]) % 7]
    screened = spark.createDataFrame(answers, "event_id string, passed boolean, outcome string")
    kept, log = catalog.sample_and_screen(ordered, screened, 10)
    passing = [e for e, ok, _ in answers if ok][:10]
    assert [r.event_id for r in kept.orderBy("visit").collect()] == passing
    assert log.count() == got.index(passing[-1]) + 1
    assert {r.outcome for r in log.collect()} <= {"pass", "no_flood", "error"}
    everything, full_log = catalog.sample_and_screen(ordered, screened, 10_000)
    assert full_log.count() == 160 and everything.count() == sum(ok for _, ok, _ in answers)


@pytest.mark.parametrize("quota,rate", [(10, 3), (25, 1), (10, 40), (10_000, 3), (0, 3)])
def test_screen_is_asked_for_what_the_quota_needs(spark, quota, rate):
    """Same rows as screening everything; at most twice the visits that the quota needs are screened."""
    rows = [(f"e{i:04d}", "A", 2020, i + 1) for i in range(1500)]
    ordered = spark.createDataFrame(rows, "event_id string, continent string, year int, visit long").repartition(5)
    asked = []

    def screen(part):
        ids = [r.event_id for r in part.collect()]
        asked.extend(ids)
        answers = [(e, int(e[1:]) % rate == 0, "pass" if int(e[1:]) % rate == 0 else "no_flood") for e in ids if int(e[1:]) % 7]
        return spark.createDataFrame(answers, "event_id string, passed boolean, outcome string")

    kept, log = catalog.screen_until(ordered, screen, quota)
    passing = [e for e, *_ in rows if int(e[1:]) % 7 and int(e[1:]) % rate == 0][:quota]
    needed = len(rows) if len(passing) < quota else int(passing[-1][1:]) + 1 if passing else 0
    assert [r.event_id for r in kept.orderBy("visit").collect()] == passing
    assert sorted(r.event_id for r in log.collect()) == [e for e, *_ in rows[:needed]]
    assert len(asked) == len(set(asked)) <= max(2 * needed, quota)
    empty_kept, empty_log = catalog.screen_until(ordered.filter("false"), screen, 5)
    assert empty_kept.count() == empty_log.count() == 0


def test_shard_names_grow_and_stay_unique(spark):
    df = spark.range(20_000).select(F.col("id").alias("pos"))
    got = {r.pos: r.shard for r in catalog.shard(df, 1).collect()}
    assert len(set(got.values())) == 20_000 and None not in got.values()
    assert [got[i] for i in (0, 25, 26, 675, 676, 677, 676 + 17575, 676 + 17576)] == [
        "shard_aa", "shard_az", "shard_ba", "shard_zz", "shard_aaa", "shard_aab", "shard_zzz", "shard_aaaa"]


def test_seeded_order_is_reproducible(spark):
    rows = [(f"e{i}", "AB"[i % 2], 2020 + i % 3, 0, 1.0, "A") for i in range(30)]
    df = spark.createDataFrame(rows, "event_id string, continent string, year int, n_indep int, area_km2_reported double, tier string")
    runs = [[r.event_id for r in catalog.visit_order(df, catalog.seeded(42)).orderBy("visit").collect()] for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 30


def test_shard_signs_are_those_of_the_sql(spark):
    """Beyond 676 shards the first sign goes on by code point, also beyond one byte."""
    numbers = [0, 25, 26, 675, 676, 2249, 3743, 4134, 22499, 134999]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    got = {r.n: r.name for r in df.select("n", catalog.shard_signs(F.col("n")).alias("name")).collect()}
    assert got == {n: chr(97 + n // 26) + chr(97 + n % 26) for n in numbers}


def test_heads_have_few_copies(spark):
    """Far-apart rows, each the head of its block: a head was copied to 75 blocks and is copied to eight cells now, more near the poles."""
    rng = random.Random(8)
    rows = [(i, rng.uniform(-180, 180), rng.uniform(-60, 60), rng.randrange(20_000)) for i in range(500)]
    df = spark.createDataFrame(rows, "seq long, lon double, lat double, day int")
    assert matching.near_nodes(df).count() <= 16 * 500
    near = matching.near_nodes(df, 100.0).select("seq", "node")
    own = matching.with_node(df, 100.0).select("seq", "node")
    assert near.join(own, ["seq", "node"]).count() == 500 and near.count() <= 16 * 500


def test_most_heads_are_settled_in_their_own_cell(spark):
    """Crowded rows: every head was copied to the cells around, now only those without an earlier head in their cell; no fresh one is lost."""
    rng = random.Random(9)
    rows = [(i, rng.uniform(0, 4), rng.uniform(-2, 2), rng.randrange(240)) for i in range(4000)] + [(4000, None, 1.0, 3)]
    df = spark.createDataFrame(rows, "seq long, lon double, lat double, day int")
    heads = matching.block_heads(matching.with_block(df)).select("seq", "lon", "lat", "day")
    known = {r.seq: tuple(r)[1:] for r in heads.collect()}
    left = {r.seq for r in matching.unsettled_heads(heads).collect()}
    fresh = {i for i, at in known.items() if at[0] is None or not any(close(at, q[1:]) for q in rows[:i])}
    assert fresh <= left <= set(known) and 4 * len(left) < len(known)
    seen = {r.seq: r.seen for r in matching.seen_before(df).collect()}
    assert {i for i, s in seen.items() if not s} == fresh
