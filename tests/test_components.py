"""Connected components and edge blobs against a flood fill."""

import random

import pytest
from pyspark.sql import functions as F

from fieldscar.operators import components
from fieldscar.operators.components import connected_components, edge_blobs, merge_labels


def flood_fill(cells, diagonal):
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    left, out = set(cells), {}
    for start in sorted(cells):
        if start not in left:
            continue
        left.discard(start)
        stack, members = [start], []
        while stack:
            r, c = stack.pop()
            members.append((r, c))
            for dr, dc in steps:
                near = (r + dr, c + dc)
                if near in left:
                    left.discard(near)
                    stack.append(near)
        for m in members:
            out[m] = start[0] * (1 << 32) + start[1]
    return out


@pytest.mark.parametrize("seed,diagonal,block,share", [(1, False, 4, 0.6), (2, True, 4, 0.45), (3, False, 64, 0.5), (4, False, 3, 0.9)])
def test_labels_equal_flood_fill(spark, seed, diagonal, block, share):
    rng = random.Random(seed)
    events = {ev: [(r, c) for r in range(13) for c in range(17) if rng.random() < share] for ev in (1, 2)}
    rows = [(ev, r, c) for ev, cells in events.items() for r, c in cells]
    df = spark.createDataFrame(rows, "ev long, r int, c int")
    got = {(x.ev, x.r, x.c): x.label for x in connected_components(df, ["ev"], diagonal, block).collect()}
    want = {(ev, *cell): label for ev, cells in events.items() for cell, label in flood_fill(cells, diagonal).items()}
    assert got == want


def test_long_snake_across_many_blocks(spark):
    cells = []
    for r in range(0, 24):
        cells += [(1, r, c) for c in range(24)] if r % 2 == 0 else [(1, r, 23 if r % 4 == 1 else 0)]
    df = spark.createDataFrame(cells, "ev long, r int, c int")
    labels = {x.label for x in connected_components(df, ["ev"], block=5).collect()}
    assert labels == {0}


def test_edge_blob_ties_take_the_first_component(spark):
    inner = [(1, 2, 2), (1, 2, 3)]
    border = [(1, 5, 0), (1, 6, 0)]
    df = spark.createDataFrame(inner + border, "ev long, r int, c int")
    row = edge_blobs(df, ["ev"], 8, 8, block=4).first()
    assert (row.nodata_px, row.blob_share, row.touches_border) == (4, 0.5, False)


def union_find(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for by, u, v in links:
        a, b = sorted((find((by, u)), find((by, v))))
        parent[b] = a
    return {(x[0], x[1], find(x)[1]) for x in parent if find(x) != x}


def shapes():
    rng = random.Random(9)
    star = [(1, 500, i) for i in range(400)] + [(2, i, 3) for i in range(4, 300)]
    chain = [(3, i, i + 1) for i in range(300)]
    comb = [(4, i, 1000 + rng.randrange(40)) for i in range(200)]
    loose = [(5, rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    return star + chain + comb + loose + star[:20]


@pytest.mark.parametrize("parts", [1, 9])
def test_merged_labels_equal_union_find(spark, parts):
    links = shapes()
    df = spark.createDataFrame(links, "ev long, u long, v long").repartition(parts)
    got = merge_labels(df, ["ev"]).collect()
    assert len(got) == len({(r.ev, r.node) for r in got}) and {tuple(r) for r in got} == union_find(links)
    assert merge_labels(df.filter("u = v"), ["ev"]) is None


def test_hub_is_spread_over_tasks(spark):
    """A label linked with 200,000 others: no join puts its rows into one task once Spark splits skewed partitions."""
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        links = components.cut_lineage(spark.range(1, 200_001, 1, 16).selectExpr("id AS u", "0L AS v"))
        merged = merge_labels(links, [])
        rows = merged.selectExpr("node", "root")
        assert rows.count() == 200_000 and rows.filter("root <> 0").isEmpty()
        roots = components.cut_lineage(spark.createDataFrame([(0, -1), (-5, -6)], "node long, root long"))
        looked = components._looked_up(links, roots, [], "v")
        sizes = looked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("u")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(r["count"] for r in sizes) < 60_000
