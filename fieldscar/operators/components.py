"""Connected components of cell masks, block by block and then across block borders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import Scratch, cut_lineage

_ROW = 1 << 32


def _label_block(rows: np.ndarray, cols: np.ndarray, diagonal: bool) -> np.ndarray:
    """Smallest row-major key of each cell's component inside one block."""
    key = rows.astype(np.int64) * _ROW + cols
    order = np.argsort(key)
    sorted_key = key[order]
    steps = [1, _ROW] + ([_ROW + 1, _ROW - 1] if diagonal else [])
    links = []
    for step in steps:
        at = np.searchsorted(sorted_key, sorted_key + step)
        at[at == len(sorted_key)] = 0
        hit = np.flatnonzero(sorted_key[at] == sorted_key + step)
        links.append((hit, at[hit]))
    a = np.concatenate([x for x, _ in links])
    b = np.concatenate([y for _, y in links])
    parent = np.arange(len(sorted_key))
    while True:
        low = np.minimum(parent[a], parent[b])
        grown = parent.copy()
        np.minimum.at(grown, parent[a], low)
        np.minimum.at(grown, parent[b], low)
        grown = grown[grown]
        if np.array_equal(grown, parent):
            break
        parent = grown
    out = np.empty_like(key)
    out[order] = sorted_key[parent]
    return out


def connected_components(cells: DataFrame, by: list[str], diagonal: bool = False, block: int = 256) -> DataFrame:
    """Add ``label``: the smallest row-major key (r * 2^32 + c) of the cell's component.

    ``cells``: by..., integer r, c; only the cells of the mask. Blocks of ``block`` x ``block``
    cells are labelled inside one task each, so a huge raster is spread over many tasks; only
    the labels that meet at block borders go through the distributed merge.
    """
    home = cells.select(*by, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")).select(
        "*", F.floor(F.col("r") / block).alias("_br"), F.floor(F.col("c") / block).alias("_bc"))
    schema = StructType([*home.schema.fields, StructField("_local", LongType())])

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(_local=_label_block(pdf["r"].to_numpy(), pdf["c"].to_numpy(), diagonal))

    local = cut_lineage(home.groupBy(*by, "_br", "_bc").applyInPandas(label, schema))
    merged = merge_labels(_border_links(local, by, diagonal, block), by)
    named = local.select(*by, "r", "c", "_local")
    if merged is None:
        return named.withColumnRenamed("_local", "label")
    return cut_lineage(
        named.join(merged.select(*by, F.col("node").alias("_local"), "root"), [*by, "_local"], "left")
        .withColumn("label", F.coalesce("root", "_local")).drop("_local", "root")
    )


def _border_links(local: DataFrame, by: list[str], diagonal: bool, block: int) -> DataFrame:
    """Distinct pairs of local labels that touch across a block border (u > v)."""
    r_in, c_in = F.pmod("r", F.lit(block)), F.pmod("c", F.lit(block))
    rim = local.filter((r_in == 0) | (r_in == block - 1) | (c_in == 0) | (c_in == block - 1))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else [])
    shifted = rim.select(*by, F.col("_local").alias("u"), "_br", "_bc", F.explode(F.array(*[
        F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c")) for dr, dc in steps])).alias("n"))
    shifted = shifted.select(*by, "u", F.col("n.r").alias("r"), F.col("n.c").alias("c"),
                             F.col("_br").alias("_br2"), F.col("_bc").alias("_bc2"))
    pairs = shifted.join(rim.withColumnRenamed("_local", "v"), [*by, "r", "c"]).filter(
        (F.col("_br") != F.col("_br2")) | (F.col("_bc") != F.col("_bc2")))
    return pairs.filter("u <> v").select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def merge_labels(links: DataFrame, by: list[str]) -> DataFrame | None:
    """``node`` and ``root``, the smallest label of its component, of every label that is linked with a smaller one.
    None when nothing is linked.

    In every round each label hooks to its first neighbour in some order, if that comes before itself, paths are
    shortened by doubling, and the links are drawn again between the roots. The first order is that of the labels,
    which settles stars at once; later ones are random, so that at most half of the linked labels are expected to
    stay roots, and the rounds are logarithmic. A label with very many links is no hot key: its first neighbour is a
    minimum that tasks take before the shuffle, and where links or labels look up a root they are the plain
    side of a join with one row per label, which Spark can split.
    """
    with Scratch(links.sparkSession) as scratch:
        links = scratch.stored(links.filter("u <> v"))
        if links.isEmpty():
            return None
        named, turn = None, 0
        while True:
            roots = _shortened(scratch.stored(_hooks(links, by, turn)), by, scratch)
            named = roots if named is None else scratch.stored(_looked_up(named, roots, by, "root").unionByName(roots))
            drawn = _looked_up(_looked_up(links, roots, by, "u"), roots, by, "v").filter("u <> v")
            links = scratch.stored(drawn.select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
            if links.isEmpty():
                return cut_lineage(_by_smallest(named, by, scratch) if turn else named)
            turn += 1


def _hooks(links: DataFrame, by: list[str], turn: int) -> DataFrame:
    """(node, root): the first neighbour, in the order of this turn, of every label that has one before itself."""
    u, v = (F.struct((F.xxhash64(x, F.lit(turn)) if turn else F.lit(0).cast("long")).alias("place"), F.col(x).alias("label"))
            for x in ("u", "v"))
    ends = links.select(*by, F.greatest(u, v)["label"].alias("node"), F.least(u, v).alias("first"))
    return ends.groupBy(*by, "node").agg(F.min("first").alias("first")).select(*by, "node", F.col("first.label").alias("root"))


def _by_smallest(named: DataFrame, by: list[str], scratch: Scratch) -> DataFrame:
    """``named`` (node, root) with the smallest label of every component as its root."""
    least = named.groupBy(*by, "root").agg(F.min("node").alias("_least"))
    least = scratch.stored(least.select(*by, "root", F.least("root", "_least").alias("_least")))
    renamed = named.join(least, [*by, "root"]).select(*by, "node", F.col("_least").alias("root"))
    return renamed.unionByName(least.select(*by, F.col("root").alias("node"), F.col("_least").alias("root"))).filter("node <> root")


def _looked_up(rows: DataFrame, roots: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with the labels in column ``name`` replaced by their roots, if they have one."""
    to = roots.select(*by, F.col("node").alias(name), F.col("root").alias("_to"))
    return rows.join(to, [*by, name], "left").withColumn(name, F.coalesce("_to", name)).select(*rows.columns)


def _shortened(hooks: DataFrame, by: list[str], scratch: Scratch) -> DataFrame:
    """``hooks`` (node, root) with every root that hooks itself followed to the end."""
    while True:
        ahead = hooks.select(*by, F.col("node").alias("root"), F.col("root").alias("ahead"))
        hooks = scratch.stored(hooks.join(ahead, [*by, "root"], "left").select(
            *by, "node", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        if hooks.filter("moved").isEmpty():
            return hooks.select(*by, "node", "root")
        hooks = hooks.select(*by, "node", "root")


def edge_blobs(cells: DataFrame, by: list[str], height, width, block: int = 256) -> DataFrame:
    """Per mask: cell count, share of the largest 4-neighbour component, and whether that
    component touches the border. The smallest label wins a tie in size."""
    labelled = connected_components(cells, by, diagonal=False, block=block)
    height, width = F.lit(height), F.lit(width)
    rim = (F.col("r") == 0) | (F.col("r") == height - 1) | (F.col("c") == 0) | (F.col("c") == width - 1)
    parts = labelled.groupBy(*by, "label").agg(F.count("*").alias("n"), F.bool_or(rim).alias("rim"))
    best = F.max_by(F.struct("n", "rim"), F.struct(F.col("n"), -F.col("label")))
    return parts.groupBy(*by).agg(F.sum("n").alias("nodata_px"), best.alias("best")).select(
        *by, "nodata_px", (F.col("best.n") / F.col("nodata_px")).alias("blob_share"),
        F.col("best.rim").alias("touches_border"))
