"""Exact Jaccard join of word n-gram sets with prefix filters under several token orders.

Two sets whose Jaccard similarity is at least t share a token among the first n - ceil(t n) + 1 of each
under any global order of tokens, and at least l among the first n - ceil(t n) + l. First order: by hash, over
all documents, with l a twentieth of the set; documents that lack enough shared tokens are out, the others
form families of documents linked by shared tokens. Second order: by rarity inside a family; third: by another
hash. Pairs that pass all are compared exactly. Families are cut to blocks, a task compares two of them and
returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..operators.components import merge_labels
from ..session import cut_lineage
from .common import Scratch, arrow_map, broadcast_if, register, table, worker_cache
from .shingles import mix, shingle_sets

SHINGLE_WORDS, PERCENT = 4, 85
BLOCK = 256
BROADCAST_ROWS = 2_000_000
COLUMNS_AT_A_TIME = 4096


def needed(n, percent: int):
    """Tokens of a set of n that a partner must share at least: ceil(percent n / 100)."""
    return -(-n * percent // 100)


def extra(n):
    """Shared tokens asked for in the first order: a twentieth of the set, rounded up."""
    return -(-n // 20)


def token_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row: row, doc_id, n, set_id (128 bits of the set; null for an empty one), prefix in the first order."""
    def rows(batch):
        worker_cache("sets", None)
        out = {"row": batch.column(0), "doc_id": batch.column(1), "n": [], "set_id": [], "prefix": []}
        for s in shingle_sets(batch.column(2), k):
            n = len(s)
            out["n"].append(n)
            out["set_id"].append(set_id(s))
            out["prefix"].append(s[:n - needed(n, percent) + extra(n)].view(np.int64))  # ascending hashes
        yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                     f"row bigint, doc_id {kind}, n bigint, set_id binary, prefix array<bigint>", rows)


def set_id(s: np.ndarray) -> bytes | None:
    if not len(s):
        return None
    with np.errstate(over="ignore"):
        sums = [mix(s + np.uint64(seed)).sum(dtype=np.uint64) for seed in (1, 2)]
    return np.array(sums).tobytes()


def _stars(tokens: DataFrame, by: list[str]) -> DataFrame:
    """Links (u > v) of every set to the smallest one that has a token of its own."""
    heads = tokens.groupBy(*by).agg(F.min("c").alias("v"), F.max("c").alias("top")).filter("top > v").drop("top")
    return tokens.join(heads, by).filter("c > v").select(F.col("c").alias("u"), "v").distinct()


def _families(links: DataFrame) -> DataFrame | None:
    """(c, family) of all linked sets; None if there are no links."""
    merged = merge_labels(links, [])
    if merged is None:
        return None
    below = merged.select(F.col("node").alias("c"), F.col("root").alias("family"))
    return cut_lineage(below.unionByName(merged.select(F.col("root").alias("c"), F.col("root").alias("family"))).distinct())


def _prefixes(tokens: list[np.ndarray], rank: np.ndarray, percent: int) -> list[np.ndarray]:
    """First tokens of each set by ``rank``."""
    keep = [len(t) - needed(len(t), percent) + 1 for t in tokens]
    return [t[np.argsort(rank[t], kind="stable")[:p]] for t, p in zip(tokens, keep)]


def _overlaps(tokens: list[np.ndarray], kinds: int) -> np.ndarray:
    """Sizes of all intersections of the given lists, by blocks of columns of the incidence matrix."""
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    flat = np.concatenate(tokens) if tokens else np.empty(0, dtype=np.int64)
    held = np.bincount(flat, minlength=kinds) > 1
    column = np.cumsum(held) - 1
    owner, flat = owner[held[flat]], column[flat[held[flat]]]
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    total = np.zeros((len(tokens), len(tokens)), dtype=np.float32)
    for lo in range(0, int(held.sum()), COLUMNS_AT_A_TIME):
        a, b = np.searchsorted(flat, [lo, lo + COLUMNS_AT_A_TIME])
        part = np.zeros((len(tokens), COLUMNS_AT_A_TIME), dtype=np.float32)
        part[owner[a:b], flat[a:b] - lo] = 1
        total += part @ part.T
    return total


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest (member, smaller member) of the links between distinct ``sets``."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    kinds, local = np.unique(flat, return_inverse=True)
    tokens = np.split(local, np.cumsum(sizes)[:-1])
    rarity = np.bincount(local).astype(np.int64) * len(kinds) + np.arange(len(kinds))
    with np.errstate(over="ignore"):
        other = mix(kinds.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    likely = np.minimum.outer(sizes, sizes) * 100 >= percent * np.maximum.outer(sizes, sizes)
    for rank in (rarity, other):
        likely &= _overlaps(_prefixes(tokens, rank, percent), len(kinds)) > 0
    np.fill_diagonal(likely, False)
    some = np.flatnonzero(likely.any(axis=1))
    if not len(some):
        return []
    shared = np.rint(_overlaps([tokens[i] for i in some], len(kinds))).astype(np.int64)
    union = np.add.outer(sizes[some], sizes[some]) - shared
    link = likely[np.ix_(some, some)] & (100 * shared >= percent * union)
    label = np.arange(len(some))
    while True:
        low = np.where(link, label[None, :], len(some)).min(axis=1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(some[i]), int(some[label[i]])) for i in np.flatnonzero(label < np.arange(len(some)))]


def _rare_families(members: DataFrame, percent: int, scratch: Scratch) -> DataFrame | None:
    """Second order, for the members (family, c, n, tokens) of large families: sets linked by shared
    tokens of their rarity prefixes inside the family."""
    tokens = members.select("family", "c", "n", F.explode("tokens").alias("t"))
    common = tokens.groupBy("family", "t").agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(common, ["family", "t"])
    by_rarity = W.partitionBy("c").orderBy("df", "t")
    spare = F.expr(f"n - (({percent} * n + 99) div 100) + 1") - (F.col("n") - F.count("*").over(W.partitionBy("c")))
    prefix = shared.withColumn("spare", spare).withColumn("at", F.row_number().over(by_rarity)).filter("at <= spare")
    return _families(_stars(scratch.stored(prefix.select("family", "t", "c")), ["family", "t"]))


def _compared(placed: DataFrame, percent: int) -> DataFrame:
    """Links (u > v) inside each group (family, i, j) of ``placed`` (c, tokens), which holds two blocks at most."""
    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        worker_cache("sets", None)
        pdf = pdf.sort_values("c", ignore_index=True)
        c = pdf["c"].to_numpy()
        pairs = linked([np.asarray(t).view(np.uint64) for t in pdf["tokens"]], percent)
        return pd.DataFrame({"u": [c[i] for i, _ in pairs], "v": [c[j] for _, j in pairs]}, dtype="int64")

    return placed.select("family", "i", "j", "c", "tokens").groupBy("family", "i", "j").applyInPandas(compare, "u bigint, v bigint")


def _in_blocks(members: DataFrame, name: str) -> DataFrame:
    """``members`` with their hash block ``name`` and the family's number of blocks, ``name``_n."""
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"{name}_n"))
    return members.join(sizes, "family").withColumn(name, F.pmod(F.xxhash64("c", F.lit(3)), F.col(f"{name}_n")).cast("int"))


def _links(members: DataFrame, percent: int) -> DataFrame:
    """Links (u > v) that connect the components of the families of ``members`` (family, c, tokens).

    Every block meets the first one. In families of more than two blocks, the sets that this leaves
    outside the largest component meet all blocks; sets of one component need no further comparison.
    """
    placed = _in_blocks(members.select("family", "c", "tokens"), "b")
    partners = F.when(F.col("b") == 0, F.sequence(F.lit(0), F.col("b_n") - 1)).otherwise(F.array("b"))
    return _compared(placed.withColumns({"i": F.lit(0), "j": F.explode(partners)}), percent)


def _links_of_large(members: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    first = cut_lineage(_links(members, percent).distinct())
    joined = _families(first)
    if joined is None:
        first, rest = None, members.select("family", "c", "tokens")
    else:
        named = members.select("family", "c").join(joined.withColumnRenamed("family", "root"), "c", "left").withColumn(
            "root", F.coalesce("root", "c"))
        sizes = named.groupBy("family", "root").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("family").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
        outside = scratch.stored(named.join(largest, "family").filter("root <> largest").select("c"))
        rest = members.select("family", "c", "tokens").join(outside, "c")
    rest = _in_blocks(rest, "r")
    every = _in_blocks(members.select("family", "c", "tokens"), "b")
    numbers = rest.groupBy("family").agg(F.first("r_n").alias("r_n"))
    with_all = rest.join(every.groupBy("family").agg(F.first("b_n").alias("b_n")), "family").select(
        "family", "c", "tokens", F.col("r").alias("i"), F.explode(F.sequence(F.lit(0), F.col("b_n") - 1)).alias("j"))
    met = every.join(numbers, "family").select(
        "family", "c", "tokens", F.explode(F.sequence(F.lit(0), F.col("r_n") - 1)).alias("i"), F.col("b").alias("j"))
    second = _compared(with_all.unionByName(met), percent)
    return second if first is None else first.unionByName(second)


def _survivors(sets: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(c, family) of the sets (c, prefix) that pass the first order; ``sizes``: c, n."""
    tokens = sets.select("c", F.explode("prefix").alias("t"))
    common = tokens.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1").select("t")
    shared = scratch.stored(tokens.join(common, "t").select("c", "t"))
    enough = shared.groupBy("c").agg(F.count("*").alias("m")).join(sizes, "c").filter(F.expr("m >= (n + 19) div 20")).select("c")
    return _families(_stars(scratch.stored(shared.join(cut_lineage(enough), "c")), ["t"]))


def similar_documents(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id of the rows reachable by links of Jaccard similarity
    ``percent`` / 100 or more; equal sets are linked. A row without words (null and empty texts)
    is linked with nothing and has its own doc_id. Repeated rows each give a row; rows without a doc_id take
    part but never name a component that has one.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _components(docs, k, percent, scratch)


def _components(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    sets = scratch.stored(token_sets(docs, k, percent))
    worded = sets.filter("set_id is not null")
    # a class of equal sets goes by its first row
    classes = scratch.stored(worded.groupBy("set_id").agg(F.min("row").alias("c"), F.min("doc_id").alias("head"), F.first("n").alias("n")))
    links = _all_links(docs, worded, classes, k, percent, scratch)
    roots = None if links is None else _families(links)
    named = classes.select("set_id", "c", "head")
    named = named.withColumn("root", F.col("c")) if roots is None else named.join(roots, "c", "left").withColumn(
        "root", F.coalesce("family", "c"))
    smallest = named.groupBy("root").agg(F.min("head").alias("component_id"))
    by_class = named.join(smallest, "root").select("set_id", "component_id")
    found = worded.select("doc_id", "n", "set_id").join(by_class, "set_id").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return cut_lineage(found.unionByName(sets.filter("set_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def _all_links(docs: DataFrame, worded: DataFrame, classes: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame | None:
    """Links (u > v) that connect the classes of each component; None if there are none."""
    copies = cut_lineage(worded.select("row").join(classes.select(F.col("c").alias("row")), "row", "left_anti"))
    firsts = worded.select("row", "prefix").join(broadcast_if(copies, BROADCAST_ROWS), "row", "left_anti")
    families = _survivors(firsts.select(F.col("row").alias("c"), "prefix"), classes.select("c", "n"), scratch)
    if families is None:
        return None
    reps = cut_lineage(classes.join(families, "c").select(F.col("head").alias("rep"), F.col("set_id").alias("expected"), "c", "family"))

    def rows(batch):
        out = {x: [] for x in ("same", "c", "family", "n", "tokens")}
        for s, *named in zip(shingle_sets(batch.column(0), k), *(batch.column(i).to_pylist() for i in (1, 2, 3))):
            for x, v in zip(out, (set_id(s) == named[0], *named[1:], len(s), s.view(np.int64))):
                out[x].append(v)
        yield out

    texts = docs.select("doc_id", "text").join(broadcast_if(reps, BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("rep")))
    members = scratch.stored(  # rows that share a representative's doc_id but not its set are none of it
        arrow_map(texts.select("text", "expected", "c", "family"), "same boolean, c bigint, family bigint, n bigint, tokens array<bigint>", rows)
        .filter("same").drop("same"))
    large = members.groupBy("family").count().filter(F.col("count") > BLOCK).select("family")
    large = broadcast_if(cut_lineage(large), BROADCAST_ROWS)
    links = _links(members.join(large, "family", "left_anti"), percent)
    in_large = members.join(large, "family", "left_semi")
    rare = _rare_families(in_large, percent, scratch)
    if rare is not None:
        again = in_large.select("c", "n", "tokens").join(rare, "c").select("family", "c", "n", "tokens")
        links = links.unionByName(_links_of_large(scratch.stored(again), percent, scratch))
    return cut_lineage(links.filter("u > v").distinct())


_WORDS_SQL = (r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x20\x09-\x0D]+'), [])")
SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= {SHINGLE_WORDS}
        THEN list_distinct([array_to_string(w[p : p + {SHINGLE_WORDS - 1}], ' ') FOR p IN range(1, len(w) - {SHINGLE_WORDS - 2})])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = doc_id) AS component_id FROM s
"""


@register("op3_ngram_jaccard", sql=SQL)
def op3_ngram_jaccard(spark, folder):
    return similar_documents(table(spark, folder, "documents"))
