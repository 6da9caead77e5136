"""Candidate events: scope, tiers, clusters, stratified sampling and shards."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import tier_rank
from ..schemas import CANDIDATE_COLUMNS, FLOOD_MANIFEST
from ..session import cut_lineage
from .ranking import first_per_group, kth_smallest, ranked, round_robin_position, top_per_group
from .spatial import BOX

CLUSTER_KM, CLUSTER_DAYS = 60.0, 15


def in_scope(df: DataFrame, year_min: int, year_max: int, area_min: float, area_max: float) -> DataFrame:
    return df.filter(
        F.col("year").between(year_min, year_max) & F.col("area_km2_reported").between(area_min, area_max))


def normalise(df: DataFrame) -> DataFrame:
    """The fixed candidate columns in order; absent ones are NULL."""
    absent = {name: F.lit(None).cast(kind) for name, kind in CANDIDATE_COLUMNS.items() if name not in df.columns}
    return df.withColumns(absent).select(*CANDIDATE_COLUMNS) if absent else df.select(*CANDIDATE_COLUMNS)


def tiered_union(news: DataFrame, archive: DataFrame) -> DataFrame:
    """Corroborated news events (tier A; a relief match alone never promotes) and archive events (C)."""
    promoted = news.filter(F.col("match_ems") | F.col("match_dfo")).withColumn("tier", F.lit("A"))
    return normalise(promoted).unionByName(normalise(archive.withColumn("tier", F.lit("C"))))


def cluster_key(lon: Column, lat: Column, day: Column, km: float = CLUSTER_KM, days: int = CLUSTER_DAYS) -> Column:
    size = km / 111.0
    bucket = F.floor(F.date_diff(day, F.lit("1970-01-01").cast("date")) / F.lit(days))
    place = [F.bround(axis / size).cast("long") for axis in (lon, lat)]
    return F.concat_ws("_", *[part.cast("string") for part in (*place, bucket)])


def cluster_events(df: DataFrame, km: float = CLUSTER_KM, days: int = CLUSTER_DAYS) -> DataFrame:
    """One event per space-time grid bucket, with cluster_id and cluster_size.

    Preference: more independent matches, archive source, larger area, earlier onset, id.
    """
    lon = (F.col("bbox_w") + F.col("bbox_e")) / 2.0
    lat = (F.col("bbox_s") + F.col("bbox_n")) / 2.0
    keyed = df.withColumn("cluster_id", cluster_key(lon, lat, F.col("date_start"), km, days))
    order = F.struct(
        (-F.coalesce("n_indep", F.lit(0))).alias("a"), (F.col("source") != "dfo").alias("b"),
        (-F.coalesce("area_km2_reported", F.lit(0.0))).alias("c"), F.col("date_start").alias("d"),
        F.col("event_id").alias("e"),
    )
    return keyed.groupBy("cluster_id").agg(
        F.min_by(F.struct(*df.columns), order).alias("_best"), F.count("*").alias("cluster_size"),
    ).select("_best.*", "cluster_id", "cluster_size")


def seeded(seed: int) -> Callable[..., Column]:
    """Shuffle key of a stratum."""
    return lambda *columns: F.xxhash64(F.lit(seed), *columns)


def _queues(sizes: DataFrame, by: list[str], item: str, shuffle: Callable[..., Column]) -> DataFrame:
    """Per group, the array of its queues (idx, n) and each queue's own idx. Strata are few."""
    within = W.partitionBy(*by)
    own = F.row_number().over(within.orderBy(shuffle(*[F.col(c) for c in (*by, item)]), item))
    indexed = sizes.withColumn("idx", own.cast("long"))
    return indexed.withColumn("queues", F.collect_list(F.struct("idx", "n")).over(within))


def stratum_rank(df: DataFrame) -> DataFrame:
    """Rank in (continent, year): matches, tier, area, id."""
    keyed = df.withColumns({
        "_k1": -F.coalesce("n_indep", F.lit(0)), "_k2": tier_rank("tier"),
        "_k3": -F.coalesce("area_km2_reported", F.lit(0.0)),
    })
    return ranked(keyed, ["continent", "year"], ["_k1", "_k2", "_k3", "event_id"], "stratum_rank").drop(
        "_k1", "_k2", "_k3")


def visit_order(df: DataFrame, shuffle: Callable[..., Column]) -> DataFrame:
    """Add ``visit``: continents take turns, and inside a continent its years take turns.

    The turn of a row follows from the stratum sizes alone, so no global sort is needed.
    Rows repeating an event id keep the first visit.
    """
    strata = df.groupBy("continent", "year").agg(F.count("*").alias("n"))
    years = _queues(strata, ["continent"], "year", shuffle).select(
        "continent", "year", F.col("idx").alias("_yi"), F.col("queues").alias("_yq"))
    sizes = strata.groupBy("continent").agg(F.sum("n").alias("n"))
    continents = _queues(sizes, [], "continent", shuffle).select(
        "continent", F.col("idx").alias("_ci"), F.col("queues").alias("_cq"))
    placed = stratum_rank(df).join(years, ["continent", "year"]).join(continents, "continent")
    placed = placed.withColumn("turn", round_robin_position(F.col("stratum_rank"), F.col("_yq"), F.col("_yi")))
    placed = placed.withColumn("visit", round_robin_position(F.col("turn"), F.col("_cq"), F.col("_ci")))
    return first_per_group(placed.drop("_yi", "_yq", "_ci", "_cq"), ["event_id"], [F.col("visit")])


def sample_and_screen(ordered: DataFrame, screened: DataFrame, quota: int) -> tuple[DataFrame, DataFrame]:
    """(kept, log): the first ``quota`` passing rows in visit order, and every visit up to the last.

    ``screened``: event_id, passed, outcome and optionally measured columns. A row without a
    screen result counts as an error: logged, never kept. The joined visits are written once, so a
    costly screen does not run again for the log.
    """
    visits = cut_lineage(
        ordered.join(screened, "event_id", "left").withColumn("outcome", F.coalesce("outcome", F.lit("error"))))
    kept = visits.filter("passed").orderBy("visit").limit(quota)
    taken, last = kept.agg(F.count("*"), F.max("visit")).first()
    log = visits if taken < quota else visits.filter(F.col("visit") <= last)
    return kept, log.select("event_id", "continent", "year", "visit", "passed", "outcome")


def screen_until(ordered: DataFrame, screen: Callable[[DataFrame], DataFrame], quota: int) -> tuple[DataFrame, DataFrame]:
    """(kept, log) of ``sample_and_screen``, with a costly ``screen`` called only on visits that the quota asks for.

    ``screen`` maps candidates to event_id, passed, outcome and anything measured. Visits are screened in slices: as
    many as the quota lacks, or as were screened before if that is more, until it is full. So at most twice the needed
    visits are screened, in a number of slices that is logarithmic in them; each slice's answers are written once.
    """
    ordered = cut_lineage(ordered)
    last = ordered.agg(F.max("visit")).first()[0] or 0
    done, passed, parts = 0, 0, []
    while done < last and passed < quota or not parts:
        upto = min(last, done + max(quota - passed, done))
        part = ordered.filter((F.col("visit") > done) & (F.col("visit") <= upto))
        answers = screen(part)
        part = cut_lineage(part.drop(*[c for c in answers.columns if c != "event_id"]).join(answers, "event_id", "left").withColumns({
            "passed": F.coalesce("passed", F.lit(False)), "outcome": F.coalesce("outcome", F.lit("error"))}))
        parts.append(part)
        found = part.filter("passed").count()
        if passed + found >= quota:
            last = kth_smallest(part.filter("passed"), "visit", quota - passed, done, upto) if quota else 0
        done, passed = upto, passed + found
    visits = functools.reduce(DataFrame.unionByName, parts)
    log = visits.filter(F.col("visit") <= last)
    return log.filter("passed"), log.select("event_id", "continent", "year", "visit", "passed", "outcome")


def screened_manifest(kept: DataFrame) -> DataFrame:
    """Manifest rows of screened events: the flooded box and the search window of the screen take the place of the
    reported ones, which stay as event_date_*, and what it measured is named gfm_*."""
    measured = {f"gfm_{c}": F.col(c).cast(t) for c, t in (
        ("n_scenes", "int"), ("n_overpass_days", "int"), ("flood_px", "int"), ("flood_km2", "double"), ("epsg", "int"))}
    rest = [c for c in kept.columns if c in FLOOD_MANIFEST and c not in (
        *BOX, "event_id", "date_start", "date_end", "event_date_start", "event_date_end", "aoi_tightened")]
    merged = merge_screen(kept).join(kept.select("event_id", *rest, *[c.alias(n) for n, c in measured.items()]), "event_id")
    return merged.withColumn("aoi_tightened", F.coalesce("aoi_tightened", F.lit(False)))


def merge_screen(kept: DataFrame) -> DataFrame:
    """A kept row takes the screen's box and search window; reported dates move to event_date_*."""
    boxed = F.col("flood_bbox").isNotNull()
    pick = lambda side, old: F.coalesce(F.col(f"flood_bbox.{side}"), F.col(old))
    return kept.select(
        "event_id", "visit",
        *[pick(c[-1], c).alias(c) for c in ("bbox_w", "bbox_s", "bbox_e", "bbox_n")],
        F.when(boxed, True).alias("aoi_tightened"),
        F.col("date_start").alias("event_date_start"), F.col("date_end").alias("event_date_end"),
        F.coalesce("search_start", "date_start").alias("date_start"),
        F.coalesce("search_end", "date_end").alias("date_end"),
    )


def screen_with(candidates: DataFrame, screen: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a pluggable screen over candidates; ids it does not answer get outcome ``error``."""
    answers = screen(candidates).select("event_id", "passed", "outcome")
    return candidates.select("event_id").join(answers, "event_id", "left").select(
        "event_id", F.coalesce("passed", F.lit(False)).alias("passed"),
        F.coalesce("outcome", F.lit("error")).alias("outcome"))


def cap_per_continent(df: DataFrame, cap: int = 700, start: int = 0, limit: int | None = None) -> DataFrame:
    """At most ``cap`` rows per continent in file order (``pos``), then skip and take."""
    capped = top_per_group(df, ["continent"], ["pos"], cap, "_nth").drop("_nth").orderBy("pos").offset(start)
    return capped if limit is None else capped.limit(limit)


def shard_letters(number: Column, longest: int = 8) -> Column:
    """0 is aa, 675 is zz, 676 is aaa: all names of one length before those of the next."""
    first, out = 0, None
    for length in range(2, longest + 1):
        at = number - first
        name = F.concat(*[F.chr(97 + F.pmod(F.floor(at / 26 ** k), F.lit(26))) for k in range(length - 1, -1, -1)])
        first += 26 ** length
        out = F.when(number < first, name) if out is None else out.when(number < first, name)
    return out


def shard_signs(number: Column) -> Column:
    """Two signs for any number: the 26 x 26 names aa to zz, and beyond them the first sign goes on by code point."""
    point = F.lpad(F.hex(97 + F.floor(number / 26)), 8, "0")
    return F.concat(F.decode(F.unhex(point), "UTF-32"), F.chr(97 + F.pmod(number, F.lit(26))))


def shard(df: DataFrame, size: int = 50, first_batch: int = 1, names: Callable[[Column], Column] = shard_letters) -> DataFrame:
    """Cut rows in ``pos`` order into shards of ``size``, with batch numbers and names by ``names``: aa to zz, then aaa
    to zzz and so on, or ``shard_signs``."""
    block = F.floor((F.col("_row") - 1) / F.lit(size))
    return (
        ranked(df, [], ["pos"], "_row").withColumn("shard_no", block)
        .withColumn("shard", F.concat(F.lit("shard_"), names(F.col("shard_no"))))
        .withColumn("batch", F.col("shard_no") + first_batch).drop("_row")
    )
