"""Incremental batch state: append cycles, ledgers and done markers.

The sampling cycle keeps its state in tables (manifest, no-flood ledger, done markers). Every step
is an anti-join or a union, so a repeated run adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def without(df: DataFrame, *known: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key is in none of the known tables."""
    skip = known[0].select(key)
    for other in known[1:]:
        skip = skip.unionByName(other.select(key))
    return df.join(skip.distinct(), key, "left_anti")


def open_candidates(candidates: DataFrame, manifest: DataFrame, no_flood: DataFrame) -> DataFrame:
    """Candidates neither sampled before nor known to show no flood."""
    return without(candidates, manifest, no_flood)


def definitive_misses(screen_log: DataFrame) -> DataFrame:
    """Only a clean read without flood enters the ledger; transient outcomes stay retryable."""
    return screen_log.filter(F.col("outcome") == "no_flood").select("event_id")


def append_new(existing: DataFrame, kept: DataFrame) -> DataFrame:
    """Existing rows plus kept rows that are not there yet."""
    return existing.unionByName(kept.join(existing.select("event_id"), "event_id", "left_anti").select(*existing.columns))


def cycle_rows(manifest: DataFrame, new_ids: DataFrame) -> DataFrame:
    """This cycle's rows in manifest order (``pos``)."""
    return manifest.join(new_ids.select("event_id"), "event_id", "left_semi").orderBy("pos")


def seed_manifest(current: DataFrame | None, seed: DataFrame) -> DataFrame:
    """The seed list only when the cycle has no manifest of its own."""
    return seed if current is None else current


def grow_ledger(ledger: DataFrame, misses: DataFrame) -> DataFrame:
    return ledger.select("event_id").unionByName(misses.select("event_id")).distinct()


def mark_done(processed: DataFrame, chips: DataFrame) -> DataFrame:
    """Done marker per processed event, also for events that yielded no chip."""
    counts = chips.groupBy("event_id").agg(F.count("*").alias("n_chips"))
    return processed.select("event_id").join(counts, "event_id", "left").withColumn(
        "n_chips", F.coalesce("n_chips", F.lit(0)))


def append_cycle(candidates: DataFrame, manifest: DataFrame, no_flood: DataFrame, screen_log: DataFrame,
                 kept: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(open candidates, next manifest, next ledger) of one cycle."""
    return (
        open_candidates(candidates, manifest, no_flood), append_new(manifest, kept),
        grow_ledger(no_flood, definitive_misses(screen_log)),
    )
