"""Release tables: batches merged, exclusions applied, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_batch(events: DataFrame) -> DataFrame:
    """One row per event id, from the lowest batch number; ``n_batches`` tells duplicates apart."""
    rest = [c for c in events.columns if c != "event_id"]
    return events.groupBy("event_id").agg(
        F.min_by(F.struct(*rest), "batch_no").alias("_first"), F.count("*").alias("n_batches"),
    ).select("event_id", "_first.*", "n_batches")


def duplicate_events(events: DataFrame) -> DataFrame:
    """(event_id, batch_no) of the rows that lost to an earlier batch."""
    kept = first_batch(events).select("event_id", F.col("batch_no").alias("_kept"))
    return events.join(kept, "event_id").filter(F.col("batch_no") > F.col("_kept")).select("event_id", "batch_no")


def chip_counts(chips: DataFrame) -> DataFrame:
    """Labels and imaged chips per event and batch. ``chips``: event_id, batch_no, has_s2_pre."""
    return chips.groupBy("event_id", "batch_no").agg(
        F.count("*").alias("n_chips"), F.count_if("has_s2_pre").alias("n_chips_imaged"))


def master_events(events: DataFrame, chips: DataFrame) -> DataFrame:
    """First-batch events with chip counts (0 when none) and the productive flag."""
    joined = first_batch(events).drop("n_batches").join(chip_counts(chips), ["event_id", "batch_no"], "left")
    return joined.withColumns({
        "n_chips": F.coalesce("n_chips", F.lit(0)), "n_chips_imaged": F.coalesce("n_chips_imaged", F.lit(0)),
    }).withColumn("flooded_crops", (F.col("n_chips") > 0).cast("int"))


def master_totals(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count("*").alias("events"), F.count_if(F.col("flooded_crops") == 1).alias("productive"),
        F.count_if(F.col("flooded_crops") == 0).alias("zero_chip"), F.sum("n_chips").alias("chips"))


def released_chips(chips: DataFrame, excluded: DataFrame) -> DataFrame:
    return chips.join(excluded.select("chip_id"), "chip_id", "left_anti")


def summary(chips: DataFrame) -> DataFrame:
    """Per hazard and region (and their totals): events, chips, and shares with both radar images,
    all images usable and a growth stage.

    An event counts once in every total: with the first of its rows there. So rows are not copied for each total and no
    set of events is kept; totals are taken of one row per hazard and region.
    """
    per_event = chips.groupBy("event_id", "hazard", "continent").agg(
        F.count("*").alias("n"), F.count_if("has_s1").alias("radar"), F.count_if("usable").alias("usable"), F.count("stage").alias("stage"))

    def first(by, order):
        place = F.row_number().over(W.partitionBy("event_id", *by).orderBy(*order))
        return (F.col("event_id").isNotNull() & (place == 1)).cast("long")

    marked = per_event.withColumns({
        "once": F.col("event_id").isNotNull().cast("long"), "once_hazard": first(["hazard"], ["continent"]),
        "once_continent": first(["continent"], ["hazard"]), "once_all": first([], ["hazard", "continent"])})
    sums = [c for c in marked.columns if c not in ("event_id", "hazard", "continent")]
    small = marked.groupBy("hazard", "continent").agg(*[F.sum(c).alias(c) for c in sums])
    kept = F.grouping_id()  # 0: both kept, 1: by hazard, 2: by region, 3: neither
    events = F.when(kept == 0, F.sum("once")).when(kept == 1, F.sum("once_hazard")).when(
        kept == 2, F.sum("once_continent")).otherwise(F.sum("once_all"))
    share = lambda c: F.bround(100.0 * F.sum(c) / F.sum("n"), 1)
    return small.cube("hazard", "continent").agg(
        events.alias("events"), F.sum("n").alias("chips"), F.bround(F.try_divide(F.sum("n"), events), 1).alias("chips_per_event"),
        share("radar").alias("pct_radar"), share("usable").alias("pct_usable"), share("stage").alias("pct_stage"))


def distributions(chips: DataFrame) -> DataFrame:
    """Chips by stage, month, region, ten-degree latitude band and verdict, as (facet, value, n)."""
    facets = {
        "stage": F.coalesce("stage", F.lit("no data")), "month": F.month("event_date").cast("string"),
        "region": F.col("continent"), "latitude": (F.floor(F.col("lat") / 10) * 10).cast("string"),
        "verdict": F.col("verdict"),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in facets.items()])
    return chips.select(F.inline(pairs)).groupBy("facet", "value").agg(F.count("*").alias("n"))


def event_counts(events: DataFrame) -> DataFrame:
    """Events per continent and per year."""
    return events.groupingSets([["continent"], ["year"]], "continent", "year").agg(F.count("*").alias("n"))


def counter_columns() -> list[Column]:
    """Aggregates over outcomes of a run: event_id, error, n_scenes, n_chips, skipped."""
    ok = F.col("error").isNull() & ~F.col("skipped")
    return [
        F.count_if(ok).alias("events_processed"), F.count_if(F.col("error").isNotNull()).alias("failures"),
        F.count_if("skipped").alias("skipped_existing"),
        F.coalesce(F.sum(F.when(ok, F.col("n_scenes"))), F.lit(0)).alias("scenes_downloaded"),
        F.coalesce(F.sum(F.when(ok, F.col("n_chips"))), F.lit(0)).alias("chips_written")]


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Counters of a run. ``outcomes``: event_id, error, n_scenes, n_chips, flooded_sum, skipped."""
    return outcomes.agg(*counter_columns())


def mean_flooded_share(chips: DataFrame, digits: int = 4) -> DataFrame:
    return chips.groupBy("event_id").agg(
        F.count("*").alias("n_chips"), F.bround(F.avg("flooded_crop_frac"), digits).alias("mean_flooded_crop_frac"))


def scenes_per_day(scenes: DataFrame) -> DataFrame:
    """Scenes per event and overpass day, with the first and last id. The full id list of a day is
    :func:`overpass_items`, one row per id, so that no day is collected into one row."""
    return scenes.groupBy("ev", "acq").agg(
        F.count("*").alias("n_scenes"), F.min("scene_id").alias("first_id"), F.max("scene_id").alias("last_id"))


def overpass_items(scenes: DataFrame) -> DataFrame:
    """Scene ids of each event and overpass day in order."""
    return scenes.select("ev", "acq", "scene_id").orderBy("ev", "acq", "scene_id")
