"""Crop growth stage of a chip at the event date, from per-cell growth cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import growth as G
from ..functions.dates import date_from_2000

DATES = ("inc", "max", "dec", "min")
TRANSITIONS = ("green_up_onset", "maximum", "senescence_onset", "dormancy_onset")


def score_cycles(cycles: DataFrame) -> DataFrame:
    """Coherence, cycle code and stage of every candidate cycle.

    ``cycles``: chip_id, cell_id, granule_year, cycle, inc, max, dec, min, weight, year, day
    (year and day number of the event). Granules are the year before and the event year.
    """
    ok = G.coherent(*DATES)
    holds = ok & G.contains("inc", "min", "day")
    return cycles.withColumns({
        "ok": ok, "holds": holds,
        "code": (F.when(F.col("granule_year") == F.col("year"), 10).otherwise(0) + F.col("cycle")).cast("int"),
        "stage": G.stage_code("inc", "max", "dec", "min", "day"),
    })


def cell_stages(scored: DataFrame) -> DataFrame:
    """Stage and winning cycle per cell: the first coherent cycle that holds the date; stage 0 when
    none does; cells without a coherent cycle are left out."""
    first = lambda c: F.min_by(c, F.when(F.col("holds"), F.col("code")))
    cells = scored.groupBy("chip_id", "cell_id").agg(
        F.bool_or("ok").alias("ok"), first("stage").alias("stage"),
        F.min(F.when(F.col("holds"), F.col("code"))).alias("code"), F.max("weight").alias("weight"))
    return cells.filter("ok").select(
        "chip_id", "cell_id", F.coalesce("stage", F.lit(0)).alias("stage"),
        F.coalesce("code", F.lit(0)).alias("code"), "weight")


def weighted_counts(cells: DataFrame, value: str) -> DataFrame:
    return cells.groupBy("chip_id", value).agg(F.sum("weight").alias("w"))


def dominant(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Heaviest value per chip; the smallest value on ties."""
    return counts.groupBy("chip_id").agg(F.max_by(value, F.struct(F.col("w"), -F.col(value))).alias(name))


def cycle_medians(scored: DataFrame) -> DataFrame:
    """Exact median of each date over the coherent cells of a cycle. Equal dates are counted first, so
    a large chip reaches the median as one row per date and count."""
    dates = F.inline(F.array(*[F.struct(F.lit(d).alias("name"), F.col(d).alias("value")) for d in DATES]))
    counts = scored.filter("ok").select("chip_id", "code", dates).groupBy("chip_id", "code", "name", "value").agg(
        F.count("*").alias("n"))
    return counts.groupBy("chip_id", "code").agg(*[
        F.percentile(F.when(F.col("name") == d, F.col("value")), F.lit(0.5), F.col("n")).alias(d) for d in DATES])


def _totals(value: str):
    """Weight per distinct ``value`` of the votes ``v``, by value."""
    kinds = F.array_sort(F.array_distinct(F.transform("v", lambda x: x[value])))
    return F.transform(kinds, lambda k: F.struct(k.alias(value), F.aggregate(
        F.filter("v", lambda x: x[value] == k), F.lit(0.0), lambda a, x: a + x["weight"]).alias("w")))


def _heaviest(totals: str, value: str):
    """The entry with the largest weight, of equal ones the smallest value."""
    return F.element_at(F.array_sort(F.transform(totals, lambda x: F.struct(
        (-x["w"]).alias("lightness"), x[value].alias(value), x["w"].alias("w")))), 1)


def chip_stages(scored: DataFrame) -> DataFrame:
    """Majority stage, agreement, shares, winning cycle, its transition dates and the pixel total."""
    # at most 4 stages x 5 cycle codes per chip: everything below works on this small table
    votes = cell_stages(scored).groupBy("chip_id", "stage", "code").agg(F.sum("weight").alias("weight"))
    per_chip = votes.groupBy("chip_id").agg(F.collect_list(F.struct("stage", "code", "weight")).alias("v"))
    shares = per_chip.withColumns({"per_stage": _totals("stage"), "per_code": F.filter(_totals("code"), lambda x: x["code"] > 0)})
    shares = shares.withColumns({
        "total": F.aggregate("per_stage", F.lit(0.0), lambda a, x: a + x["w"]), "stage_max": _heaviest("per_stage", "stage"),
        "code": _heaviest("per_code", "code")["code"]}).withColumns(
        {"dominant_stage": F.col("stage_max.stage"), "top": F.col("stage_max.w")})
    out = shares.join(cycle_medians(scored), ["chip_id", "code"], "left")
    share = lambda w: F.bround(w / F.col("total"), 3)
    return out.select(
        "chip_id", G.stage_name("dominant_stage").alias("stage"), share(F.col("top")).alias("stage_agreement"),
        F.map_from_entries(F.transform("per_stage", lambda s: F.struct(G.stage_name(s["stage"]), share(s["w"]))))
        .alias("stage_fractions"),
        G.cycle_name("code").alias("growth_cycle"),
        F.struct(*[date_from_2000(d).alias(t) for d, t in zip(DATES, TRANSITIONS)]).alias("transitions"),
        F.bround("total").cast("int").alias("n_valid_pixels"))


def attach_growth(chips: DataFrame, stages: DataFrame, burn: bool) -> DataFrame:
    """Add the phenology block and note. ``chips``: chip_id, event_date (DATE), ...

    Years past the coverage and chips without a coherent cycle get NULL and a note. Flood chips
    the reducer did not answer for keep both NULL; burn chips get the no-cycle note.
    """
    year = F.year("event_date")
    name = "stage_at_burn" if burn else "stage_at_flood"
    dated = F.date_format("event_date", "yyyy-MM-dd")
    extra = [dated.alias("burn_date"), F.lit(G.SOURCE).alias("source"), F.lit(G.METHOD).alias("method")] if burn else [
        dated.alias("flood_date")]
    s = stages.withColumn("_has", F.lit(True))
    joined = chips.join(s, "chip_id", "left")
    block = F.struct(
        F.col("stage").alias(name), "stage_agreement", "stage_fractions", "growth_cycle", "transitions",
        "n_valid_pixels", *extra)
    usable = F.coalesce("_has", F.lit(False)) & (year <= G.LAST_YEAR)
    note = F.coalesce(G.coverage_note(year), F.when(~usable, G.NOTE_NO_CYCLE))
    return joined.select(
        *chips.columns, F.when(usable, block).alias("phenology"), note.alias("phenology_note"))
