"""Published tables and documents: row formatting as DataFrames, then plain Spark writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import schemas
from ..functions.classes import NODATA
from ..functions.quality import IMAGES
from ..functions.geo import rect_ring
from ..operators.release import counter_columns


def manifest_text(df: DataFrame, columns=tuple(schemas.FLOOD_MANIFEST)) -> DataFrame:
    """Fixed column order as text, NULL (or an absent column) as the empty string."""
    return df.select(*[
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns])


def write_manifest(df: DataFrame, path: str, columns=tuple(schemas.FLOOD_MANIFEST)) -> None:
    manifest_text(df, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def features(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per event: its box as a closed ring, and the chosen properties."""
    ring = F.transform(rect_ring("bbox_w", "bbox_s", "bbox_e", "bbox_n"), lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    body = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.select("event_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("feature"))


def write_features(df: DataFrame, path: str, properties: list[str]) -> None:
    features(df, properties).select("feature").write.mode("overwrite").text(path)


def chip_rows(chips: DataFrame) -> DataFrame:
    return chips.select(*[F.col(c) if c in chips.columns else F.lit(None).cast("string").alias(c) for c in schemas.CHIP_LIST])


def write_chip_lists(chips: DataFrame, json_path: str, csv_path: str) -> None:
    chips.write.mode("overwrite").option("ignoreNullFields", False).json(json_path)
    chip_rows(chips).write.mode("overwrite").option("header", True).csv(csv_path)


def imagery_lines(scenes: DataFrame) -> DataFrame:
    """One provenance line per chip: its window and the scene behind every image it got.

    ``scenes``: chip_id, flood_start, flood_end, raster, scene (struct).
    """
    per = scenes.groupBy("chip_id", "flood_start", "flood_end").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("raster", "scene")))).alias("imagery"))
    return per.select("chip_id", F.to_json(F.struct("chip_id", "flood_start", "flood_end", "imagery")).alias("line"))


def write_imagery(scenes: DataFrame, path: str) -> None:
    imagery_lines(scenes).select("line").write.mode("overwrite").text(path)


def report_rows(counters: DataFrame, counts: DataFrame) -> DataFrame:
    """Run counters and event counts as (section, name, n). ``counts``: continent, year, n."""
    entries = F.array(*[F.struct(F.lit("counters").alias("section"), F.lit(c).alias("name"), F.col(c).alias("n"))
                        for c in counters.columns])
    grouped = counts.select(
        F.when(F.col("continent").isNotNull(), "by_continent").otherwise("by_year").alias("section"),
        F.coalesce("continent", F.col("year").cast("string")).alias("name"), "n")
    return counters.select(F.inline(entries)).unionByName(grouped)


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")


def write_run(outcomes: DataFrame, path: str, stage: str, params: dict | None = None,
              continents: Sequence[str] = (), years: Sequence[int] = ()) -> dict:
    """Records of a run (one JSON line per event or failure, in folders of their kind) and its report; returns the report.

    ``outcomes``: event_id, error, skipped, n_scenes, n_chips, continent, year, anything. The counters, and the counts of
    the named continents and years, are observed while the records are written: the outcomes are computed once.
    """
    spark, seen = outcomes.sparkSession, Observation(f"run-{uuid.uuid4().hex}")
    groups = {("by_continent", c): F.col("continent") == c for c in continents} | {("by_year", str(y)): F.col("year") == y for y in years}
    named = [F.count_if(F.coalesce(hit, F.lit(False))).alias(f"g{i}") for i, hit in enumerate(groups.values())]
    kind = F.when(F.col("error").isNotNull(), "failures").otherwise("events").alias("kind")
    outcomes.select("*", kind).observe(seen, F.count("*").alias("n"), *counter_columns(), *named).write.mode("overwrite").partitionBy(
        "kind").option("ignoreNullFields", False).json(f"{path}/records")
    got = seen.get
    report = {"stage": stage, "params": params or {}, "n_events": got["n"] - got["failures"], "n_failures": got["failures"],
              "counters": {k: v for k, v in got.items() if k != "n" and not k.startswith("g")}}
    for i, (section, name) in enumerate(groups):
        report.setdefault(section, {})[name] = got[f"g{i}"]
    spark.createDataFrame([(json.dumps(report),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/report")
    return report


def documents(df: DataFrame, body: Column) -> DataFrame:
    """(event_id, chip_id, document): NULL blocks are written out, they carry meaning."""
    return df.select("event_id", "chip_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))


FOLDERS, ROWS_PER_FILE = 64, 20_000


def in_folders(df: DataFrame, *order: str, folders: int = FOLDERS) -> DataFrame:
    """``df`` with a column ``part``, one of ``folders`` hash buckets of the first ``order`` column, ranged by
    part and order: a bounded number of folders, and neighbours in one file."""
    return df.withColumn("part", F.pmod(F.xxhash64(order[0]), F.lit(folders)).cast("int")).repartitionByRange("part", *order)


def write_sidecars(sidecars: DataFrame, path: str, folders: int = FOLDERS) -> None:
    """One document per line; the documents keep all their columns, the folder is a hash of the event."""
    in_folders(sidecars, "event_id", "chip_id", folders=folders).write.mode("overwrite").partitionBy("part").option(
        "maxRecordsPerFile", ROWS_PER_FILE).option("ignoreNullFields", False).json(path)


def series_rows(series: DataFrame) -> DataFrame:
    days = series.withColumn("overpass_day", F.date_format("day", "yyyyMMdd"))
    return days.select("ev", "overpass_day", "flood_px", "valid_px", "flood_km2")


def write_series(series: DataFrame, path: str) -> None:
    in_folders(series_rows(series), "ev", "overpass_day").write.mode("overwrite").partitionBy("part").option(
        "maxRecordsPerFile", ROWS_PER_FILE).option("header", True).csv(path)


def image_order(raster: str = "raster") -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in IMAGES]), F.col(raster))


def write_quality(images: DataFrame, chips: DataFrame, path: str) -> None:
    images.select(*schemas.QC_IMAGE).orderBy("chip_id", image_order()).write.mode("overwrite").option(
        "header", True).csv(f"{path}/images")
    chips.select(*schemas.QC_CHIP).orderBy("chip_id").write.mode("overwrite").option("header", True).csv(f"{path}/chips")


def label_bytes(cells: DataFrame) -> DataFrame:
    """The five label bands of each cell as bytes in band order, nodata as 255."""
    return cells.select("ev", "r", "c", *[
        F.coalesce(F.col(b).cast("int"), F.lit(NODATA)).cast("short").alias(b) for b in schemas.LABEL_BANDS])


def write_labels(cells: DataFrame, path: str) -> None:
    in_folders(label_bytes(cells), "ev", "r", "c").write.mode("overwrite").partitionBy("part").parquet(path)


def new_ids(ids: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sorted ids that are not in the ledger yet."""
    return ids.select("event_id").distinct().join(ledger.select("event_id"), "event_id", "left_anti").orderBy("event_id")


def fresh_batches(events: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of batches that do not exist yet; existing ones are left as they are."""
    return events.join(existing.select("batch").distinct(), "batch", "left_anti")


def write_release(master: DataFrame, chips: DataFrame, path: str) -> None:
    master.write.mode("overwrite").parquet(f"{path}/events_master")
    in_folders(chips, "event_id", "chip_id").write.mode("overwrite").partitionBy("part").parquet(f"{path}/chips")
