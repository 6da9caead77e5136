"""Input catalogues: file scans with fixed schemas, then lenient parsing into candidate columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.geo import bbox_of_rings, continent_of
from ..functions.text import archive_event_id, as_bool, batch_label, lenient_date, lenient_double, news_event_id

NEWS_SCHEMA = f"uuid string, area_km2 double, start_date string, end_date string, rings {schemas.RING_ARRAY}"
ARCHIVE_SCHEMA = ("ReportNumber double, BeginDate string, EndDate string, Severity string, Country string, "
                  "MainCause string, GlideNumber string, Area string, SubdivisionName string, "
                  f"rings {schemas.RING_ARRAY}")
ACTIVATION_SCHEMA = "code string, eventTime string, centroid string, countries array<string>"
RELIEF_SCHEMA = "id long, disaster_start_date string, countries array<struct<iso3:string>>, name string"


def _boxed(df: DataFrame) -> DataFrame:
    """Bounds of the rings as bbox_* and the region of their centre."""
    df = df.withColumn("_b", bbox_of_rings("rings", digits=None))
    df = df.withColumns({f"bbox_{side}": F.col(f"_b.{side}") for side in "wsen"}).drop("_b")
    return df.withColumn("continent", continent_of(
        (F.col("bbox_w") + F.col("bbox_e")) / 2.0, (F.col("bbox_s") + F.col("bbox_n")) / 2.0))


def news_floods(raw: DataFrame, start_year: int = 2020, year_min: int = 2020, year_max: int = 2026,
                area_min: float = 10.0, area_max: float = 2000.0) -> DataFrame:
    """News floods in scope as candidates. The filters read scalar columns only, so the rings of
    dropped rows are never decoded past the scan."""
    year = F.substring("start_date", 1, 4).try_cast("int")
    first = max(start_year, year_min)
    pushed = (F.col("start_date") >= f"{first:04d}") & (F.col("start_date") < f"{year_max + 1:04d}")  # reaches the scan
    kept = raw.filter(
        pushed & year.between(first, year_max) & F.col("area_km2").between(area_min, area_max))
    return _boxed(kept).select(
        news_event_id("uuid").alias("event_id"), F.lit("groundsource").alias("source"),
        lenient_date("start_date").alias("date_start"), lenient_date("end_date").alias("date_end"),
        "bbox_w", "bbox_s", "bbox_e", "bbox_n", year.alias("year"), F.col("area_km2").alias("area_km2_reported"),
        "continent", "rings")


def archive_valid(severity: Column, begin: Column, year_min: int, year_max: int, min_severity: float) -> Column:
    return begin.isNotNull() & F.year(begin).between(year_min, year_max) & (severity >= min_severity)


def archive_floods(raw: DataFrame, year_min: int = 2020, year_max: int = 2026, min_severity: float = 1.5) -> DataFrame:
    """Archive floods in scope as candidates; malformed dates and numbers become NULL."""
    begin, end = lenient_date("BeginDate"), lenient_date("EndDate")
    severity = F.col("Severity").try_cast("double")
    kept = raw.filter(archive_valid(severity, begin, year_min, year_max, min_severity)
                      & F.col("rings").isNotNull() & (F.size("rings") > 0))
    note = F.concat(F.lit("DFO Severity "), F.col("Severity"), F.lit("; "), F.coalesce("SubdivisionName", F.lit("")))
    return _boxed(kept).select(
        archive_event_id("ReportNumber").alias("event_id"), F.lit("dfo").alias("source"),
        begin.alias("date_start"), F.coalesce(end, begin).alias("date_end"),
        "bbox_w", "bbox_s", "bbox_e", "bbox_n", F.col("Country").alias("country"), "continent",
        F.year(begin).alias("year"), severity.alias("magnitude"), F.col("MainCause").alias("cause"),
        F.when(F.col("GlideNumber") != "", F.col("GlideNumber")).alias("glide"),
        lenient_double("Area").alias("area_km2_reported"),
        F.regexp_replace(note, "^[; ]+|[; ]+$", "").alias("notes"), "rings")


def activations(raw: DataFrame) -> DataFrame:
    """Activation points (code, date, countries, lon, lat); unreadable centroids are dropped."""
    pattern = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"
    parts = {axis: F.regexp_extract("centroid", pattern, i).try_cast("double") for i, axis in ((1, "lon"), (2, "lat"))}
    return raw.select(
        "code", lenient_date("eventTime").alias("date"),
        F.array_join(F.coalesce("countries", F.array().cast("array<string>")), ";").alias("countries"),
        *[v.alias(k) for k, v in parts.items()]).filter("lon IS NOT NULL AND lat IS NOT NULL")


def relief_events(raw: DataFrame) -> DataFrame:
    """Relief records (id, date, iso3 joined by ``;``, name)."""
    codes = F.filter(F.transform("countries", lambda c: c["iso3"]), lambda c: F.coalesce(c, F.lit("")) != "")
    return raw.select(
        "id", lenient_date("disaster_start_date").alias("date"),
        F.coalesce(F.array_join(codes, ";"), F.lit("")).alias("iso3"), "name")


def read_news(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NEWS_SCHEMA).parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(path)


def read_activations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACTIVATION_SCHEMA).option("multiLine", True).json(path)


def read_relief(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RELIEF_SCHEMA).option("multiLine", True).json(path)


def read_manifest(spark: SparkSession, path: str, columns: dict[str, str] = schemas.FLOOD_MANIFEST) -> DataFrame:
    """Typed manifest rows; text booleans are accepted in any spelling."""
    text = {name: "string" if kind == "boolean" else kind for name, kind in columns.items()}
    raw = spark.read.schema(schemas.ddl(text)).option("header", True).option("nullValue", "").csv(path)
    flags = {n: F.when(F.col(n).isNotNull(), as_bool(n)) for n, kind in columns.items() if kind == "boolean"}
    return manifest_rows(raw.withColumns(flags))


def manifest_rows(df: DataFrame) -> DataFrame:
    """Add the box array; the year comes from the event date, else from the search window."""
    year = F.year(F.coalesce("event_date_start", "date_start"))
    return df.withColumns({"bbox": F.array("bbox_w", "bbox_s", "bbox_e", "bbox_n"), "year": year})


def parse_documents(lines: DataFrame, schema: str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable lines) of JSON text under a fixed schema."""
    record = F.from_json(F.col(text), f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = lines.withColumn("_doc", record)
    bad = F.col("_doc").isNull() | F.col("_doc._bad").isNotNull()
    keep = [c for c in lines.columns if c != text]
    return parsed.filter(~bad).select(*keep, "_doc.*").drop("_bad"), parsed.filter(bad).select(*lines.columns)


def read_sidecars(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """(readable sidecars, unreadable texts) of all JSON files below ``path``: one document per line, or
    one per file with ``whole_files``, where text after the document makes the file unreadable."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=whole_files)
    texts = files.filter(F.trim("value") != "").withColumn("path", F.input_file_name())
    if not whole_files:
        return parse_documents(texts, schema)
    single = F.coalesce(F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))) == 1, F.lit(False))
    good, bad = parse_documents(texts.filter(single), schema)
    return good, bad.unionByName(texts.filter(~single))


def read_chips(spark: SparkSession, path: str, schema: str, event: str | None = None,
               limit: int | None = None) -> DataFrame:
    return chip_list(spark.read.schema(schema).json(path), event, limit)


def chip_list(chips: DataFrame, event: str | None = None, limit: int | None = None) -> DataFrame:
    """Chips of one event, or the first ``limit`` chips by id."""
    if event is not None:
        chips = chips.filter(F.col("event_id") == event)
    return chips if limit is None else chips.orderBy("chip_id").limit(limit)


def search_scenes(scenes: DataFrame, box: tuple, first: str, last: str) -> DataFrame:
    """Scenes meeting a box between two dates, both days included."""
    w, s, e, n = box
    return scenes.filter(
        (F.col("bbox_w") <= e) & (F.col("bbox_e") >= w) & (F.col("bbox_s") <= n) & (F.col("bbox_n") >= s)
        & (F.col("acq") >= F.lit(first).cast("date")) & (F.col("acq") < F.date_add(F.lit(last).cast("date"), 1)))


def read_cells(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Raster cells partitioned by event; the half-open day range prunes partitions or row groups."""
    return in_days(spark.read.parquet(path), first, last)


def in_days(cells: DataFrame, first: str | None = None, last: str | None = None, day: str = "day") -> DataFrame:
    """Rows of the half-open day range [first, last)."""
    if first is not None:
        cells = cells.filter(F.col(day) >= F.lit(first).cast("date"))
    return cells if last is None else cells.filter(F.col(day) < F.lit(last).cast("date"))


def ledger_ids(lines: DataFrame) -> DataFrame:
    return lines.select(F.trim("value").alias("event_id")).filter("event_id <> ''").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return ledger_ids(spark.read.text(path))


EXCLUSION_SCHEMA = "chip_id string, event_id string, hazard string, reason string"


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXCLUSION_SCHEMA).option("header", True).csv(path)


def exclusion_rows(lines: DataFrame) -> DataFrame:
    """Exclusion entries from CSV text lines."""
    return lines.select(F.from_csv("value", EXCLUSION_SCHEMA).alias("x")).select("x.*").filter("chip_id <> 'chip_id'")


def batch_folders(events: DataFrame) -> DataFrame:
    """Batch number and label from ``batch_<digits>`` names; other names are not batches."""
    number = F.regexp_extract("batch_name", r"^batch_(\d+)$", 1).try_cast("int")
    return events.withColumn("batch_no", number).filter("batch_no IS NOT NULL").withColumn("batch", batch_label("batch_no"))
