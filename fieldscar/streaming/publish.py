"""Publishing the tables of a run at once: staged folders named by the run, and one marker that makes them visible.

A run that fails before its marker leaves folders that no reader sees and that its repetition overwrites; a run
that is repeated after its marker finds it and writes nothing. So every row counts once, whatever was retried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import exists, names_in
from .cycles import append_cycle, mark_done, without


#: Before the run in folder names, so that it is read back as text.
_AS_TEXT = "r_"


def _folder(path: str, name: str, run: str) -> str:
    return f"{path}/{name}/run={_AS_TEXT}{run}"


def is_published(spark: SparkSession, path: str, run: str) -> bool:
    return exists(spark, f"{_folder(path, 'markers', run)}/_SUCCESS")


def publish(tables: dict[str, DataFrame], path: str, run: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Write ``tables`` under ``path`` as those of ``run``, visible together; False if the run was published before.

    ``run`` names the batch (letters, digits, ``-``, ``_``); the marker is the last thing written.
    """
    spark = next(iter(tables.values())).sparkSession
    if is_published(spark, path, run):
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(_folder(path, name, run))
    spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(_folder(path, "markers", run))
    return True


def published(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """Rows of table ``name`` of all published runs, with their ``run``; None before the first one."""
    start = f"run={_AS_TEXT}"
    runs = [f.removeprefix(start) for f in names_in(spark, f"{path}/markers") if f.startswith(start)]
    folders = [f for r in runs if is_published(spark, path, r) and exists(spark, f := _folder(path, name, r))]
    if not folders:
        return None
    found = spark.read.option("basePath", f"{path}/{name}").option("mergeSchema", True).parquet(*folders)
    return found.withColumn("run", F.col("run").substr(F.lit(len(_AS_TEXT) + 1), F.length("run")))


def _known(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    found = published(spark, path, name)
    return like.limit(0) if found is None else found.select(*like.columns)


def publish_batches(events: DataFrame, path: str, run: str) -> bool:
    """The rows of ``events`` whose ``batch`` is not there yet, one folder per batch; batches that exist stay as they are."""
    spark = events.sparkSession
    fresh = without(events, _known(spark, path, "batches", events.select("batch")), key="batch")
    return publish({"batches": fresh}, path, run, partition_by=("batch",))


def publish_ids(ids: DataFrame, path: str, run: str) -> int:
    """Ids that the ledger at ``path`` lacks, added to it; returns how many ids this run has added, now or before."""
    spark, ids = ids.sparkSession, ids.select(F.col("event_id").cast("string").alias("event_id")).distinct()
    publish({"ledger": without(ids, _known(spark, path, "ledger", ids))}, path, run)
    return published(spark, path, "ledger").filter(F.col("run") == run).count()


def publish_cycle(candidates: DataFrame, screen_log: DataFrame, kept: DataFrame, chips: DataFrame, path: str, run: str) -> bool:
    """One sampling cycle: what it adds to the manifest, to the ledger of events without flood and to the done markers
    (also of events without a chip), published together. A repeated cycle adds nothing."""
    spark = candidates.sparkSession
    manifest, ledger = _known(spark, path, "manifest", kept), _known(spark, path, "ledger", screen_log.select("event_id"))
    _, _, grown = append_cycle(candidates, manifest, ledger, screen_log, kept)
    done = mark_done(without(kept.select("event_id"), _known(spark, path, "done", kept.select("event_id"))), chips)
    return publish({"manifest": without(kept, manifest), "ledger": without(grown, ledger), "done": done}, path, run)
