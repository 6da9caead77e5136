"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; cluster sizing is left alone."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def join_in_place(spark: SparkSession) -> None:
    """Until the next :func:`configure`, sides dealt by the same part of a join's keys are joined without another shuffle."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; pick a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master == "local" or context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldscar-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what a folder holds; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


class Scratch:
    """Intermediate tables in the shared folder, removed at the end of the ``with`` block; what leaves the
    block must not depend on them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)

    def stored(self, df: DataFrame) -> DataFrame:
        """``df`` written as Parquet and read again: cuts the lineage like a checkpoint, but compressed, with column
        pruning, and with the size of its files in place of an estimate that grows with every join."""
        path = shared_folder(self.spark, "table")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
