"""Helpers shared by the operators: registration, bounded broadcasts, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import Scratch, configure, remove, shared_folder  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``plan(spark, folder)`` as query ``name`` with its comparison SQL, if any."""
    def wrap(plan: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(configure(spark), folder.rstrip("/"))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan
    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint if ``df`` (narrow, cheap to count) has at most ``max_rows`` rows; beyond that
    the join shuffles both sides, and gives the same rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


_KEPT: dict = {}


def worker_cache(key, make: Callable):
    """``make()``, kept in this Python worker beyond its tasks until another key is asked for: a worker
    that Spark reuses for the next operator holds nothing of the last one."""
    if key not in _KEPT:
        _KEPT.clear()
        if make is None:
            return None
        _KEPT[key] = make()
    return _KEPT[key]


def arrow_map(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], Iterator[dict]]) -> DataFrame:
    """``df`` mapped batch by batch: ``rows`` turns an Arrow batch into dicts of column lists."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for columns in rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)
