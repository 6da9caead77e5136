"""Query registry: ``@query(name, sql)`` pairs a Spark plan with equivalent SQL over the same tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables and to the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in views.VIEWS:
            source, columns = views.VIEWS[name]
            return getattr(self, source).selectExpr(*columns)
        if name in views.BUILT:
            return views.BUILT[name](self)
        if name in views.TABLES:
            self.__dict__[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return self.__dict__[name]
        raise AttributeError(name)


def query(name: str, sql: str | None = None):
    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(configure(spark), folder.rstrip("/")))
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return plan
    return register


def with_views(sql: str) -> str:
    """Prefix the SQL with the view definitions it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views.SQL_VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(views.SQL_VIEWS[name])
                needed.append(name)
    visit(sql)
    ctes = [f"{name} AS ({views.SQL_VIEWS[name]})" for name in needed]
    body = sql.strip()
    head = re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.I)
    if not ctes:
        return body
    if head:
        return f"WITH {head.group(1) or ''}{', '.join(ctes)}, {body[head.end():]}"
    return f"WITH {', '.join(ctes)} {body}"
