"""Queries over the shared test tables, each with an independent SQL form where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        # Epoch arithmetic below assumes UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        # Opened once per query: reading a schema costs a job.
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def check(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def r6(column: Column | str, name: str | None = None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    out = F.round(col.cast("double"), 6)
    return out.alias(name or column) if (name or isinstance(column, str)) else out


def big(column: Column | str, name: str | None = None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("long").alias(name or column)
