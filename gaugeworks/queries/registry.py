"""The list of registered queries and the reading of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a data folder; times are timestamps in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        local = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in local})


def query(name: str, sql: str | None = None):
    """Register a query of the tables, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def ms(column: str):
    return F.unix_millis(column)


def day_slice(column: str = "ts"):
    """One day of a timestamp column."""
    return F.floor(F.unix_seconds(column) / 86_400)
