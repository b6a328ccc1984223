"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# \x20 and \x09-\x0D, the white space of the contracts.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch. Texts can be long, so a batch is kept to few rows.
BATCH_ROWS = 200


def query(name: str, sql: str | None = None):
    """Register a query of a data folder, with the SQL that must give the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Python workers that get whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def unsigned_crc32(c: Column) -> Column:
    return F.crc32(c).cast("long")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text (a null is not an empty text)."""
    shown = F.coalesce(F.concat(F.lit("t"), text), F.lit("n"))
    return [F.xxhash64(shown), F.xxhash64(F.lit("second"), shown)]


# Rows of a key that one task may look up together, at least; keys above are spread.
SPREAD_ROWS = 1000
MAX_HOT_KEYS = 1000


def lookup(rows: DataFrame, unique: DataFrame, keys: list[str], spread_by: Column) -> DataFrame:
    """Left join to a stored table of distinct `keys` that counts the rows of each in `n`.

    Keys with more rows than both `SPREAD_ROWS` and a `MAX_HOT_KEYS`-th of all counted
    rows are hot, so there are at most `MAX_HOT_KEYS` of them, and only they are sent to
    every task: their rows are parted by `spread_by` and their entries repeated as often.
    """
    total = unique.agg(F.sum("n")).first()[0] or 0
    most = max(SPREAD_ROWS, -(-total // MAX_HOT_KEYS))
    parts = F.ceil(F.col("n") / F.lit(most)).cast("long")
    hot = unique.filter(F.col("n") > most).select(*keys, parts.alias("__parts"))
    salt = F.pmod(spread_by, F.coalesce(F.col("__parts"), F.lit(1)))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt).drop("__parts")
    repeated = unique.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("n")
    return salted.join(repeated, [*keys, "__salt"], "left").drop("__salt")
