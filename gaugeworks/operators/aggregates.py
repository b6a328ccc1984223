"""Aggregations: nesting children, ordered lists, batching, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.scan import Running, ordered_scan, row_numbers

CHUNK = 10_000


def nest_children(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    slice_by: Column | None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The rows of each parent packed into arrays, in order.

    A parent with more than ``chunk`` rows gets several numbered arrays, so no
    array outgrows a task and no row is lost.
    """
    columns = df.columns
    numbered = row_numbers(df, keys, order, slice_by, "__rn")
    packed = numbered.select(
        *keys,
        F.floor((F.col("__rn") - 1) / chunk).alias("chunk_no"),
        F.struct(F.col("__rn"), F.struct(*columns).alias("child")).alias("__row"),
    )
    return packed.groupBy(*keys, "chunk_no").agg(
        F.transform(F.sort_array(F.collect_list("__row")), lambda r: r["child"]).alias(name)
    )


def ordered_list(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    name: str,
    slice_by: Column | None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The values of a key as sorted lists of at most ``chunk`` entries each."""
    slim = df.select(*dict.fromkeys([*keys, *order, value]))
    nested = nest_children(slim, keys, order, "__l", slice_by, chunk)
    return nested.select(*keys, "chunk_no", F.transform("__l", lambda r: r[value]).alias(name))


def batch_by_size(
    counts: DataFrame, id_col: str, count_col: str, batch_size: int, slice_by: Column | None
) -> DataFrame:
    """Batch number of each id so that a batch holds about ``batch_size`` events."""
    summed = ordered_scan(counts, [], [id_col], [Running("cum", "sum", F.col(count_col))], slice_by)
    return summed.withColumn("batch_id", F.ceil(F.col("cum") / batch_size).cast("int")).drop("cum")


def ratio_to_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Share of a row in the total of its key; the totals are aggregated and joined."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    return df.join(totals, keys, "left").withColumn(name, F.col(value) / F.col("__total")).drop("__total")


def newest_value(df: DataFrame, column: str) -> DataFrame:
    """The largest value of a column, as a one-row frame."""
    return df.agg(F.max(column).alias(f"max_{column}"))
