"""Bounded window frames that hold up under hot keys.

Rows are cut into blocks of their order, and a block also gets copies of the
rows just before and after it that its frames reach. The window then runs per
block; the copies are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.slices import time_slice
from gaugeworks.operators.scan import row_numbers

BLOCK_ROWS = 100_000


def in_blocks(
    numbered: DataFrame, keys: list[str], number: Column, before: int, after: int, block: int
) -> DataFrame:
    """Rows with the block they live in and a copy for each block that must see them.

    ``before`` and ``after`` say how far a row looks. Windows per key and
    ``__block`` then see all they need; keep the rows where ``__home`` equals
    ``__block``. No row is in more than a few blocks, as the reach is bounded.
    """
    home = F.floor(number / block)
    seen_by = F.sequence(F.floor((number - after) / block), F.floor((number + before) / block))
    return numbered.withColumn("__home", home).withColumn("__block", F.explode(seen_by))


def rows_frame(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: int,
    after: int,
    values: dict[str, Column],
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over ``before`` rows back to ``after`` rows ahead."""
    block = max(block, before + after)
    numbered = row_numbers(df, keys, order, time_slice(df, order[0], None), "__rn")
    copies = in_blocks(numbered, keys, F.col("__rn") - 1, before, after, block)
    w = Window.partitionBy(*keys, "__block").orderBy("__rn").rowsBetween(-before, after)
    return _home_rows(copies, w, values, df.columns)


def range_frame(
    df: DataFrame,
    keys: list[str],
    ts: str,
    before: int,
    after: int,
    values: dict[str, Column],
    block: int | None = None,
) -> DataFrame:
    """Aggregates over the rows within ``before`` back to ``after`` ahead of a numeric time."""
    block = max(block or 0, before + after, 1)
    copies = in_blocks(df, keys, F.col(ts), before, after, block)
    w = Window.partitionBy(*keys, "__block").orderBy(ts).rangeBetween(-before, after)
    return _home_rows(copies, w, values, df.columns)


def _home_rows(copies: DataFrame, w, values: dict[str, Column], columns: list[str]) -> DataFrame:
    return (
        copies.select("*", *[v.over(w).alias(n) for n, v in values.items()])
        .filter(F.col("__home") == F.col("__block"))
        .select(*columns, *values)
    )
