"""Keep one row per key, latest snapshots, duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.scan import row_numbers


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, as a last tie order that a repeated task finds again."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        plain = isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)
        parts.append(c if plain else F.to_json(F.struct(c)))
    return F.xxhash64(*parts)


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key in the given order; ties go by the hash of the row.

    Spark cuts every map task's rows down to one per key before the shuffle,
    so a key with many copies does not load one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order, row_hash(df))
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tie: list[str] | None = None) -> DataFrame:
    return keep_first(df, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in tie or []]])


def latest_snapshot(df: DataFrame, tenant: list[str], ts: str) -> DataFrame:
    """All rows of the newest snapshot of each tenant.

    A window would gather a tenant in one task; the newest time per tenant is
    a small aggregate, joined back on equality.
    """
    newest = df.groupBy(*tenant).agg(F.max(ts).alias(ts))
    return df.join(newest, [*tenant, ts], "left_semi")


def duplicates(df: DataFrame, keys: list[str], order: list[str], slice_by: Column) -> DataFrame:
    """All rows but the first of every key, numbered.

    Keys are counted first, so only rows of repeated keys are ordered; those
    of one key are numbered slice by slice.
    """
    repeated = df.groupBy(*keys).count().filter("count > 1").drop("count")
    surplus = df.join(repeated, keys, "left_semi")
    return row_numbers(surplus, keys, order, slice_by).filter(F.col("rn") > 1)


def drop_duplicate_keys(df: DataFrame, keys: list[str], order: list[Column | str]) -> tuple[DataFrame, DataFrame]:
    """The rows to keep, and a one-row report of how many go."""
    report = (
        df.groupBy(*keys)
        .count()
        .agg(
            F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("rows_before"),
            F.count(F.lit(1)).alias("rows_kept"),
        )
        .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_kept"))
    )
    return keep_first(df, keys, order), report
