"""Filling gaps of a column from neighbouring rows of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.frames import BLOCK_ROWS, in_blocks
from gaugeworks.operators.scan import Running, ordered_scan, row_numbers
from gaugeworks.session import materialize

_RN = "__rn"


def fill_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, list[Column]],
    slice_by: Column | None,
    own_first: bool = True,
) -> DataFrame:
    """Last known value of each column, then of its lookups in turn.

    With lookups and ``own_first=False`` the column itself is left out.
    """
    running, choices = [], {}
    for name, lookups in columns.items():
        sources = [name, *lookups] if own_first or not lookups else lookups
        names = [f"__f_{name}_{i}" for i in range(len(sources))]
        running += [Running(n, "last", s) for n, s in zip(names, sources)]
        choices[name] = F.coalesce(*names)
    return (
        ordered_scan(df, keys, order, running, slice_by)
        .withColumns(choices)
        .drop(*[r.name for r in running])
    )


def fill_both_ways(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, list[Column]],
    slice_by: Column | None,
) -> DataFrame:
    """The value, else the last earlier one, else the first later one.

    With lookups: the value, else the last earlier value of each lookup, else
    the first later value of each lookup.
    """
    running, choices = [], {}
    for name, lookups in columns.items():
        sources = lookups or [name]
        before = [f"__f_{name}_{i}" for i in range(len(sources))]
        after = [f"__b_{name}_{i}" for i in range(len(sources))]
        running += [Running(n, "last", s) for n, s in zip(before, sources)]
        running += [Running(n, "first", s) for n, s in zip(after, sources)]
        choices[name] = F.coalesce(F.col(name), *before, *after)
    return (
        ordered_scan(df, keys, order, running, slice_by)
        .withColumns(choices)
        .drop(*[r.name for r in running])
    )


def fill_meta(
    df: DataFrame, fields: list[str], keys: list[str], order: list[str], slice_by: Column | None
) -> DataFrame:
    """Fill descriptive fields both ways; the result does not depend on chance."""
    return fill_both_ways(df, keys, order, {f: [] for f in fields}, slice_by)


def near_value(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, tuple[str, str]],
    slice_by: Column | None,
    within: int | None = None,
    exclusive: bool = False,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Nearest known value at most ``within`` rows away (None: at any distance).

    ``columns`` maps an output name to a source column and a side: ``first``
    looks at the row and later ones, ``last`` at the row and earlier ones. A
    frame of that many rows costs rows times frame; here each value travels
    with its row number instead, within blocks of rows.
    """
    if within is None:
        running = [Running(out, kind, src, exclusive) for out, (src, kind) in columns.items()]
        return ordered_scan(df, keys, order, running, slice_by)
    numbered = row_numbers(df, keys, order, slice_by, _RN)
    sides = {kind for _, kind in columns.values()}
    back, ahead = (within if k in sides else 0 for k in ("last", "first"))
    copies = in_blocks(numbered, keys, F.col(_RN), back, ahead, max(block, within))
    hits = {
        out: nearest(F.col(src), kind, keys, within, exclusive) for out, (src, kind) in columns.items()
    }
    found = copies.select("*", *[c.alias(f"__n_{out}") for out, c in hits.items()])
    return found.filter(F.col("__home") == F.col("__block")).select(
        *[c for c in df.columns if c not in columns], *[F.col(f"__n_{out}").alias(out) for out in columns]
    )


def nearest(value: Column, kind: str, keys: list[str], within: int, exclusive: bool) -> Column:
    """Nearest known value at most ``within`` rows away, in frames cut into blocks."""
    number = F.col(_RN)
    w = Window.partitionBy(*keys, "__block").orderBy(number.desc() if kind == "first" else number.asc())
    w = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    marked = F.when(value.isNotNull(), F.struct(value.alias("v"), number.alias("rn")))
    hit = F.last(marked, ignorenulls=True).over(w)
    return F.when(F.abs(hit["rn"] - number) <= within, hit["v"])


def fill_from_groups(df: DataFrame, column: str, groupings: list[list[str]]) -> DataFrame:
    """Fill nulls from other rows of the same group, trying one grouping after the other.

    Takes the smallest known value of a group, so the outcome is fixed. The
    values are aggregated per group and joined back; a group of any size costs
    no more than its rows. The values of all groupings but the last are written,
    as the next ones would compute them again, each twice as often.
    """
    for i, keys in enumerate(groupings):
        known = (
            df.filter(F.col(column).isNotNull())
            .groupBy(*[F.col(k).alias(f"__k{j}") for j, k in enumerate(keys)])
            .agg(F.min(column).alias(f"__known{i}"))
        )
        if i < len(groupings) - 1:
            known = materialize(known, "known")
        match = F.lit(True)
        for j, k in enumerate(keys):
            match = match & F.col(k).eqNullSafe(F.col(f"__k{j}"))
        df = (
            df.join(known, match, "left")
            .withColumn(column, F.coalesce(F.col(column), F.col(f"__known{i}")))
            .drop(f"__known{i}", *[f"__k{j}" for j in range(len(keys))])
        )
    return df


def merge_settings(
    df: DataFrame,
    fields: dict[str, str],
    keys: list[str],
    order: list[str],
    slice_by: Column | None,
    action: str = "actionName",
    new_settings: str = "new_settings",
    removed: str = "fields_to_remove",
    snapshot: str | None = "lookup_settings",
) -> DataFrame:
    """Settings as they stand after each record.

    ``fields`` maps columns to their JSON names. A field takes its value from
    the record's new settings, then from the record itself, then from the last
    earlier record, then from the snapshot settings. An update that lists the
    field as removed resets it to its new setting.
    """
    running, out = [], {}
    for name, json_name in fields.items():
        kind = df.schema[name].dataType

        def setting(source: str) -> Column:
            return F.get_json_object(F.col(source), f"$.{json_name}").try_cast(kind)

        fresh = setting(new_settings)
        running.append(Running(f"__s_{name}", "last", F.coalesce(fresh, F.col(name))))
        filled = [F.col(f"__s_{name}")]
        if snapshot:
            running.append(Running(f"__p_{name}", "last", setting(snapshot)))
            filled.append(F.col(f"__p_{name}"))
        listed = F.array_contains(
            F.from_json(F.col(removed), T.ArrayType(T.StringType())), json_name
        )
        reset = (F.col(action) == "update") & F.coalesce(listed, F.lit(False))
        out[name] = F.when(reset, fresh).otherwise(F.coalesce(*filled))
    return (
        ordered_scan(df, keys, order, running, slice_by)
        .withColumns(out)
        .drop(*[r.name for r in running])
    )
