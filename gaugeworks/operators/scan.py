"""Ordered running values that hold up under hot keys.

A window over a whole key puts all rows of that key into one task. Here a key
with many rows is cut into slices along its order (a day, an hour, a number
range). Each slice is summarised with ordinary partial aggregation, the few
summaries of a key are combined in order, and the result enters each slice as
one extra row before its first row (and one after its last). The row window then
runs per (key, slice), so no task sees more than one slice, and the result is
exactly that of the window over the whole key. Keys are counted first; one of
few rows is a single slice and needs no summaries.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
POS = "__pos"
# A key of more rows is cut into slices.
WHOLE_KEY_ROWS = 20_000
_CUT = "__cut"


@dataclass(frozen=True)
class Running:
    """One running value.

    kind ``last`` / ``first`` take the nearest non-null value at or before /
    at or after the row, ``sum`` and ``max`` accumulate up to the row. With
    ``exclusive`` the row itself is left out. ``lag`` and ``lead`` are the
    values of the neighbouring row, null or not. A value given by name is that column
    itself, which then travels once; not for ``lag`` and ``lead``.
    """

    name: str
    kind: str
    value: Column | str
    exclusive: bool = False


def _lowered(spec: Running) -> Running:
    # a struct is never null, so the neighbour's null value is kept too
    if spec.kind == "lag":
        return Running(spec.name, "last", F.struct(spec.value.alias("v")), True)
    if spec.kind == "lead":
        return Running(spec.name, "first", F.struct(spec.value.alias("v")), True)
    return spec


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    running: list[Running],
    slice_by: Column | None,
    whole_key_rows: int = WHOLE_KEY_ROWS,
) -> DataFrame:
    """Add running values per key in the given order.

    ``order`` must be a total order within a key (end it with an id), and
    ``slice_by`` must grow with the first order column. Without ``slice_by``
    the window runs over whole keys; use that only for keys known to be small.
    Keys of at most ``whole_key_rows`` rows are not cut.
    """
    specs = [_lowered(s) for s in running]
    inputs = [f"__in{i}" for i in range(len(specs))]
    payload = df.columns
    # a column that is a value itself, and no key or order, is not carried beside it
    own = {s.value: c for s, c in zip(specs, inputs) if isinstance(s.value, str) and s.value not in [*keys, *order]}
    specs = [replace(s, value=F.col(f"`{s.value}`")) if isinstance(s.value, str) else s for s in specs]
    cut = F.lit(True)
    if slice_by is not None and keys:
        df = _mark_large_keys(df, keys, whole_key_rows)
        cut = F.col(_CUT)
    rows = df.select(
        *[F.col(f"`{c}`") for c in payload if c not in own],
        cut.alias(_CUT),
        (F.lit(0) if slice_by is None else F.when(cut, slice_by)).alias(SLICE),
        F.lit(0).alias(POS),
        *[s.value.alias(c) for s, c in zip(specs, inputs)],
    )

    if slice_by is not None:
        rows = rows.unionByName(
            _edge_rows(rows.filter(_CUT), keys, order, specs, inputs).withColumn(_CUT, F.lit(True)), allowMissingColumns=True
        )

    # a slice of a cut key may be null itself, so the mark belongs to the partition
    part = Window.partitionBy(*keys, _CUT, SLICE)
    up = part.orderBy(F.col(POS).asc(), *[F.col(c).asc() for c in order])
    # a frame up to the last row costs quadratic time; the reversed order does not
    down = part.orderBy(F.col(POS).desc(), *[F.col(c).desc() for c in order])

    outputs = []
    for i, (spec, c) in enumerate(zip(specs, inputs)):
        end = -1 if spec.exclusive else Window.currentRow
        w = (down if spec.kind == "first" else up).rowsBetween(Window.unboundedPreceding, end)
        if spec.kind in ("last", "first"):
            out = F.last(c, ignorenulls=True).over(w)
        elif spec.kind == "sum":
            out = F.sum(c).over(w)
        elif spec.kind == "max":
            out = F.max(c).over(w)
        else:
            raise ValueError(f"unknown running value {spec.kind}")
        outputs.append(out.alias(f"__out{i}"))
    scanned = rows.select("*", *outputs).filter(F.col(POS) == 0)

    def result(i: int) -> Column:
        out = F.col(f"__out{i}")
        return (out["v"] if running[i].kind in ("lag", "lead") else out).alias(running[i].name)

    names = {s.name for s in running}
    return scanned.select(
        *[F.col(own[c]).alias(c) if c in own else F.col(f"`{c}`") for c in payload if c not in names],
        *[result(i) for i in range(len(running))],
    )


def _mark_large_keys(df: DataFrame, keys: list[str], whole_key_rows: int) -> DataFrame:
    """Rows with a mark whether their key has more rows than may stay together.

    There are few such keys, at most one for so many rows of the input. Where there are
    none, adaptive execution drops the join and all that is made of marked rows.
    """
    counted = df.groupBy(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]).count()
    large = counted.filter(F.col("count") > whole_key_rows).drop("count").withColumn(_CUT, F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    marked = df.join(F.broadcast(large), same, "left")
    return marked.withColumn(_CUT, F.col(_CUT).isNotNull())


def _edge_rows(
    rows: DataFrame, keys: list[str], order: list[str], specs: list[Running], inputs: list[str]
) -> DataFrame:
    """Per slice one row with the values from before it and one with those from after it."""
    rank = F.struct(*order)
    aggs = []
    for spec, c in zip(specs, inputs):
        present = F.when(F.col(c).isNotNull(), rank)
        if spec.kind == "last":
            aggs.append(F.max_by(c, present).alias(c))
        elif spec.kind == "first":
            aggs.append(F.min_by(c, present).alias(c))
        elif spec.kind == "sum":
            aggs.append(F.sum(c).alias(c))
        else:
            aggs.append(F.max(c).alias(c))
    summary = rows.groupBy(*keys, SLICE).agg(*aggs)

    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(F.col(SLICE).asc()).rowsBetween(Window.unboundedPreceding, -1)
    later = per_key.orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)

    def carried(kind_is_first: bool) -> list[Column]:
        cols = []
        for spec, c in zip(specs, inputs):
            if (spec.kind == "first") != kind_is_first:
                continue
            w = later if kind_is_first else earlier
            fn = {"sum": F.sum, "max": F.max}.get(spec.kind)
            value = fn(c).over(w) if fn else F.last(c, ignorenulls=True).over(w)
            cols.append(value.alias(c))
        return cols

    before, after = carried(False), carried(True)
    edges = None
    for pos, cols in ((-1, before), (1, after)):
        if not cols:
            continue
        edge = summary.select(*keys, SLICE, F.lit(pos).alias(POS), *cols)
        edges = edge if edges is None else edges.unionByName(edge, allowMissingColumns=True)
    return edges


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], slice_by: Column | None, name: str = "rn"
) -> DataFrame:
    """1-based row number within the key."""
    return ordered_scan(df, keys, order, [Running(name, "sum", F.lit(1).cast("bigint"))], slice_by)
