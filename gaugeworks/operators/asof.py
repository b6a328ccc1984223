"""As-of lookup and as-of join of two time series."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.dedup import row_hash
from gaugeworks.operators.fill import nearest
from gaugeworks.operators.frames import BLOCK_ROWS, in_blocks, range_frame, rows_frame
from gaugeworks.operators.scan import Running, ordered_scan
from gaugeworks.operators.slices import time_slice

UNBOUNDED = -1
_SIDE = "__side"
_SEQ = "__seq"
_RN = "__rn"

TIME_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.TimestampType, T.DateType)


class TimeSeries:
    """A frame with its time column and its key columns."""

    def __init__(self, df: DataFrame, ts: str, keys: list[str]):
        missing = [c for c in [ts, *keys] if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in the frame: {', '.join(missing)}")
        if not isinstance(df.schema[ts].dataType, TIME_TYPES):
            raise ValueError(f"type {df.schema[ts].dataType.simpleString()} of {ts} cannot order a series")
        self.df, self.ts, self.keys = df, ts, list(keys)

    @property
    def observations(self) -> list[str]:
        return [c for c in self.df.columns if c != self.ts and c not in self.keys]

    def rows_frame(self, before: int, after: int, values: dict[str, Column], tie: list[str] | None = None) -> DataFrame:
        """Aggregates over so many rows before and after each row."""
        return rows_frame(self.df, self.keys, [self.ts, *(tie or [])], before, after, values)

    def range_frame(self, before: int, after: int, values: dict[str, Column]) -> DataFrame:
        """Aggregates over the rows within a distance in time."""
        return range_frame(self.df, self.keys, self.ts, before, after, values)

    def lookup(self, right: "TimeSeries", **options) -> "TimeSeries":
        return TimeSeries(asof_lookup(self, right, **options), self.ts, self.keys)

    def join(self, right: "TimeSeries", **options) -> "TimeSeries":
        return TimeSeries(asof_join(self, right, **options), self.ts, self.keys)


def _merged(left: TimeSeries, right: TimeSeries, prefix: str, tie_break: list[str]) -> DataFrame:
    """Both series as one stream; a left row comes before a right row of the same time."""
    if len(left.keys) != len(right.keys):
        raise ValueError("both series need the same number of keys")
    lefts = left.df.select("*", F.lit(0).alias(_SIDE))
    seq = F.xxhash64(*tie_break) if tie_break else row_hash(right.df)
    rights = right.df.select(
        F.col(right.ts).cast(left.df.schema[left.ts].dataType).alias(left.ts),
        *[
            F.col(rk).cast(left.df.schema[lk].dataType).alias(lk)
            for lk, rk in zip(left.keys, right.keys)
        ],
        *[F.col(c).alias(prefix + c) for c in right.observations],
        F.col(right.ts).alias(prefix + right.ts),
        F.lit(1).alias(_SIDE),
        seq.alias(_SEQ),
    )
    return lefts.unionByName(rights, allowMissingColumns=True)


def _fill_right(
    merged: DataFrame,
    left: TimeSeries,
    right_cols: list[str],
    look_back: int,
    look_ahead: int,
    slice_width: int | None,
    left_order: list[str] | None,
) -> DataFrame:
    order = [left.ts, _SIDE, *(left_order or []), _SEQ]
    by = time_slice(merged, left.ts, slice_width)
    if look_back > 0 or look_ahead > 1:
        return _fill_right_near(merged, left, right_cols, look_back, look_ahead, order, by)

    running: list[Running] = []
    if look_back == UNBOUNDED:
        running += [Running(f"__b_{c}", "last", c) for c in right_cols]
    if look_ahead == UNBOUNDED:
        running += [Running(f"__a_{c}", "first", c) for c in right_cols]
    elif look_ahead == 1:
        # the next row counts as a whole, so its columns travel together
        running.append(Running("__next_row", "lead", F.struct(*right_cols)))
    filled = ordered_scan(merged, left.keys, order, running, by) if running else merged

    def looked_up(c: str) -> Column:
        found = [F.col(c)]
        if look_back == UNBOUNDED:
            found.append(F.col(f"__b_{c}"))
        if look_ahead == UNBOUNDED:
            found.append(F.col(f"__a_{c}"))
        elif look_ahead == 1:
            found.append(F.col("__next_row")[c])
        return F.coalesce(*found)

    return filled.withColumns({c: looked_up(c) for c in right_cols})


def _fill_right_near(
    merged: DataFrame,
    left: TimeSeries,
    right_cols: list[str],
    look_back: int,
    look_ahead: int,
    order: list[str],
    by: Column | None,
) -> DataFrame:
    """Limits count rows of the merged stream, so every row gets its number first."""
    unlimited = [k for k, n in (("last", look_back), ("first", look_ahead)) if n == UNBOUNDED]
    running = [Running(f"__{k}_{c}", k, F.col(c)) for k in unlimited for c in right_cols]
    numbered = ordered_scan(
        merged, left.keys, order, [Running(_RN, "sum", F.lit(1).cast("bigint")), *running], by
    )
    back, ahead = max(look_back, 0), max(look_ahead, 0)
    copies = in_blocks(numbered, left.keys, F.col(_RN), back, ahead, max(BLOCK_ROWS, back + ahead))

    def side(c: str, kind: str, limit: int) -> Column:
        if limit == UNBOUNDED:
            return F.col(f"__{kind}_{c}")
        return nearest(F.col(c), kind, left.keys, limit, False)

    filled = {
        c: F.coalesce(F.col(c), side(c, "last", look_back), side(c, "first", look_ahead))
        for c in right_cols
    }
    others = [c for c in copies.columns if c not in filled]
    return copies.select(*others, *[v.alias(c) for c, v in filled.items()]).filter(
        F.col("__home") == F.col("__block")
    )


def asof_lookup(
    left: TimeSeries,
    right: TimeSeries,
    *,
    look_back: int = UNBOUNDED,
    look_ahead: int = 0,
    slice_width: int | None = None,
    tie_break: list[str] | None = None,
    left_order: list[str] | None = None,
) -> DataFrame:
    """Left rows with, per right column, its last non-null value from earlier rows.

    What is not found is taken from the first later row within ``look_ahead``
    rows. Limits count rows of the merged stream; -1 is unbounded. A right row
    of the same time as a left row comes after it. A column on both sides
    keeps the left value where there is one. ``tie_break`` names right columns
    whose hash orders right rows of the same time (all of them unless named), ``left_order`` left columns that
    order left rows of the same time, which matters for limits only.
    """
    prefix = "__r_"
    merged = _merged(left, right, prefix, tie_break or [])
    right_obs = right.observations
    filled = _fill_right(
        merged, left, [prefix + c for c in right_obs], look_back, look_ahead, slice_width, left_order
    ).filter(F.col(_SIDE) == 0)
    both = [c for c in left.observations if c in right_obs]
    return filled.select(
        left.ts,
        *left.keys,
        *[F.col(c) for c in left.observations if c not in both],
        *[F.col(prefix + c).alias(c) for c in right_obs if c not in both],
        *[F.coalesce(F.col(c), F.col(prefix + c)).alias(c) for c in both],
    )


def asof_join(
    left: TimeSeries,
    right: TimeSeries,
    *,
    left_prefix: str = "",
    right_prefix: str = "right_",
    look_back: int = UNBOUNDED,
    look_ahead: int = 0,
    slice_width: int | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The merged stream of both sides, with the right columns filled as in the lookup.

    Right rows stay; their left columns are null and their time is the time
    of the right row. Both sides must have the same keys.
    """
    if left.keys != right.keys:
        raise ValueError("both series need the same keys")
    if left_prefix:
        renamed = left.df.select(
            *left.keys,
            F.col(left.ts).alias(left_prefix + left.ts),
            *[F.col(c).alias(left_prefix + c) for c in left.observations],
        )
        left = TimeSeries(renamed, left_prefix + left.ts, left.keys)
    merged = _merged(left, right, right_prefix, tie_break or [])
    right_cols = [right_prefix + c for c in [*right.observations, right.ts]]
    filled = _fill_right(merged, left, right_cols, look_back, look_ahead, slice_width, None)
    return filled.select(left.ts, *left.keys, *left.observations, *right_cols)


@dataclass(frozen=True)
class Lookup:
    """One right side of `asof_lookups`: its series, the time of the left rows, and how far to look.

    ``at`` names another time column of the left rows than that of their series. Looks
    back are unbounded or none, looks ahead none, one row or unbounded; rows are those of the
    left side and this right side, as if the others were not there. ``order`` names right
    columns that order right rows of the same time in place of a hash; they are not looked up.
    """

    right: TimeSeries
    at: str | None = None
    look_back: int = UNBOUNDED
    look_ahead: int = 0
    tie_break: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    @property
    def values(self) -> list[str]:
        return [c for c in self.right.observations if c not in self.order]


def asof_lookups(
    left: TimeSeries,
    lookups: list[Lookup],
    *,
    slice_width: int | None = None,
    left_order: list[str] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Several as-of lookups in one ordered scan of the merged stream of all sides.

    Gives, by time column of the left rows, what chained calls of `asof_lookup`
    give: of columns that several sides have, the left value counts first, then
    that of the earlier lookup. All frames come from the same scan, which ``store``
    writes once; it is of use where the left rows have several times. All sides are read
    twice and must have the same number of keys.
    """
    for u in lookups:
        if u.look_back not in (UNBOUNDED, 0) or u.look_ahead not in (UNBOUNDED, 0, 1):
            raise ValueError("lookups with limits go one by one, with asof_lookup")
        if len(u.right.keys) != len(left.keys):
            raise ValueError("all series need the same number of keys")
    scan = _scan_of_lookups(left, lookups, slice_width, left_order or [])
    scan = scan.filter(F.col(_SIDE) == 0) if store is None else store(scan.filter(F.col(_SIDE) == 0))
    return {at: _looked_up(scan, left, lookups, at) for at in _times(left, lookups)}


_TIME, _EVENT = "__time", "__event"


def _times(left: TimeSeries, lookups: list[Lookup]) -> list[str]:
    return list(dict.fromkeys(u.at or left.ts for u in lookups))


def _scan_of_lookups(left: TimeSeries, lookups: list[Lookup], slice_width: int | None, left_order: list[str]) -> DataFrame:
    """Left rows once for each of their times, right rows of all sides, and their running values."""
    times = _times(left, lookups)
    events = [F.struct(F.lit(e).alias("e"), F.col(at).alias("at")) for e, at in enumerate(times)]
    merged = left.df.withColumn(_EVENT, F.explode(F.array(*events)))
    merged = merged.select(*left.df.columns, F.col(f"{_EVENT}.e").alias(_EVENT), F.col(f"{_EVENT}.at").alias(_TIME), F.lit(0).alias(_SIDE))
    kind = merged.schema[_TIME].dataType
    running: list[Running] = []
    for i, u in enumerate(lookups):
        right, cols = u.right, u.values
        seq = F.xxhash64(*u.tie_break) if u.tie_break else F.lit(None).cast("bigint") if u.order else row_hash(right.df)
        rows = right.df.select(
            F.col(right.ts).cast(kind).alias(_TIME),
            *[F.col(rk).cast(left.df.schema[lk].dataType).alias(lk) for lk, rk in zip(left.keys, right.keys)],
            *[F.col(c).alias(f"__r{i}_{c}") for c in cols],
            F.lit(i + 1).alias(_SIDE),
            seq.alias(_SEQ),
            *[F.col(c).alias(f"__o{i}_{c}") for c in u.order],
        )
        merged = merged.unionByName(rows, allowMissingColumns=True)
        if u.look_back == UNBOUNDED:
            running += [Running(f"__b{i}_{c}", "last", f"__r{i}_{c}") for c in cols]
        if u.look_ahead == UNBOUNDED:
            running += [Running(f"__a{i}_{c}", "first", f"__r{i}_{c}") for c in cols]
        elif u.look_ahead == 1:
            # the next row of both sides counts as a whole, also if it is a left one
            event = times.index(u.at or left.ts)
            own = (F.col(_SIDE) == i + 1) | ((F.col(_SIDE) == 0) & (F.col(_EVENT) == event))
            running.append(Running(f"__n{i}", "first", F.when(own, F.struct(*[f"__r{i}_{c}" for c in cols])), True))
    orders = [f"__o{i}_{c}" for i, u in enumerate(lookups) for c in u.order]
    order = [_TIME, _SIDE, *left_order, _SEQ, *orders]
    scanned = ordered_scan(merged, left.keys, order, running, time_slice(merged, _TIME, slice_width))
    return scanned.drop(*orders, *[f"__r{i}_{c}" for i, u in enumerate(lookups) for c in u.values])


def _looked_up(scan: DataFrame, left: TimeSeries, lookups: list[Lookup], at: str) -> DataFrame:
    found: dict[str, list[Column]] = {}
    for i, u in enumerate(lookups):
        if (u.at or left.ts) != at:
            continue
        for c in u.values:
            sources = found.setdefault(c, [F.col(c)] if c in left.df.columns else [])
            if u.look_back == UNBOUNDED:
                sources.append(F.col(f"__b{i}_{c}"))
            if u.look_ahead == UNBOUNDED:
                sources.append(F.col(f"__a{i}_{c}"))
            elif u.look_ahead == 1:
                sources.append(F.col(f"__n{i}")[f"__r{i}_{c}"])
    rows = scan.filter(F.col(_EVENT) == _times(left, lookups).index(at))
    plain = [F.col(c) for c in left.df.columns if c not in found]
    return rows.select(*plain, *[F.coalesce(*v, F.lit(None)).alias(c) for c, v in found.items()])
