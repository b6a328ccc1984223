"""Joins on keys with a date lag, on validity ranges, on intervals and on prefixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.dedup import row_hash
from gaugeworks.session import materialize


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lag_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    lag_col: str,
    *,
    lagging: str = "left",
    lag_days: int = 1,
    how: str = "inner",
) -> DataFrame:
    """Equal keys, and the lagging side at most ``lag_days`` before the other.

    There is no upper bound: the lagging side may be any time later. The keys
    and the lag column come from the left side, for right joins from the right.
    """
    if lagging not in ("left", "right"):
        raise ValueError(f"lagging must be left or right, not {lagging}")
    if how not in ("left", "right", "inner"):
        raise ValueError(f"join type must be left, right or inner, not {how}")
    for side in (left, right):
        if lag_col not in side.columns:
            raise ValueError(f"{lag_col} must be on both sides")
        if not isinstance(side.schema[lag_col].dataType, (T.DateType, T.TimestampType)):
            raise ValueError(f"{lag_col} must be a date or a timestamp on both sides")
    both = [*keys, lag_col]
    clash = (set(left.columns) & set(right.columns)) - set(both)
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")

    def hide(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({c: f"__other_{c}" for c in both})

    l, r = (hide(left), right) if how == "right" else (left, hide(right))
    l_date, r_date = (
        (F.col(f"__other_{lag_col}"), F.col(lag_col))
        if how == "right"
        else (F.col(lag_col), F.col(f"__other_{lag_col}"))
    )
    early, late = (l_date, r_date) if lagging == "left" else (r_date, l_date)
    on = _all([F.col(k) == F.col(f"__other_{k}") for k in keys] + [early >= F.date_sub(late, lag_days)])
    return l.join(r, on, how).drop(*[f"__other_{c}" for c in both])


def same_or_previous_day_join(
    df: DataFrame, lagging: DataFrame, keys: list[str], date_col: str, how: str = "inner"
) -> DataFrame:
    """Equal keys, and the date that of the lagging side or the day before it.

    The lagging side is doubled, one copy per allowed date, so the whole
    condition is an equality.
    """
    day = F.col(date_col)
    doubled = lagging.withColumn(date_col, F.explode(F.array(day, F.date_sub(day, 1))))
    return df.join(doubled, [*keys, date_col], how)


def range_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    at: str,
    valid_from: str,
    valid_until: str,
    open_until: Column,
    *,
    how: str = "left",
    bucket: int | None = None,
    text_keys: bool = True,
) -> DataFrame:
    """Rows of a dimension valid at the time of the fact, both ends included.

    Text keys match trimmed and in lower case. All times are numbers. With
    ``bucket`` a range is listed under the few power-of-two cells of such buckets that
    make it up (`dyadic_cells`: a hundred years of days are at most thirty), and a time
    looks in one cell of each width that occurs, so a key with many versions and many facts
    does not compare each with each. Times of facts look once, however many facts have them.
    Spark picks the joins; it broadcasts the dimension only when its measured size is
    under the threshold.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins look up ranges")
    start, end = F.col(valid_from), F.coalesce(F.col(valid_until), open_until)

    def norm(c: Column) -> Column:
        return F.trim(F.lower(c)) if text_keys else c

    keys = [f"__k{i}" for i in range(len(on))]
    d = dim.withColumns({"__from": start, "__until": end, **{k: norm(F.col(c)) for k, (_, c) in zip(keys, on)}})
    f = fact.withColumns({"__at": F.col(at), **{k: norm(F.col(c)) for k, (c, _) in zip(keys, on)}})
    valid = F.col("__at").between(F.col("__from"), F.col("__until"))
    if not bucket:
        d = d.withColumnsRenamed({k: f"__d{k}" for k in keys})
        out = f.join(d, _all([F.col(k) == F.col(f"__d{k}") for k in keys] + [valid]), how)
        return out.drop("__at", "__from", "__until", *keys, *[f"__d{k}" for k in keys])
    first, last = F.floor(F.col("__from") / bucket), F.floor(F.col("__until") / bucket)
    d = d.filter(F.col("__until") >= F.col("__from")).withColumn("__c", F.explode(dyadic_cells(first, last)))
    d = d.select("*", F.col("__c.width").alias("__width"), F.col("__c.cell").alias("__cell")).drop("__c")
    widths = d.agg(F.sort_array(F.collect_set("__width"))).scalar()
    points = f if how == "inner" else f.select(*keys, "__at").distinct()
    probes = points.filter(F.col("__at").isNotNull()).withColumn("__width", F.explode(widths))
    # the cell follows from the time and the width, so it is not shuffled with them
    cell = F.expr(f"shiftright(floor(__at / {bucket}), __width)")
    d = d.withColumnsRenamed({"__width": "__dwidth", **{k: f"__d{k}" for k in keys}})
    met = [F.col(k) == F.col(f"__d{k}") for k in keys] + [F.col("__width") == F.col("__dwidth"), cell == F.col("__cell")]
    hits = probes.join(d, _all(met)).filter(valid)
    hits = hits.drop("__width", "__dwidth", "__cell", "__from", "__until", *[f"__d{k}" for k in keys])
    if how != "inner":
        hits = f.join(hits, [*keys, "__at"], how)
    return hits.drop("__at", *keys)


def dyadic_cells(first: Column, last: Column) -> Column:
    """The cells of growing power-of-two widths that make up the buckets first to last.

    An array of (width, cell): cell number c of width w holds the buckets c * 2**w to
    (c + 1) * 2**w - 1. At most two cells of each width, none of them overlapping.
    """
    low_end, high_end = first.cast("bigint"), last.cast("bigint") + 1

    def of_width(w: Column) -> Column:
        # what is left over at this width; an odd low end and an odd high end are cells
        low = -F.call_function("shiftright", -low_end, w)
        high = F.call_function("shiftright", high_end, w)
        odd = low.bitwiseAND(1)
        return F.array(
            F.when((odd == 1) & (low < high), F.struct(w.alias("width"), low.alias("cell"))),
            F.when(
                (high.bitwiseAND(1) == 1) & (low + odd < high), F.struct(w.alias("width"), (high - 1).alias("cell"))
            ),
        )

    widest = F.floor(F.log2(F.greatest(high_end - low_end, F.lit(1)))).cast("int")
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), widest), of_width)))


def contained_join(
    runs: DataFrame,
    states: DataFrame,
    keys: list[str],
    run: tuple[str, str],
    state: tuple[str, str],
    bucket: int,
) -> DataFrame:
    """Pairs of a run and a state strictly inside it (states start after, end before).

    Buckets grow with the states: a state lies in the bucket of its start, of the
    smallest width bucket * 2**n that is not below its length. A run is listed in
    every bucket it touches, of those widths only whose states it can hold, so long
    states do not meet short runs. Only rows of the same key, width and bucket meet.
    """
    (rs, re), (ss, se) = run, state
    run_length, state_length = F.col(re) - F.col(rs), F.col(se) - F.col(ss)

    def doublings(ratio: Column) -> Column:
        """The least n with 2**n >= ratio, at least 0."""
        return F.greatest(F.ceil(F.log2(F.greatest(ratio, F.lit(1.0)))), F.lit(0)).cast("int")

    # a state of the width 2**n is longer than half of that, and the run is longer still
    most = doublings(run_length / bucket)
    width = F.lit(bucket).cast("bigint") * F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__width"))
    listed = (
        runs.filter(run_length >= 0)
        .withColumn("__width", F.explode(F.sequence(F.lit(0), most)))
        .withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(rs) / width), F.floor(F.col(re) / width))))
    )
    placed = states.withColumn("__width", doublings(state_length / bucket)).withColumn(
        "__bucket", F.floor(F.col(ss) / width)
    )
    return (
        listed.join(placed, [*keys, "__width", "__bucket"])
        .filter((F.col(ss) > F.col(rs)) & (F.col(se) < F.col(re)))
        .drop("__width", "__bucket")
    )


def missing_from(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the other frame does not have."""
    return df.join(other.select(*keys), keys, "left_anti")


def present_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the other frame has; no row is multiplied."""
    return df.join(other.select(*keys), keys, "left_semi")


def prefix_join(
    df: DataFrame, path: str, prefixes: DataFrame, prefix: str
) -> DataFrame:
    """Left join on ``path`` starting with ``prefix``, as an equality join.

    Each distinct path is cut to the lengths that occur among the prefixes (a
    list no longer than the longest path), and the cuts are matched by value.
    """
    lengths = prefixes.agg(F.collect_set(F.length(prefix))).scalar()
    cuts = (
        df.select(F.col(path).alias("__path"))
        .filter(F.col(path).isNotNull())
        .distinct()
        .withColumn("__n", F.explode(lengths))
        .filter(F.length("__path") >= F.col("__n"))
        .withColumn("__cut", F.expr("substring(__path, 1, __n)"))
    )
    hits = cuts.join(prefixes, F.col("__cut") == F.col(prefix)).drop("__n", "__cut")
    return df.join(hits, F.col(path) == F.col("__path"), "left").drop("__path")


def salted_join(
    big: DataFrame,
    unique: DataFrame,
    keys: list[str],
    rows_per_part: int = 1_000_000,
    how: str = "left",
    most_hot: int = 1_000,
) -> DataFrame:
    """Join a frame with hot keys to one that has a row per key; only hot keys are salted.

    The keys with most rows are counted first, by partial aggregation of the key columns. Those with more than
    ``rows_per_part`` rows (at most ``most_hot`` keys, which are sent to all tasks) are cut
    into as many parts as they need by a hash of the whole row, and only their rows
    of the unique side are repeated, once for each part. All other rows take the plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins keep a row per big row")
    parts = F.ceil(F.col("n") / F.lit(rows_per_part)).cast("bigint")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hot = hot_keys(big.filter(known), keys, most_hot).filter(F.col("n") > rows_per_part)
    hot = F.broadcast(materialize(hot.select(*keys, parts.alias("__parts")), "hot-keys"))
    # rows without a key match nothing; they are spread too
    salt = F.pmod(row_hash(big), F.when(known, F.coalesce("__parts", F.lit(1))).otherwise(1 << 16))
    spread = big.join(hot, keys, "left").withColumn("__salt", salt).drop("__parts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("__parts", F.lit(1)) - 1)
    repeated = unique.join(hot, keys, "left").withColumn("__salt", F.explode(copies)).drop("__parts")
    return spread.join(repeated, [*keys, "__salt"], how).drop("__salt")


def hot_keys(df: DataFrame, keys: list[str], k: int = 40) -> DataFrame:
    """The k keys with the most rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), *[F.col(c) for c in keys])
        .limit(k)
    )
