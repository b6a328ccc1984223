"""Column expressions for epoch values, timestamps, ticks and run times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_DAY = 86_400_000


def to_ts(raw: Column, resolution: str = "milli", result: T.DataType | None = None) -> Column:
    """Epoch number to timestamp or date, cut to whole seconds."""
    result = result or T.TimestampType()
    if not isinstance(result, (T.TimestampType, T.DateType)):
        raise ValueError(f"result must be a timestamp or a date, not {result.simpleString()}")
    number = raw.cast("double")
    seconds = F.floor(number / 1000 if resolution == "milli" else number)
    return F.timestamp_seconds(seconds).cast(result)


def epoch_milli_to_ts(raw: Column) -> Column:
    """Epoch milliseconds, number or text, to timestamp; text that is no number gives null."""
    return F.timestamp_millis(raw.try_cast("bigint"))


def ts_to_epoch_milli(text: Column) -> Column:
    """Timestamp text to epoch milliseconds (double).

    The milliseconds are the three characters before the last one.
    """
    seconds = F.unix_seconds(text.try_cast("timestamp"))
    millis = F.substring(text, -4, 3).try_cast("double")
    return (seconds + millis / 1000) * 1000


def string_ts_to_unix_millis(text: Column) -> Column:
    """ISO text with milliseconds and zone letter to epoch milliseconds, else null."""
    seconds = F.unix_seconds(text.try_cast("timestamp"))
    return (seconds * 1000 + F.substring(text, -4, 3).try_cast("bigint")).cast("bigint")


def run_time(start: Column, end: Column, resolution: str = "milli") -> Column:
    """Struct with both instants and their distance in ms, s, min and h."""
    ms = end - start
    return F.struct(
        start.alias("startEpochMS"),
        to_ts(start, resolution).alias("startTS"),
        end.alias("endEpochMS"),
        to_ts(end, resolution).alias("endTS"),
        ms.alias("runTimeMS"),
        (ms / 1000).alias("runTimeS"),
        (ms / 1000 / 60).alias("runTimeM"),
        (ms / 1000 / 60 / 60).alias("runTimeH"),
    )


def add_ticks(value: Column, n: int, kind: T.DataType) -> Column:
    """Move a value by n of the smallest steps of its type."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.unix_micros(value) + F.lit(n * 1000))
    if isinstance(kind, T.DateType):
        return F.date_add(value, n)
    if isinstance(kind, T.DoubleType):
        return value + F.lit(n / 1000.0)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return value + F.lit(n).cast(kind)
    raise ValueError(f"no ticks are defined for {kind.simpleString()}")


def subtract_ticks(value: Column, n: int, kind: T.DataType) -> Column:
    return add_ticks(value, -n, kind)


def date_series(first: Column, last_exclusive: Column) -> Column:
    """Array of the days in [first, last)."""
    last = F.date_sub(last_exclusive, 1)
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def days_between(first: dt.date, last_exclusive: dt.date) -> list[dt.date]:
    """The days of a half-open range, for building path lists."""
    return [first + dt.timedelta(days=i) for i in range((last_exclusive - first).days)]


def epoch_ms(instant: dt.datetime) -> int:
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=dt.timezone.utc)
    return round(instant.timestamp() * 1000)


def day_of_ms(ms: Column) -> Column:
    """Day number of an epoch-millisecond value; the usual slice of the ordered operators."""
    return F.floor(ms / MS_PER_DAY)


def with_run_time(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    return df.withColumn(name, run_time(F.col(start), F.col(end)))
