"""Slices of a time column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.timeutil import MS_PER_DAY


def time_slice(df: DataFrame, ts: str, width: int | None) -> Column | None:
    """Slice number of a time column.

    ``width`` is in seconds for timestamps, days for dates, and in units of
    the column for numbers; the default is one day, taking long values as
    milliseconds. Zero means no slices.
    """
    if width == 0:
        return None
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_seconds(F.col(ts)) / (width or 86_400))
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(F.col(ts)) / (width or 30))
    return F.floor(F.col(ts).cast("bigint") / (width or MS_PER_DAY))
