"""Explicit evaluation time. No operator reads the wall clock unless it is given no ``as_of``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = Column | datetime | str | None


def instant(as_of: AsOf = None, dtype: T.DataType | None = None) -> Column:
    """``as_of`` as a timestamp column of ``dtype``; naive datetimes and strings are UTC.

    Literals are cast to the type of the column they will be compared with, never the other way
    round, so that the comparison still reaches the parquet scan.
    """
    dtype = dtype or T.TimestampType()
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        now = F.current_timestamp()
        return now if isinstance(dtype, T.TimestampType) else now.cast(dtype)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    text = as_of.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        text += "+00:00"
    return F.lit(text).cast(dtype)


def instant_like(df: DataFrame, column: str, as_of: AsOf = None) -> Column:
    return instant(as_of, df.schema[column].dataType)


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def minutes_between(earlier: Column, later: Column) -> Column:
    """Elapsed minutes at whole-second precision."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)


def trailing(at: Column, now: Column, n_days: int) -> Column:
    """True inside the last ``n_days`` up to ``now``, both bounds included: what comes later isn't known yet."""
    return at.between(now - days(n_days), now)
