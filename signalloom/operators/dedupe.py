"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], newest: str | Column, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest ``newest`` per key; equal rows go to the highest tie breaker.

    Null keys form a group of their own. Spark ranks before and after the shuffle
    (``WindowGroupLimit``), so a task sends at most one row per key however hot the key is.
    """
    newest = F.col(newest) if isinstance(newest, str) else newest
    order = [newest.desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_breakers]]
    # Sorting compares the hash first and seldom has to look at the keys themselves.
    position = F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def without_retries(
    df: DataFrame,
    business_key: Sequence[str] = ("cart_id", "event_type", "event_timestamp"),
    row_key: str = "event_id",
    newest: str = "producer_ingested_at",
) -> DataFrame:
    """One row per business key where its first column is set, one per ``row_key`` elsewhere.

    A producer that retries emits the same action under a new ``row_key``. Both kinds of row are
    handled by one window over a computed key, hence one shuffle.
    """
    has_key = F.col(business_key[0]).isNotNull()
    keys = [F.when(has_key, F.col(c)) for c in business_key]
    return latest_per_key(df, [*keys, F.when(~has_key, F.col(row_key))], newest, [row_key])


def without_retries_by_branch(
    df: DataFrame,
    business_key: Sequence[str] = ("cart_id", "event_type", "event_timestamp"),
    row_key: str = "event_id",
    newest: str = "producer_ingested_at",
) -> DataFrame:
    """Same rows as ``without_retries``, as two branches joined by a union by name."""
    has_key = F.col(business_key[0]).isNotNull()
    keyed = latest_per_key(df.where(has_key), business_key, newest, [row_key])
    return keyed.unionByName(latest_per_key(df.where(~has_key), [row_key], newest))
