"""Quantile sketches kept per day, and quantiles of any span of days out of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.sinks.tables import upsert

#: Size of a sketch. Its bytes grow with it and with the logarithm of the rows, its error falls about as fast.
K = 2048


def rank_error(k: int = K) -> float:
    """How far the rank of an answer may be off, as a share of the rows, in 99 of 100 cases."""
    return 2.296 / k**0.9021


def sketched(df: DataFrame, value: str, by: Sequence[str], k: int = K) -> DataFrame:
    """One row per group with ``n_values``, ``least``, ``most`` and the KLL ``sketch`` of its values.

    Values are sketched before they are shuffled: a group of any size sends a sketch for each task. Null values are
    left out; a group without any is left out too.
    """
    number = F.col(value).cast("double")
    return (
        df.where(number.isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_values"), F.min(number).alias("least"), F.max(number).alias("most"),
            F.kll_sketch_agg_double(number, k).alias("sketch"),
        )
    )


def merged(sketches: DataFrame, by: Sequence[str | Column], k: int = K) -> DataFrame:
    """The sketches of each group as one. That is the sketch of all their rows, with the same bound on its error."""
    return sketches.groupBy(*by).agg(
        F.sum("n_values").alias("n_values"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )


def with_quantiles(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Named quantiles in place of the sketch; each is a value that occurred."""
    named = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in quantiles.items()}
    return sketches.withColumns(named).drop("sketch")


def per_week(daily: DataFrame, day: str = "metric_date", by: Sequence[str] = ()) -> DataFrame:
    """Weeks from Monday on, as ``week_start``."""
    week = F.to_date(F.date_trunc("week", day)).alias("week_start")
    return merged(daily, [week, *by])


def trailing(daily: DataFrame, n_days: int, first: date | str, last: date | str, day: str = "metric_date") -> DataFrame:
    """For each day of the range the sketch of the ``n_days`` days that end with it; days without values are left out.

    A day's sketch, not its rows, is repeated for the days whose window holds it.
    """
    start = F.greatest(F.col(day), F.lit(str(first)).cast("date"))
    end = F.least(F.date_add(day, n_days - 1), F.lit(str(last)).cast("date"))
    spread = daily.where(start <= end).withColumn("_until", F.explode(F.sequence(start, end)))
    return merged(spread.drop(day), [F.col("_until").alias(day)])


def record_days(spark: SparkSession, sketches: DataFrame, path: str, day: str = "metric_date", by: Sequence[str] = ()) -> None:
    """Keep the sketches of some days; a day that is recorded again replaces its old one."""
    upsert(spark, sketches, path, [day, *by], n_buckets=8)
