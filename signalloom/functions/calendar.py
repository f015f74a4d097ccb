"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included, with its week and month start."""
    span = F.sequence(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return spark.range(1).select(F.explode(span).alias("date")).select(
        "date",
        F.to_date(F.date_trunc("week", "date")).alias("week_start"),
        F.to_date(F.date_trunc("month", "date")).alias("month_start"),
    )
