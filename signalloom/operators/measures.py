"""Report measures over the daily history and over the two signals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, instant
from signalloom.functions.tiers import percent_label, traffic_light
from signalloom.model import ACTION_THRESHOLD


def _day_number(day: str) -> Column:
    return F.unix_date(F.col(day))


def trailing_window(n_days: int, day: str = "metric_date") -> WindowSpec:
    """The ``n_days`` days ending with the current one; missing days simply add nothing.

    Without a partition key, which is right only for a history of one row per day.
    """
    return Window.orderBy(_day_number(day)).rangeBetween(-(n_days - 1), Window.currentRow)


def trailing_sum(history: DataFrame, measure: str, n_days: int = 7, name: str | None = None) -> DataFrame:
    """Sum of the last ``n_days`` daily values.

    For a daily snapshot of a level, such as recoverable revenue, the sum counts a cart once for
    every day it was open. That is how the measure is defined.
    """
    name = name or f"{measure}_trailing_{n_days}"
    return history.withColumn(name, F.sum(measure).over(trailing_window(n_days)))


def trailing_average(history: DataFrame, measure: str, n_days: int = 7, name: str | None = None) -> DataFrame:
    name = name or f"{measure}_trend_{n_days}"
    return history.withColumn(name, F.avg(measure).over(trailing_window(n_days)))


def week_over_week(history: DataFrame, measure: str, name: str) -> DataFrame:
    """Relative change of ``measure`` against the day a week before.

    Null when that day is absent or was zero. Days are matched by date, so gaps cannot shift the
    comparison.
    """
    a_week_later = history.select(
        F.date_add("metric_date", 7).alias("metric_date"), F.col(measure).alias("_before")
    )
    change = F.try_divide(F.col(measure) - F.col("_before"), F.col("_before"))
    return history.join(a_week_later, "metric_date", "left").withColumn(name, change).drop("_before")


def kpi_trend(history: DataFrame, days_dim: DataFrame, n_days: int = 7) -> DataFrame:
    """The trend page: per calendar day the trailing sums, change, rate trend, light and lag.

    Sums are null over days without any history; the running average of the daily medians stands
    in for a median, since the history keeps only one median per day.
    """
    spine = days_dim.select(F.col("date").alias("metric_date"))
    daily = spine.join(history, "metric_date", "left")
    for measure in ("recoverable_revenue", "delayed_order_revenue_risk"):
        daily = trailing_sum(daily, measure, n_days, f"{measure}_trailing")
    daily = trailing_average(daily, "on_time_delivery_rate", n_days, "on_time_rate_trend")
    daily = trailing_average(daily, "conversion_lag_median_minutes", n_days, "conversion_lag_trend")
    daily = week_over_week(daily, "recoverable_revenue_trailing", "recovery_wow")
    return daily.select(
        "metric_date",
        "recoverable_revenue_trailing",
        "delayed_order_revenue_risk_trailing",
        "recovery_wow",
        "on_time_rate_trend",
        percent_label(F.col("on_time_rate_trend")).alias("on_time_rate_label"),
        traffic_light(F.col("on_time_rate_trend")).alias("on_time_light"),
        "conversion_lag_trend",
    )


def history_averages(history: DataFrame) -> DataFrame:
    """One row: average daily on-time rate and average of the daily median lags."""
    return history.agg(
        F.avg("on_time_delivery_rate").alias("avg_on_time_rate"),
        F.avg("conversion_lag_median_minutes").alias("avg_median_lag"),
    )


def weekly_rollup(history: DataFrame) -> DataFrame:
    """KPIs per week, weeks starting on Monday."""
    return history.groupBy(F.to_date(F.date_trunc("week", "metric_date")).alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("recoverable_revenue").alias("recoverable_revenue"),
        F.sum("delayed_order_revenue_risk").alias("delayed_order_revenue_risk"),
        F.avg("on_time_delivery_rate").alias("avg_on_time_rate"),
        F.avg("conversion_lag_median_minutes").alias("avg_median_lag"),
    )


def histogram(signal: DataFrame, score: str, width: float = 10.0, top_score: float = 100.0) -> DataFrame:
    """Rows per score bucket ``[k * width, (k + 1) * width)``; the top score is in the last bucket."""
    last = F.lit(top_score / width - 1)
    bucket = F.least(F.floor(F.col(score) / F.lit(width)), last).cast("int")
    return signal.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


def carrier_scorecard(order_signal: DataFrame, threshold: float = ACTION_THRESHOLD) -> DataFrame:
    """Per carrier: open orders, those at risk, and the average carrier risk."""
    return order_signal.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("fulfillment_risk_score") >= threshold).alias("at_risk_orders"),
        F.avg("carrier_risk_score").alias("avg_carrier_risk"),
    )


def freshness(
    datasets: Mapping[str, tuple[DataFrame, str]], sla_minutes: Mapping[str, float], as_of: AsOf = None
) -> DataFrame:
    """Per dataset the newest time, its age in minutes at ``as_of`` and whether that meets its limit.

    A dataset without rows has no newest time and does not meet its limit.
    """
    out = None
    for name, (df, column) in datasets.items():
        row = df.agg(F.max(column).cast("timestamp").alias("latest_at")).select(
            F.lit(name).alias("dataset"), "latest_at", F.lit(float(sla_minutes[name])).alias("sla_minutes")
        )
        out = row if out is None else out.unionByName(row)
    age = (F.unix_timestamp(instant(as_of)) - F.unix_timestamp("latest_at")) / F.lit(60.0)
    return out.withColumn("lag_minutes", age).withColumn(
        "within_sla", F.coalesce(F.col("lag_minutes") <= F.col("sla_minutes"), F.lit(False))
    )
