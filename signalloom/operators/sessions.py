"""Sessions: events of one ``session_id`` with no gap above 30 minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.operators.staging import broadcast_if_small, staged_with_size


def sessionize(
    events: DataFrame,
    key: str = "session_id",
    at: str = "event_timestamp",
    *,
    gap_minutes: int = 30,
    tie_breaker: str = "event_id",
    hot_rows: int = 1_000_000,
    slice_minutes: int = 15,
) -> DataFrame:
    """Number the sessions of each key from 1, as ``session_number``. A gap of exactly the limit
    stays inside the session.

    Most keys take one window and one shuffle. A key with more than ``hot_rows`` rows would be too
    much for one task: its rows are windowed per time slice, and the slices, one small row each, are
    then chained. A slice opens a new session when its first event is too far from the last event
    before, and the sessions opened earlier are added up. Rows without a key or a time are kept,
    with no session number.
    """
    gap = F.make_dt_interval(mins=F.lit(gap_minutes))
    in_session = F.col(key).isNotNull() & F.col(at).isNotNull()
    hot_keys, size = staged_with_size(
        events.where(in_session)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(key, F.lit(True).alias("_hot")),
        "hot-sessions",
    )
    any_hot = size > 0
    marked = events.withColumn("_hot", F.lit(False))
    if any_hot:
        marked = events.join(broadcast_if_small(hot_keys, size), key, "left")

    # Rows in no session are scattered instead of meeting in one task.
    scattered = F.pmod(F.xxhash64(tie_breaker), F.lit(4096))
    time_slice = F.floor(F.unix_timestamp(at) / F.lit(60 * slice_minutes))
    sliced = marked.withColumn(
        "_slice", F.when(~in_session, scattered).when(F.col("_hot"), time_slice).otherwise(F.lit(-1))
    )
    in_slice = Window.partitionBy(key, "_slice").orderBy(at, tie_breaker)
    opens = F.coalesce((F.col(at) > F.lag(at).over(in_slice) + gap).cast("int"), F.lit(0))
    numbered = sliced.withColumn("_opens", opens).withColumn(
        "_local", F.sum("_opens").over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    )
    first = F.lit(1)
    if any_hot:
        numbered = numbered.join(_slice_offsets(numbered.where("_hot"), key, at, gap), [key, "_slice"], "left")
        first = F.coalesce("_base", first)
    number = F.when(in_session, (F.col("_local") + first).cast("bigint"))
    return numbered.withColumn("session_number", number).drop("_hot", "_slice", "_opens", "_local", "_base")


def _slice_offsets(numbered: DataFrame, key: str, at: str, gap: Column) -> DataFrame:
    """Per key and slice the number of the session that its first event is in."""
    slices = (
        numbered.where(F.col(at).isNotNull())
        .groupBy(key, "_slice")
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.max("_local").alias("_n"))
    )
    along = Window.partitionBy(key).orderBy("_slice")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("_first") > F.lag("_last").over(along) + gap, F.lit(True)).cast("int")
    opened_before = F.coalesce(F.sum(F.col("_n") + F.col("_new")).over(before), F.lit(0))
    return slices.withColumn("_new", opens).select(key, "_slice", (opened_before + F.col("_new")).alias("_base"))


def session_summary(sessions: DataFrame, key: str = "session_id", at: str = "event_timestamp") -> DataFrame:
    """Start, end and number of events per numbered session."""
    return sessions.groupBy(key, "session_number").agg(
        F.min(at).alias("started_at"), F.max(at).alias("ended_at"), F.count(F.lit(1)).alias("n_events")
    )
