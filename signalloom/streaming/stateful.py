"""Operators that keep state between micro-batches, bounded by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalloom.functions.clock import days
from signalloom.operators.conversions import CONVERSION_DAYS
from signalloom.streaming.landing import with_trigger


def first_copies(
    stream: DataFrame,
    keys: Sequence[str] = ("cart_id", "event_type", "event_timestamp"),
    at: str = "event_timestamp",
    horizon: str = "1 day",
    keyed: str = "cart_id",
    own_id: str = "event_id",
) -> DataFrame:
    """The first copy of each key within ``horizon``, across batches and restarts.

    Rows without ``keyed`` are the same event only if they share ``own_id`` too. Rows that come later than
    the horizon are dropped; its default is the age that the quality rules accept.
    """
    apart = F.when(F.col(keyed).isNull(), F.col(own_id))
    return (
        stream.withColumn("_apart", apart)
        .withWatermark(at, horizon)
        .dropDuplicatesWithinWatermark([*keys, "_apart"])
        .drop("_apart")
    )


def sessions(
    stream: DataFrame,
    key: str = "session_id",
    at: str = "event_timestamp",
    gap: str = "30 minutes",
    lateness: str = "2 hours",
) -> DataFrame:
    """Sessions per key; in append mode each is emitted once the watermark has passed its end.

    Spark counts an event exactly ``gap`` after the last one as part of the session.
    """
    return (
        stream.withWatermark(at, lateness)
        .groupBy(F.session_window(at, gap).alias("session"), key)
        .agg(F.min(at).alias("started_at"), F.max(at).alias("ended_at"), F.count(F.lit(1)).alias("n_events"))
        .drop("session")
    )


def linked_visits(
    events: DataFrame,
    orders: DataFrame,
    n_days: int = CONVERSION_DAYS,
    gap: str = "30 minutes",
    lateness: str = "2 hours",
    longest_session_days: int = CONVERSION_DAYS,
) -> DataFrame:
    """The pairs of ``operators.conversions.linked_visits``, from a stream of events and one of orders.

    A session is joined once the watermark has closed it. Both sides of the join have a watermark and a bound on the
    other's time, so Spark drops a visit ``n_days`` after its end and an order once no session of up to
    ``longest_session_days`` can still end that holds it. A visit without an order is never emitted: nothing tells
    before its time is over. Append mode only.
    """
    named = F.col("customer_id").isNotNull() & F.col("cart_id").isNotNull()
    sessions_ = (
        events.withWatermark("event_timestamp", lateness)
        .groupBy(F.session_window("event_timestamp", gap).alias("session"), "session_id")
        .agg(F.collect_set(F.when(named, F.struct("customer_id", "cart_id"))).alias("_carts"))
    )
    ended = F.window_time("session")
    visits = (
        sessions_.select("session_id", F.col("session.start").alias("started_at"), ended.alias("_ended_at"), F.explode("_carts").alias("_c"))
        .select("session_id", "started_at", "_ended_at", F.col("_c.customer_id").alias("customer_id"), F.col("_c.cart_id").alias("cart_id"))
    )
    placed = orders.select(
        F.col("customer_id").alias("_o_customer"), F.col("cart_id").alias("_o_cart"), "order_id", "order_created_at"
    ).withWatermark("order_created_at", lateness)
    at = F.col("order_created_at")
    same = (F.col("customer_id") == F.col("_o_customer")) & (F.col("cart_id") == F.col("_o_cart"))
    bounded = at.between(F.col("_ended_at") - days(longest_session_days), F.col("_ended_at") + days(n_days))
    in_time = at.between(F.col("started_at"), F.col("started_at") + days(n_days))
    return visits.join(placed, same & bounded & in_time).drop("_ended_at", "_o_customer", "_o_cart")


def start_append(stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, every).start(path)
