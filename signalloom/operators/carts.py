"""Cart life cycle out of the event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, days, instant_like, minutes, minutes_between, trailing
from signalloom.functions.scoring import net_of
from signalloom.model import TRAILING_DAYS, CartPolicy, EventNames


def _measures(names: EventNames) -> dict[str, Column]:
    """Partial measures of a cart. All buffers are fixed-width, so Spark hashes instead of sorting."""
    kind, at = F.col("event_type"), F.col("event_timestamp")
    amount = F.col("price_at_event") * F.col("quantity")
    return {
        "first_seen_at": F.min(at),
        "last_activity_at": F.max(at),
        "has_add": F.max((kind == names.add).cast("int")),
        "has_checkout_complete": F.max((kind == names.complete).cast("int")),
        "added_value": F.sum(F.when(kind == names.add, amount).otherwise(0.0)),
        "removed_value": F.sum(F.when(kind == names.remove, amount).otherwise(0.0)),
        "n_adds": F.count_if(kind == names.add),
        "n_removes": F.count_if(kind == names.remove),
    }


def _named(measures: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in measures.items()]


def cart_state(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """One row per cart: its customer, last activity, flags, value added and removed, and counts.

    The customer is that of the cart's earliest event that names one (the smallest id among
    simultaneous ones). It is found in two steps, first per cart and customer with the customer as
    a grouping key: carrying a string in the aggregation buffer would make Spark sort all events.
    """
    per_customer = (
        events.where(F.col("event_type").isin(*names.cart))
        .groupBy("cart_id", "customer_id")
        .agg(*_named(_measures(names)))
    )
    known_since = F.when(F.col("customer_id").isNotNull(), F.struct("first_seen_at", "customer_id"))
    return per_customer.groupBy("cart_id").agg(
        F.min_by("customer_id", known_since).alias("customer_id"),
        F.max("last_activity_at").alias("last_activity_at"),
        F.max("has_add").alias("has_add"),
        F.max("has_checkout_complete").alias("has_checkout_complete"),
        F.sum("added_value").alias("added_value"),
        F.sum("removed_value").alias("removed_value"),
        F.sum("n_adds").alias("n_adds"),
        F.sum("n_removes").alias("n_removes"),
    )


def daily_cart_activity(events: DataFrame, day: Column, names: EventNames = EventNames()) -> DataFrame:
    """The measures of ``cart_state`` per cart, customer and ``day``."""
    return (
        events.where(F.col("event_type").isin(*names.cart))
        .groupBy("cart_id", "customer_id", day.alias("day"))
        .agg(*_named(_measures(names)))
    )


def is_abandoned(now: Column, policy: CartPolicy = CartPolicy()) -> Column:
    """Something was added, nothing was bought, and the cart is idle but not yet stale.

    Both time limits are exclusive.
    """
    last = F.col("last_activity_at")
    idle_long_enough = last < now - minutes(policy.idle_minutes)
    still_recoverable = last > now - days(policy.stale_days)
    return (
        (F.col("has_add") == 1) & (F.col("has_checkout_complete") == 0) & idle_long_enough & still_recoverable
    )


def with_recoverable_value(carts: DataFrame, now: Column) -> DataFrame:
    """Net value, net item count (neither below zero) and minutes since the last activity."""
    return carts.withColumns(
        {
            "recoverable_cart_value": net_of(F.col("added_value"), F.col("removed_value"), 0.0),
            "item_count": net_of(F.col("n_adds"), F.col("n_removes"), 0),
            "minutes_since_last_activity": minutes_between(F.col("last_activity_at"), now),
        }
    )


def abandoned_carts(carts: DataFrame, as_of: AsOf = None, policy: CartPolicy = CartPolicy()) -> DataFrame:
    """The carts of ``cart_state`` that count as abandoned at ``as_of``."""
    now = instant_like(carts, "last_activity_at", as_of)
    return with_recoverable_value(carts.where(is_abandoned(now, policy)), now)


def prior_order_counts(orders: DataFrame, counted: Column) -> DataFrame:
    """Number of ``counted`` orders per customer."""
    return (
        orders.where(counted & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("prior_order_count"))
    )


def conversion_lags(
    events: DataFrame, as_of: AsOf = None, names: EventNames = EventNames(), n_days: int | None = TRAILING_DAYS
) -> DataFrame:
    """Converted carts with the minutes from first add to last completed checkout.

    Only carts completed in the last ``n_days`` up to ``as_of``, judged by the events until then; all of them
    with ``None``.
    """
    if n_days is not None:
        now = instant_like(events, "event_timestamp", as_of)
        events = events.where(F.col("event_timestamp") <= now)
    kind, at = F.col("event_type"), F.col("event_timestamp")
    per_cart = (
        events.where(kind.isin(names.add, names.complete) & F.col("cart_id").isNotNull())
        .groupBy("cart_id")
        .agg(
            F.min(F.when(kind == names.add, at)).alias("first_add_at"),
            F.max(F.when(kind == names.complete, at)).alias("checkout_complete_at"),
        )
        .where(F.col("checkout_complete_at").isNotNull())
    )
    if n_days is not None:
        per_cart = per_cart.where(trailing(F.col("checkout_complete_at"), now, n_days))
    return per_cart.withColumn(
        "lag_minutes", minutes_between(F.col("first_add_at"), F.col("checkout_complete_at"))
    )


def cart_history(events: DataFrame, cart_id: str) -> DataFrame:
    """Every event of one cart in order, for drill-through."""
    return events.where(F.col("cart_id") == cart_id).orderBy("event_timestamp", "event_id")
