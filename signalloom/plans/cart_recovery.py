"""Abandoned carts ranked by what can be recovered and how urgent it is."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, days, instant_like
from signalloom.functions.scoring import blend, either, fading, share_of_cap
from signalloom.model import CartPolicy, EventNames, OrderStates
from signalloom.operators.carts import abandoned_carts, cart_state, prior_order_counts
from signalloom.operators.joins import lookup, rows_of_recent_carts
from signalloom.operators.percentiles import percentile
from signalloom.operators.staging import staged

# Columns of the published signal, in order.
SIGNAL_COLUMNS = [
    "cart_id", "customer_id", "last_activity_at", "minutes_since_last_activity",
    "recoverable_cart_value", "item_count", "recency_score", "value_score", "loyalty_score",
    "priority_score", "_gold_computed_at",
]


def counted_orders(states: OrderStates, policy: CartPolicy) -> Column:
    """Which prior orders make a customer loyal."""
    status = F.col("status")
    return status == states.done if policy.completed_orders_only else status != states.cancelled


def value_cap(carts: DataFrame, policy: CartPolicy, method: str) -> Column:
    """The value that scores 100: a percentile over ``carts``, or 1 where that is null or zero."""
    q = percentile(carts, "recoverable_cart_value", policy.value_percentile, method=method).scalar()
    return F.coalesce(F.nullif(q, F.lit(0.0)), F.lit(1.0))


def score_carts(
    carts: DataFrame, orders: DataFrame, cap: Column, states: OrderStates, policy: CartPolicy
) -> DataFrame:
    """Abandoned carts with their three part scores and the priority."""
    known = staged(prior_order_counts(orders, counted_orders(states, policy)), "order-counts")
    with_history = lookup(carts, known, "customer_id", spread="cart_id")
    scored = with_history.withColumns(
        {
            "recency_score": fading(F.col("minutes_since_last_activity"), policy.recency_scale_minutes),
            "value_score": share_of_cap(F.col("recoverable_cart_value"), cap),
            "loyalty_score": either(
                F.col("prior_order_count") > 0, policy.loyal_score, policy.new_score
            ),
        }
    )
    weights = {
        "recency_score": policy.recency_weight,
        "value_score": policy.value_weight,
        "loyalty_score": policy.loyalty_weight,
    }
    return scored.withColumn("priority_score", blend(weights))


def horizon_days(policy: CartPolicy) -> int:
    """For how long after its last event a cart can bear on the signal."""
    return max(policy.stale_days, policy.percentile_days or 0)


def signal_of(
    carts: DataFrame, orders: DataFrame, now: Column, policy: CartPolicy, states: OrderStates, percentile_method: str
) -> DataFrame:
    """The signal from the state of the carts, which has to hold all that were active within the horizon."""
    horizon = horizon_days(policy)
    candidates = staged(abandoned_carts(carts, now, replace(policy, stale_days=horizon)), "abandoned-carts")
    cap = value_cap(candidates, policy, percentile_method)
    current = candidates
    if horizon > policy.stale_days:
        current = abandoned_carts(candidates, now, policy)
    scored = score_carts(current, orders, cap, states, policy)
    return scored.withColumn("_gold_computed_at", F.current_timestamp()).select(*SIGNAL_COLUMNS)


def cart_recovery_signal(
    events: DataFrame,
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    policy: CartPolicy = CartPolicy(),
    names: EventNames = EventNames(),
    states: OrderStates = OrderStates(),
    percentile_method: str = "approx",
) -> DataFrame:
    """One row per abandoned cart, judged by the events up to ``as_of``.

    With an ``event_date`` to prune by, the carts active within the horizon are looked up first and
    only their history is aggregated. The abandoned carts are needed twice, for the percentile and
    for the scores. They are a small part of the events, so they are written once and both uses read
    that table. The percentile comes back as a scalar subquery, not as a join.
    """
    now = instant_like(events, "event_timestamp", as_of)
    events = events.where(F.col("event_timestamp") <= now)
    if "event_date" in events.columns:
        since = now - days(horizon_days(policy))
        in_horizon = (F.col("event_date") >= F.to_date(since)) & (F.col("event_timestamp") > since)
        events = rows_of_recent_carts(events, in_horizon & F.col("event_type").isin(*names.cart))
    return signal_of(cart_state(events, names), orders, now, policy, states, percentile_method)


def latest_event_time(events: DataFrame) -> Column:
    """Time of the newest event, as an ``as_of`` for data that is not live."""
    return events.agg(F.max("event_timestamp").alias("at")).scalar()


def ranked(signal: DataFrame, score: str, key: str) -> DataFrame:
    """Action list: highest score first, equal scores by key."""
    return signal.orderBy(F.col(score).desc(), F.col(key))


def top(signal: DataFrame, score: str, key: str, n: int = 20) -> DataFrame:
    """Hand-picked list; Spark keeps ``n`` rows per task and never sorts the whole signal."""
    return ranked(signal, score, key).limit(n)
