"""Executive KPIs: today's row, and the history rebuilt day by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.functions.calendar import calendar
from signalloom.functions.clock import AsOf, instant
from signalloom.functions.scoring import blend, either, fading, share_of_cap
from signalloom.model import (
    ACTION_THRESHOLD,
    TRAILING_DAYS,
    CartPolicy,
    EventNames,
    OrderStates,
    RiskPolicy,
)
from signalloom.operators.carts import (
    conversion_lags,
    daily_cart_activity,
    is_abandoned,
    prior_order_counts,
    with_recoverable_value,
)
from signalloom.operators.fulfillment import (
    on_time,
    on_time_rate,
    open_orders_with_shipment,
    promised_open_orders,
    risk_of,
    with_inventory_risk,
)
from signalloom.operators.joins import lookup
from signalloom.operators.percentiles import percentile
from signalloom.operators.staging import staged
from signalloom.operators.versions import merged_spans
from signalloom.plans.cart_recovery import counted_orders

DAILY_COLUMNS = [
    "metric_date",
    "recoverable_revenue",
    "delayed_order_revenue_risk",
    "on_time_delivery_rate",
    "conversion_lag_median_minutes",
]


def total_at(signal: DataFrame, score: str, amount: str, name: str, threshold: float = ACTION_THRESHOLD) -> DataFrame:
    """One row: sum of ``amount`` over rows scoring ``threshold`` or more, 0 without any."""
    worth_acting = signal.where(F.col(score) >= threshold)
    return worth_acting.agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias(name))


def recoverable_revenue(cart_signal: DataFrame) -> DataFrame:
    return total_at(cart_signal, "priority_score", "recoverable_cart_value", "recoverable_revenue")


def delayed_revenue_risk(order_signal: DataFrame) -> DataFrame:
    return total_at(order_signal, "fulfillment_risk_score", "order_total_usd", "delayed_order_revenue_risk")


def at_risk_orders(order_signal: DataFrame, threshold: float = ACTION_THRESHOLD) -> DataFrame:
    hit = F.col("fulfillment_risk_score") >= threshold
    return order_signal.where(hit).agg(F.count(F.lit(1)).alias("at_risk_orders"))


def live_headline(cart_signal: DataFrame, order_signal: DataFrame) -> DataFrame:
    """One row with the live cards of the report."""
    return cart_signal.sparkSession.range(1).select(
        recoverable_revenue(cart_signal).scalar().alias("recoverable_revenue"),
        delayed_revenue_risk(order_signal).scalar().alias("delayed_order_revenue_risk"),
        at_risk_orders(order_signal).scalar().alias("at_risk_orders"),
    )


def conversion_lag_median(
    events: DataFrame, as_of: AsOf = None, *, names: EventNames = EventNames(), method: str = "approx"
) -> DataFrame:
    """One row: median minutes from first add to checkout; null without conversions."""
    lags = conversion_lags(events, as_of, names).select("lag_minutes")
    if method != "approx":
        lags = staged(lags, "conversion-lags")
    return percentile(lags, "lag_minutes", 0.5, method=method, name="conversion_lag_median_minutes")


def daily_summary(
    cart_signal: DataFrame,
    order_signal: DataFrame,
    shipments: DataFrame,
    events: DataFrame,
    as_of: AsOf = None,
    *,
    names: EventNames = EventNames(),
    method: str = "approx",
) -> DataFrame:
    """The KPI row of the day of ``as_of``: four one-row aggregates side by side as scalar subqueries."""
    median = conversion_lag_median(events, as_of, names=names, method=method)
    return events.sparkSession.range(1).select(
        F.to_date(instant(as_of)).alias("metric_date"),
        recoverable_revenue(cart_signal).scalar().alias("recoverable_revenue"),
        delayed_revenue_risk(order_signal).scalar().alias("delayed_order_revenue_risk"),
        on_time_rate(shipments, as_of).scalar().alias("on_time_delivery_rate"),
        median.scalar().alias("conversion_lag_median_minutes"),
    )


# History. Day D is evaluated at D 23:59:00 UTC.


def closing_time(day: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(23), mins=F.lit(59))


def closing_day(at: Column) -> Column:
    """First day whose closing time is not before ``at``."""
    return F.to_date(at + F.make_dt_interval(secs=F.lit(59.999999)))


def abandoned_by_day(
    events: DataFrame,
    first: date | str,
    last: date | str,
    policy: CartPolicy = CartPolicy(),
    names: EventNames = EventNames(),
) -> DataFrame:
    """The carts that were abandoned at the close of each day, from the events up to that close.

    No join of days with events: activity is first added up per cart and day, running totals
    along the days of a cart give its state after each active day, and a state is then repeated
    only for the days it lasts and could still be recoverable, ``stale_days`` at most.
    """
    in_range = F.col("event_timestamp") <= closing_time(F.lit(str(last)).cast("date"))
    daily = daily_cart_activity(events.where(in_range), closing_day(F.col("event_timestamp")), names)
    known_since = F.when(F.col("customer_id").isNotNull(), F.struct("first_seen_at", "customer_id"))
    per_day = daily.groupBy("cart_id", "day").agg(
        F.min(known_since).alias("_known"),
        *[F.max(c).alias(c) for c in ("last_activity_at", "has_add", "has_checkout_complete")],
        *[F.sum(c).alias(c) for c in ("added_value", "removed_value", "n_adds", "n_removes")],
    )
    along = Window.partitionBy("cart_id").orderBy("day")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = per_day.select(
        "cart_id",
        "day",
        F.lead("day").over(along).alias("_next_day"),
        F.min("_known").over(so_far)["customer_id"].alias("customer_id"),
        *[F.max(c).over(so_far).alias(c) for c in ("last_activity_at", "has_add", "has_checkout_complete")],
        *[F.sum(c).over(so_far).alias(c) for c in ("added_value", "removed_value", "n_adds", "n_removes")],
    )
    start = F.greatest(F.col("day"), F.lit(str(first)).cast("date"))
    end = F.least(
        F.date_sub("_next_day", 1), F.date_add("day", policy.stale_days), F.lit(str(last)).cast("date")
    )
    lasting = states.where(
        (F.col("has_add") == 1) & (F.col("has_checkout_complete") == 0) & (start <= end)
    ).withColumn("metric_date", F.explode(F.sequence(start, end)))
    now = closing_time(F.col("metric_date"))
    return with_recoverable_value(lasting.where(is_abandoned(now, policy)), now)


def recoverable_revenue_by_day(
    events: DataFrame,
    orders: DataFrame,
    first: date | str,
    last: date | str,
    *,
    policy: CartPolicy = CartPolicy(),
    names: EventNames = EventNames(),
    states: OrderStates = OrderStates(),
    method: str = "approx",
    order_versions: DataFrame | None = None,
) -> DataFrame:
    """Value of the abandoned carts worth acting on, at the close of each day.

    A customer's orders count for every day as they are today; with ``order_versions`` (``versions.intervals``) on
    the days on which they counted.
    """
    carts = abandoned_by_day(events, first, last, policy, names).select(
        "metric_date", "cart_id", "customer_id", "recoverable_cart_value", "minutes_since_last_activity"
    )
    carts = staged(carts, "abandoned-by-day")
    caps = percentile(
        carts, "recoverable_cart_value", policy.value_percentile, by=["metric_date"], method=method, name="_cap"
    )
    cap = F.coalesce(F.nullif(F.col("_cap"), F.lit(0.0)), F.lit(1.0))
    if order_versions is None:
        known = staged(prior_order_counts(orders, counted_orders(states, policy)), "order-counts")
        judged = lookup(carts, known, "customer_id", spread="cart_id")
    else:
        counted = order_versions.where(counted_orders(states, policy)).select(
            F.col("customer_id").alias("_customer"), closing_day(F.col("valid_from")).alias("_from"), closing_day(F.col("valid_to")).alias("_to")
        )
        loyal = staged(merged_spans(counted, "_customer", "_from", "_to"), "loyal-days")
        # Carts without a customer match nothing; they are spread by their own id.
        same = F.coalesce("customer_id", "cart_id") == F.col("_customer")
        then = (F.col("metric_date") >= F.col("_from")) & (F.col("metric_date") < F.col("_to"))
        judged = carts.join(loyal, same & F.col("customer_id").isNotNull() & then, "left").withColumn(
            "prior_order_count", F.when(F.col("_customer").isNotNull(), 1)
        )
    # One row per day of the range: its size is bounded by the calendar.
    priced = judged.join(F.broadcast(caps), "metric_date")
    scored = priced.withColumns(
        {
            "recency_score": fading(F.col("minutes_since_last_activity"), policy.recency_scale_minutes),
            "value_score": share_of_cap(F.col("recoverable_cart_value"), cap),
            "loyalty_score": either(F.col("prior_order_count") > 0, policy.loyal_score, policy.new_score),
        }
    )
    priority = blend(
        {
            "recency_score": policy.recency_weight,
            "value_score": policy.value_weight,
            "loyalty_score": policy.loyalty_weight,
        }
    )
    return (
        scored.where(priority >= ACTION_THRESHOLD)
        .groupBy("metric_date")
        .agg(F.sum("recoverable_cart_value").alias("recoverable_revenue"))
    )


def delayed_revenue_by_day(
    orders: DataFrame,
    shipments: DataFrame,
    order_items: DataFrame,
    inventory: DataFrame,
    first: date | str,
    last: date | str,
    *,
    policy: RiskPolicy = RiskPolicy(),
    states: OrderStates = OrderStates(),
) -> DataFrame:
    """Revenue at risk at the close of each day, taking today's order states for every day.

    If ``orders`` has ``valid_from`` and ``valid_to`` (``versions.intervals``), each state counts on the days that it
    held: an order that arrived later is open before. Shipments and stock are today's in either case.

    The risk of an order never falls as its promise comes nearer. So each order is reduced to the
    first day it is at risk, the amounts are added up per such day, and a running total over the
    calendar gives the answer: orders are never multiplied by days.
    """
    exposed = with_inventory_risk(
        open_orders_with_shipment(orders, shipments, states),
        order_items,
        inventory,
        open_ids=promised_open_orders(orders, states),
    )
    transit = F.col("carrier_avg_transit_days")
    # Days left at which the score crosses the threshold, solved for and then checked on the
    # score itself one day to either side, so that rounding cannot move the day.
    rest = F.lit(ACTION_THRESHOLD) - risk_of(F.lit(2_000_000_000), policy)
    solved = F.floor(transit * (F.lit(1.0) - rest / F.lit(100.0 * policy.time_weight))).cast("int")
    most_days_left = F.greatest(
        *[F.when(risk_of(d, policy) >= ACTION_THRESHOLD, d) for d in (solved + 1, solved, solved - 1)]
    )
    start, end = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    always = risk_of(F.lit(2_000_000_000), policy) >= ACTION_THRESHOLD
    since = F.when(always, start).otherwise(
        F.greatest(F.date_sub("promised_delivery_date", most_days_left), start)
    )
    at_risk = exposed.withColumn("_since", F.when(always | most_days_left.isNotNull(), since)).where("_since IS NOT NULL")
    risen = F.struct(F.col("_since").alias("day"), F.col("order_total_usd").alias("amount"))
    changes = F.array(risen)
    if "valid_from" in orders.columns:
        at_risk = at_risk.withColumn("_since", F.greatest("_since", closing_day(F.col("valid_from")))).withColumn(
            "_until", closing_day(F.col("valid_to"))
        ).where(F.col("_until").isNull() | (F.col("_since") < F.col("_until")))
        changes = F.array(risen, F.struct(F.col("_until").alias("day"), (-F.col("order_total_usd")).alias("amount")))
    steps = (
        at_risk.where(F.col("_since") <= end)
        .select(F.inline(changes).alias("metric_date", "_amount"))
        .where(F.col("metric_date") <= end)
        .groupBy("metric_date")
        .agg(F.sum("_amount").alias("_step"))
    )
    spine = calendar(orders.sparkSession, first, last).select(F.col("date").alias("metric_date"))
    # Unpartitioned on purpose: its input is one row per day of the range.
    to_date = Window.orderBy("metric_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.join(steps, "metric_date", "left").select(
        "metric_date", F.sum("_step").over(to_date).alias("delayed_order_revenue_risk")
    )


def _closing_windows(at: Column, first: date | str, last: date | str, n_days: int) -> Column:
    """Days of the range whose window ``[close - n_days, close]``, both ends included, holds ``at``."""
    last_window = F.date_add(F.to_date(at + F.make_dt_interval(mins=F.lit(1))), n_days - 1)
    start = F.greatest(closing_day(at), F.lit(str(first)).cast("date"))
    end = F.least(last_window, F.lit(str(last)).cast("date"))
    return F.when(start <= end, F.sequence(start, end))


def on_time_rate_by_day(
    shipments: DataFrame, first: date | str, last: date | str, n_days: int = TRAILING_DAYS
) -> DataFrame:
    """Trailing on-time rate at each close.

    Deliveries are first added up per pair of first and last day whose window holds them; only
    those few sums are repeated per day.
    """
    at = F.col("delivered_at")
    spans = (
        shipments.where(at.isNotNull())
        .groupBy(
            closing_day(at).alias("_first"),
            F.date_add(F.to_date(at + F.make_dt_interval(mins=F.lit(1))), n_days - 1).alias("_last"),
        )
        .agg(F.count(on_time()).alias("_n"), F.sum(on_time().cast("int")).alias("_k"))
    )
    start = F.greatest("_first", F.lit(str(first)).cast("date"))
    end = F.least("_last", F.lit(str(last)).cast("date"))
    return (
        spans.where(start <= end)
        .select(F.explode(F.sequence(start, end)).alias("metric_date"), "_n", "_k")
        .groupBy("metric_date")
        .agg(F.try_divide(F.sum("_k"), F.sum("_n")).alias("on_time_delivery_rate"))
    )


def conversion_lag_by_day(
    events: DataFrame,
    first: date | str,
    last: date | str,
    *,
    names: EventNames = EventNames(),
    n_days: int = TRAILING_DAYS,
    method: str = "approx",
) -> DataFrame:
    """Median lag of the carts completed in the window of each close.

    A cart falls in at most ``n_days + 1`` windows; the repeated rows go straight into partial
    aggregates of one sketch per day and are not shuffled.
    """
    lags = conversion_lags(events, names=names, n_days=None).where(F.col("lag_minutes").isNotNull())
    windows = _closing_windows(F.col("checkout_complete_at"), first, last, n_days)
    per_day = lags.select(F.explode(windows).alias("metric_date"), "lag_minutes")
    if method != "approx":
        per_day = staged(per_day, "lags-by-day")
    return percentile(
        per_day, "lag_minutes", 0.5, by=["metric_date"], method=method, name="conversion_lag_median_minutes"
    )


def summary_history(
    events: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    order_items: DataFrame,
    inventory: DataFrame,
    first: date | str,
    last: date | str,
    *,
    names: EventNames = EventNames(),
    states: OrderStates = OrderStates(),
    method: str = "approx",
    order_versions: DataFrame | None = None,
) -> DataFrame:
    """The daily KPI row for every day of the range, rounded as published.

    ``order_versions`` (``versions.intervals`` of recorded extracts) gives the order states of each day; without it
    today's are taken for all.
    """
    spine = calendar(events.sparkSession, first, last).select(F.col("date").alias("metric_date"))
    revenue = recoverable_revenue_by_day(
        events, orders, first, last, names=names, states=states, method=method, order_versions=order_versions
    )
    delayed = delayed_revenue_by_day(
        orders if order_versions is None else order_versions, shipments, order_items, inventory, first, last, states=states
    )
    rate = on_time_rate_by_day(shipments, first, last)
    lag = conversion_lag_by_day(events, first, last, names=names, method=method)
    joined = spine
    for part in (revenue, delayed, rate, lag):
        joined = joined.join(part, "metric_date", "left")
    return joined.select(
        "metric_date",
        F.round(F.coalesce("recoverable_revenue", F.lit(0.0)), 2).alias("recoverable_revenue"),
        F.round(F.coalesce("delayed_order_revenue_risk", F.lit(0.0)), 2).alias("delayed_order_revenue_risk"),
        F.round("on_time_delivery_rate", 4).alias("on_time_delivery_rate"),
        F.round("conversion_lag_median_minutes", 1).alias("conversion_lag_median_minutes"),
    )

