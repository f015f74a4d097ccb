"""Open orders and what endangers their delivery promise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, instant_like, trailing
from signalloom.functions.scoring import blend, deadline_pressure, either
from signalloom.model import TRAILING_DAYS, OrderStates, RiskPolicy
from signalloom.operators.staging import broadcast_if_small, staged, staged_with_size


def promised_open_orders(orders: DataFrame, states: OrderStates = OrderStates()) -> DataFrame:
    """Orders under way that carry a delivery promise; one without a promise is not guessed at."""
    return orders.where((F.col("status") == states.open) & F.col("promised_delivery_date").isNotNull())


def open_orders_with_shipment(
    orders: DataFrame, shipments: DataFrame, states: OrderStates = OrderStates()
) -> DataFrame:
    carrier_facts = shipments.select(
        "order_id",
        "carrier",
        "carrier_avg_transit_days",
        F.col("carrier_historical_late_rate_pct").alias("carrier_risk_score"),
    )
    return promised_open_orders(orders, states).join(carrier_facts, "order_id")


def backordered_skus(inventory: DataFrame) -> DataFrame:
    """Articles on back order in any warehouse, once each."""
    return inventory.where(F.col("backorder_flag")).select("sku").distinct()


def orders_with_backorder(order_items: DataFrame, inventory: DataFrame, open_ids: DataFrame) -> DataFrame:
    """Ids of the orders with at least one article on back order, once each.

    Articles on back order are usually few: they are then broadcast and the order lines are
    reduced in their scan, so that only hits are shuffled. Otherwise the lines are first reduced
    to the open orders (a shuffle by order, which no article can make uneven) and written, and adaptive
    execution splits hot articles in the join that follows: both its sides are plain tables.
    """
    skus, size = staged_with_size(backordered_skus(inventory), "backordered-skus")
    bounded = broadcast_if_small(skus, size)
    lines = order_items.select("order_id", "sku")
    if bounded is skus:
        lines = staged(lines.join(open_ids.select("order_id"), "order_id", "left_semi"), "open-lines")
    return lines.join(bounded, "sku", "left_semi").select("order_id").distinct()


def with_inventory_risk(
    orders: DataFrame, order_items: DataFrame, inventory: DataFrame, open_ids: DataFrame | None = None
) -> DataFrame:
    """``orders`` plus ``has_backordered_item``; orders without lines have none.

    ``open_ids`` may name a cheaper frame with the ids of interest than ``orders`` itself.
    """
    ids = orders if open_ids is None else open_ids
    hit = orders_with_backorder(order_items, inventory, ids).withColumn("_hit", F.lit(True))
    return (
        orders.join(hit, "order_id", "left")
        .withColumn("has_backordered_item", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def risk_of(days_left: Column, policy: RiskPolicy = RiskPolicy()) -> Column:
    """Risk score of an order with ``days_left`` to its promise."""
    return (
        F.lit(policy.time_weight) * deadline_pressure(days_left, F.col("carrier_avg_transit_days"))
        + F.lit(policy.inventory_weight) * either(F.col("has_backordered_item"), policy.backorder_score, 0.0)
        + F.lit(policy.carrier_weight) * F.col("carrier_risk_score")
    )


def with_risk_scores(orders: DataFrame, today: Column, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    scored = orders.withColumn("days_to_promise", F.datediff("promised_delivery_date", today)).withColumns(
        {
            "time_pressure_score": deadline_pressure(
                F.col("days_to_promise"), F.col("carrier_avg_transit_days")
            ),
            "inventory_risk_score": either(F.col("has_backordered_item"), policy.backorder_score, 0.0),
        }
    )
    weights = {
        "time_pressure_score": policy.time_weight,
        "inventory_risk_score": policy.inventory_weight,
        "carrier_risk_score": policy.carrier_weight,
    }
    return scored.withColumn("fulfillment_risk_score", blend(weights))


def on_time(delivered: str = "delivered_at", promised: str = "promised_delivery_date") -> Column:
    return F.to_date(delivered) <= F.col(promised)


def on_time_rate(shipments: DataFrame, as_of: AsOf = None, n_days: int = TRAILING_DAYS) -> DataFrame:
    """One row: share of the deliveries of the last ``n_days`` that kept their promise.

    Null without deliveries: no rate is not a rate of zero.
    """
    now = instant_like(shipments, "delivered_at", as_of)
    recent = shipments.where(trailing(F.col("delivered_at"), now, n_days))
    return recent.agg(F.avg(on_time().cast("int")).alias("on_time_delivery_rate"))
