"""Open orders ranked by the risk of missing their delivery promise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, instant
from signalloom.model import OrderStates, RiskPolicy
from signalloom.operators.fulfillment import (
    open_orders_with_shipment,
    promised_open_orders,
    with_inventory_risk,
    with_risk_scores,
)

# Columns of the published signal, in order.
SIGNAL_COLUMNS = [
    "order_id", "customer_id", "order_total_usd", "carrier", "promised_delivery_date",
    "days_to_promise", "time_pressure_score", "inventory_risk_score", "carrier_risk_score",
    "fulfillment_risk_score", "_gold_computed_at",
]


def fulfillment_risk_signal(
    orders: DataFrame,
    shipments: DataFrame,
    order_items: DataFrame,
    inventory: DataFrame,
    as_of: AsOf = None,
    *,
    policy: RiskPolicy = RiskPolicy(),
    states: OrderStates = OrderStates(),
) -> DataFrame:
    """One row per open order with a shipment and a promise."""
    open_orders = open_orders_with_shipment(orders, shipments, states)
    exposed = with_inventory_risk(
        open_orders, order_items, inventory, open_ids=promised_open_orders(orders, states)
    )
    scored = with_risk_scores(exposed, F.to_date(instant(as_of)), policy)
    return scored.withColumn("_gold_computed_at", F.current_timestamp()).select(*SIGNAL_COLUMNS)
