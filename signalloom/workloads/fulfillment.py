"""Open orders, inventory risk and the fulfillment report page."""

from __future__ import annotations

import uuid

from signalloom.operators import fulfillment, layout, standardize
from signalloom.operators.measures import carrier_scorecard as scorecard
from signalloom.plans import cart_recovery, fulfillment_risk, reports
from signalloom.session import scratch_path, stored_bytes
from signalloom.sinks.tables import files_for
from signalloom.workloads import retail
from signalloom.workloads.registry import presented, sql_day, workload
from signalloom.workloads.retail import AS_OF, STATES, VIEWS, with_views

VIEWS["open_orders"] = """
    SELECT o.order_id, o.customer_id, o.order_total_usd, o.promised_delivery_date, s.carrier,
        s.carrier_avg_transit_days, s.carrier_historical_late_rate_pct AS carrier_risk_score
    FROM shop_orders o JOIN shipments s ON o.order_id = s.order_id
    WHERE o.status = 'O' AND o.promised_delivery_date IS NOT NULL
"""
VIEWS["backordered"] = """
    SELECT DISTINCT order_id FROM order_items i JOIN inventory v ON i.sku = v.sku WHERE v.backorder_flag
"""
VIEWS["exposed_orders"] = """
    SELECT *, order_id IN (SELECT order_id FROM backordered) AS has_backordered_item FROM open_orders
"""


def risk_sql(today: str) -> str:
    return f"""
    SELECT *, 0.5 * time_pressure_score + 0.3 * inventory_risk_score + 0.2 * carrier_risk_score AS fulfillment_risk_score
    FROM (SELECT *, CAST(promised_delivery_date - {today} AS INTEGER) AS days_to_promise,
        100 * (1 - least(greatest(promised_delivery_date - {today}, 0) / carrier_avg_transit_days, 1.0))
            AS time_pressure_score,
        CASE WHEN has_backordered_item THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS inventory_risk_score
        FROM exposed_orders)
"""


VIEWS["risk_signal"] = risk_sql(f"CAST(TIMESTAMP '{AS_OF}' AS DATE)")
RISK_VIEWS = (
    "shop_orders", "shipments", "order_items", "inventory", "open_orders", "backordered", "exposed_orders",
    "risk_signal",
)


def signal(spark, sf_dir, as_of=AS_OF):
    return fulfillment_risk.fulfillment_risk_signal(
        retail.orders(spark, sf_dir),
        retail.shipments(spark, sf_dir),
        retail.order_items(spark, sf_dir),
        retail.inventory(spark, sf_dir),
        as_of,
        states=STATES,
    )


@workload(
    with_views("shop_orders", "shipments", "open_orders")
    + f"""SELECT order_id, customer_id, carrier, carrier_avg_transit_days, carrier_risk_score,
    {sql_day("promised_delivery_date", "promised_delivery_date")} FROM open_orders"""
)
def open_orders_with_shipment(spark, sf_dir):
    joined = fulfillment.open_orders_with_shipment(
        retail.orders(spark, sf_dir), retail.shipments(spark, sf_dir), STATES
    )
    return presented(
        joined.select(
            "order_id", "customer_id", "carrier", "carrier_avg_transit_days", "carrier_risk_score",
            "promised_delivery_date",
        )
    )


@workload(
    with_views("shop_orders", "order_items", "inventory", "backordered")
    + "SELECT order_id, order_id IN (SELECT order_id FROM backordered) AS has_backordered_item FROM shop_orders"
)
def inventory_risk(spark, sf_dir):
    flagged = fulfillment.with_inventory_risk(
        retail.orders(spark, sf_dir).select("order_id"),
        retail.order_items(spark, sf_dir),
        retail.inventory(spark, sf_dir),
    )
    return flagged.select("order_id", "has_backordered_item")


RISK_SQL = (
    with_views(*RISK_VIEWS)
    + f"""SELECT order_id, customer_id, round(order_total_usd, 6) AS order_total_usd, carrier,
    {sql_day("promised_delivery_date", "promised_delivery_date")}, days_to_promise,
    round(time_pressure_score, 6) AS time_pressure_score, inventory_risk_score, carrier_risk_score,
    round(fulfillment_risk_score, 6) AS fulfillment_risk_score FROM risk_signal"""
)


@workload(RISK_SQL)
def fulfillment_risk_signal(spark, sf_dir):
    scored = signal(spark, sf_dir).drop("_gold_computed_at")
    return presented(cart_recovery.ranked(scored, "fulfillment_risk_score", "order_id"))


@workload(RISK_SQL)
def fulfillment_risk_bucketed(spark, sf_dir):
    """The signal over tables that are stored by order: its joins of facts need no shuffle."""
    n_buckets = max(8, files_for(stored_bytes(spark, f"{sf_dir}/lineitem.parquet")))
    stored = {}
    for name in ("orders", "shipments", "order_items"):
        known_as = f"{name}_{uuid.uuid4().hex}"
        rows = getattr(retail, name)(spark, sf_dir)
        stored[name] = layout.write_bucketed(rows, known_as, scratch_path(spark, name), "order_id", n_buckets)
    scored = fulfillment_risk.fulfillment_risk_signal(
        stored["orders"], stored["shipments"], stored["order_items"], retail.inventory(spark, sf_dir), AS_OF, states=STATES
    )
    return presented(scored.drop("_gold_computed_at"))


@workload(
    with_views(*RISK_VIEWS, "customers", "std_customers")
    + f"""SELECT order_id, s.customer_id, CASE WHEN is_returning THEN 'returning' WHEN NOT is_returning THEN 'new' END
        AS customer_segment, carrier, {sql_day("promised_delivery_date", "promised_delivery_date")},
    days_to_promise, round(order_total_usd, 6) AS order_total_usd,
    CASE WHEN fulfillment_risk_score >= 80 THEN '🔴 Escalate' WHEN fulfillment_risk_score >= 60 THEN '🟠 Watch'
        WHEN fulfillment_risk_score >= 40 THEN '🟡 Monitor' ELSE '⚪ Low' END AS risk_tier,
    round(fulfillment_risk_score, 6) AS fulfillment_risk_score, round(time_pressure_score, 6) AS time_pressure_score,
    inventory_risk_score, carrier_risk_score
    FROM risk_signal s LEFT JOIN std_customers c ON s.customer_id = c.customer_id"""
)
def order_ops_table(spark, sf_dir):
    people = standardize.customers(retail.customers(spark, sf_dir))
    return presented(reports.order_action_list(signal(spark, sf_dir), people))


@workload(
    with_views(*RISK_VIEWS)
    + """SELECT order_id, round(fulfillment_risk_score, 6) AS fulfillment_risk_score FROM risk_signal
    ORDER BY risk_signal.fulfillment_risk_score DESC, order_id LIMIT 20"""
)
def top_n_orders(spark, sf_dir):
    best = cart_recovery.top(signal(spark, sf_dir), "fulfillment_risk_score", "order_id", 20)
    return presented(best.select("order_id", "fulfillment_risk_score"))


@workload(
    with_views(*RISK_VIEWS)
    + """SELECT carrier, count(*) AS n_orders, count(*) FILTER (fulfillment_risk_score >= 60) AS at_risk_orders,
    round(avg(carrier_risk_score), 6) AS avg_carrier_risk FROM risk_signal GROUP BY carrier"""
)
def carrier_scorecard(spark, sf_dir):
    return presented(scorecard(signal(spark, sf_dir)))


@workload(
    with_views("shop_orders", "shipments")
    + f"""SELECT round(avg(CAST(CAST(delivered_at AS DATE) <= promised_delivery_date AS INTEGER)), 6) AS on_time_delivery_rate
    FROM shipments WHERE delivered_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF}'"""
)
def on_time_rate(spark, sf_dir):
    return presented(fulfillment.on_time_rate(retail.shipments(spark, sf_dir), AS_OF))
