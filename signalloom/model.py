"""Schemas, vocabularies and policy constants of the retail data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns of the raw inputs and their types, in file order.
CLICKSTREAM_COLUMNS = """
    event_id STRING, event_type STRING, event_timestamp STRING, session_id STRING,
    customer_id STRING, cart_id STRING, device_type STRING, _ingested_at STRING,
    page_type STRING, sku STRING, quantity INT, price_at_event DOUBLE
"""
EXTRACT_COLUMNS = {
    "customers": "customer_id STRING, first_seen_date DATE, is_returning BOOLEAN, home_tz_offset INT",
    "products": "sku STRING, name STRING, category STRING, price DOUBLE",
    "inventory": """sku STRING, warehouse_id STRING, on_hand_qty INT, backorder_flag BOOLEAN,
        snapshot_date DATE""",
    "orders": """order_id STRING, customer_id STRING, cart_id STRING, order_created_at TIMESTAMP,
        channel STRING, currency STRING, fx_rate_to_usd DOUBLE, order_total_usd DOUBLE,
        status STRING, promised_delivery_date DATE""",
    "order_items": "order_id STRING, sku STRING, qty INT, unit_price DOUBLE",
    "shipments": """order_id STRING, carrier STRING, shipped_at TIMESTAMP, delivered_at TIMESTAMP,
        status STRING, carrier_avg_transit_days INT, carrier_historical_late_rate_pct DOUBLE,
        promised_delivery_date DATE""",
}
EXTRACT_KEYS = {
    "customers": ("customer_id",),
    "products": ("sku",),
    "inventory": ("sku", "warehouse_id"),
    "orders": ("order_id",),
    "order_items": ("order_id", "sku"),
    "shipments": ("order_id",),
}
AUDIT_COLUMNS = """
    job_name STRING, layer STRING, target_table STRING, row_count LONG, quarantined_count LONG,
    run_id STRING, started_at TIMESTAMP, finished_at TIMESTAMP, status STRING
"""


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct_of(columns: str) -> T.StructType:
    """Schema from ``name TYPE, ...``. Needs no session, so schemas can be module constants."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class EventNames:
    """Names that stand for the cart life cycle in ``event_type``.

    A parameter, so that a feed with other names is filtered on its own raw column and the
    filter still reaches the scan.
    """

    add: str = "add_to_cart"
    remove: str = "remove_from_cart"
    begin_checkout: str = "checkout_start"
    complete: str = "checkout_complete"

    @property
    def cart(self) -> tuple[str, ...]:
        return (self.add, self.remove, self.begin_checkout, self.complete)

    @property
    def priced(self) -> tuple[str, ...]:
        return (self.add, self.remove)


@dataclass(frozen=True)
class OrderStates:
    open: str = "in_transit"
    cancelled: str = "cancelled"
    done: str = "delivered"


@dataclass(frozen=True)
class CartPolicy:
    """When a cart counts as abandoned and how it is ranked."""

    idle_minutes: int = 30
    stale_days: int = 7
    recency_scale_minutes: float = 180.0
    value_percentile: float = 0.90
    loyal_score: float = 100.0
    new_score: float = 40.0
    recency_weight: float = 0.45
    value_weight: float = 0.40
    loyalty_weight: float = 0.15
    # None: the percentile is taken over the carts being scored. A number of days takes it over
    # every cart idle for at most that long instead.
    percentile_days: int | None = None
    completed_orders_only: bool = False


@dataclass(frozen=True)
class RiskPolicy:
    backorder_score: float = 100.0
    time_weight: float = 0.5
    inventory_weight: float = 0.3
    carrier_weight: float = 0.2


ACTION_THRESHOLD = 60
TRAILING_DAYS = 30
