"""Operational report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.functions.tiers import CART_BANDS, ORDER_BANDS, banded
from signalloom.operators.joins import lookup
from signalloom.plans.cart_recovery import ranked


def with_segment(signal: DataFrame, customers: DataFrame, own_id: str) -> DataFrame:
    """``signal`` with ``customer_segment``, null for customers that aren't known."""
    segment = F.when(F.col("is_returning"), "returning").when(~F.col("is_returning"), "new")
    joined = lookup(signal, customers.select("customer_id", "is_returning"), "customer_id", own_id)
    return joined.withColumn("customer_segment", segment).drop("is_returning")


def cart_table(cart_signal: DataFrame, customers: DataFrame) -> DataFrame:
    """Carts with priority tier and customer segment."""
    return with_segment(cart_signal, customers, "cart_id").select(
        "cart_id",
        "customer_id",
        "customer_segment",
        "minutes_since_last_activity",
        "recoverable_cart_value",
        "item_count",
        banded(F.col("priority_score"), CART_BANDS).alias("priority_tier"),
        "priority_score",
    )


def cart_action_list(cart_signal: DataFrame, customers: DataFrame) -> DataFrame:
    return ranked(cart_table(cart_signal, customers), "priority_score", "cart_id")


def order_table(order_signal: DataFrame, customers: DataFrame) -> DataFrame:
    """Open orders with customer segment, risk tier and the part scores that explain it."""
    return with_segment(order_signal, customers, "order_id").select(
        "order_id",
        "customer_id",
        "customer_segment",
        "carrier",
        "promised_delivery_date",
        "days_to_promise",
        "order_total_usd",
        banded(F.col("fulfillment_risk_score"), ORDER_BANDS).alias("risk_tier"),
        "fulfillment_risk_score",
        "time_pressure_score",
        "inventory_risk_score",
        "carrier_risk_score",
    )


def order_action_list(order_signal: DataFrame, customers: DataFrame) -> DataFrame:
    return ranked(order_table(order_signal, customers), "fulfillment_risk_score", "order_id")
