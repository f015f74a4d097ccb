"""Text and date normal forms per table. Tables without an entry pass through unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.functions.text import code, label, tidy


def clickstream(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "customer_id": code("customer_id"),
            "cart_id": tidy("cart_id"),
            "device_type": label("device_type"),
        }
    )


def customers(df: DataFrame) -> DataFrame:
    return df.withColumns({"customer_id": code("customer_id")})


def products(df: DataFrame) -> DataFrame:
    # The category is lower-cased only: its blanks are significant.
    return df.withColumns({"sku": code("sku"), "category": F.lower("category")})


def orders(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "order_id": tidy("order_id"),
            "customer_id": code("customer_id"),
            "order_date": F.to_date("order_created_at"),
        }
    )


def unchanged(df: DataFrame) -> DataFrame:
    return df


STANDARD_FORMS = {
    "clickstream_events": clickstream,
    "customers": customers,
    "products": products,
    "inventory": unchanged,
    "orders": orders,
    "order_items": unchanged,
    "shipments": unchanged,
}


def to_usd(amount: str, rate: str = "fx_rate_to_usd"):
    """Amount in USD at the rate captured on the row."""
    return F.col(amount) * F.col(rate)
