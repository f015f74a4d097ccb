"""Joins that stay balanced when keys are missing or hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.operators.staging import broadcast_if_small, staged_with_size


def lookup(df: DataFrame, dimension: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join to one row per ``key``.

    Rows without a key cannot match, yet would all be shuffled to the same task. They are joined
    on ``spread`` (any high-cardinality column) instead, and whatever that meets is discarded.
    The join takes no hint: Spark broadcasts a side it knows to be small, and adaptive execution
    splits the partitions of hot keys on the left. It can do so only if the dimension comes straight
    from a table; one that was aggregated has to be ``staged`` first.
    """
    found = [c for c in dimension.columns if c != key]
    right = dimension.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_d_{c}") for c in found])
    joined = df.join(right, F.coalesce(F.col(key), F.col(spread).cast("string")) == F.col("_key"), "left")
    has_key = F.col(key).isNotNull()
    return joined.select(*df.columns, *[F.when(has_key, F.col(f"_d_{c}")).alias(c) for c in found])


def price_fallback(events: DataFrame, products: DataFrame) -> DataFrame:
    """``price_at_event``, else the current product price, as ``effective_price``."""
    priced = lookup(events, products.select("sku", F.col("price").alias("_list_price")), "sku", "event_id")
    return priced.withColumn(
        "effective_price", F.coalesce("price_at_event", "_list_price")
    ).drop("_list_price")


def link_orders(carts: DataFrame, orders: DataFrame) -> DataFrame:
    """Carts with the order that came out of them, if any, by customer and cart."""
    return carts.join(
        orders.where(F.col("cart_id").isNotNull()).select("customer_id", "cart_id", "order_id", "order_created_at"),
        ["customer_id", "cart_id"],
        "left",
    )


def orders_by_origin(orders: DataFrame) -> DataFrame:
    """Orders with and without a cart trail."""
    return orders.agg(
        F.count_if(F.col("cart_id").isNotNull()).alias("n_with_cart"),
        F.count_if(F.col("cart_id").isNull()).alias("n_without_cart"),
    )


def rows_of_recent_carts(events: DataFrame, recent: Column) -> DataFrame:
    """Whole history of the carts that have at least one event for which ``recent`` holds.

    The ids come from the recent partitions alone, and are written once. When they are few enough to
    broadcast, the history is reduced in its scan; otherwise both sides are shuffled, and adaptive
    execution splits hot carts.
    """
    ids, size = staged_with_size(
        events.where(recent).select(F.col("cart_id").alias("_recent_id")).distinct(), "recent-carts"
    )
    return events.join(broadcast_if_small(ids, size), F.col("cart_id").eqNullSafe(F.col("_recent_id")), "left_semi")
