"""Sessions, and the orders that came out of them within a bounded time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, days
from signalloom.model import TRAILING_DAYS, EventNames
from signalloom.operators.carts import conversion_lags
from signalloom.operators.sessions import sessionize
from signalloom.operators.staging import staged

#: Days after a session's first event in which an order counts as its outcome.
CONVERSION_DAYS = 7


def _cell(at: str, n_days: int) -> Column:
    return F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(n_days * 86_400_000_000)).cast("long")


def followed_within(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, n_days: int
) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose right time is at most ``n_days`` after the left one, both ends included.

    Time is cut into cells of ``n_days``. A right row is in one cell and a left row names two, its own and the next:
    whatever may follow it is in them, and a pair meets once. Keys and cell together are an equi-join, so a key with
    a long history is spread over its cells and never compared as a whole. Null keys and times match nothing.
    """
    clash = {*left.columns} & {*right.columns} - {*keys}
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    cells = F.array(_cell(left_at, n_days), _cell(left_at, n_days) + 1)
    a = left.where(F.col(left_at).isNotNull()).withColumn("_cell", F.explode(cells))
    b = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    b = b.withColumn("_r_cell", _cell(right_at, n_days))
    same = reduce(and_, [F.col(k) == F.col(f"_r_{k}") for k in keys]) & (F.col("_cell") == F.col("_r_cell"))
    in_time = F.col(right_at).between(F.col(left_at), F.col(left_at) + days(n_days))
    return a.join(b, same & in_time).drop("_cell", "_r_cell", *[f"_r_{k}" for k in keys])


def visits(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """(session_id, session_number, started_at, customer_id, cart_id): each session with the carts that it names.

    ``started_at`` is the session's first event of any kind. A session that names several carts, or a cart under
    several customers, has a row for each; events without both, or without a session, are no visit.
    """
    numbered = sessionize(
        events.select("event_id", "session_id", "event_timestamp", "customer_id", "cart_id"), gap_minutes=gap_minutes
    )
    numbered = numbered.where(F.col("session_number").isNotNull())
    seen = numbered.groupBy("session_id", "session_number", "customer_id", "cart_id").agg(F.min("event_timestamp").alias("_at"))
    first = F.min("_at").over(Window.partitionBy("session_id", "session_number"))
    return (
        seen.withColumn("started_at", first)
        .where(F.col("cart_id").isNotNull() & F.col("customer_id").isNotNull())
        .select("session_id", "session_number", "started_at", "customer_id", "cart_id")
    )


def linked_visits(sessions: DataFrame, orders: DataFrame, n_days: int = CONVERSION_DAYS) -> DataFrame:
    """``visits`` with order_id and order_created_at of the orders that came out of them.

    An order belongs to a visit if customer and cart are the same and it was placed within ``n_days`` of the session's
    first event. A visit with several orders has a row for each, one without any has nulls. Orders without a cart
    belong to no visit.
    """
    placed = orders.select("customer_id", "cart_id", "order_id", "order_created_at")
    pairs = followed_within(sessions, placed, ["customer_id", "cart_id"], "started_at", "order_created_at", n_days)
    key = ["session_id", "session_number", "customer_id", "cart_id"]
    found = pairs.select(*[F.col(c).alias(f"_p_{c}") for c in key], "order_id", "order_created_at")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in key])
    return sessions.join(found, same, "left").drop(*[f"_p_{c}" for c in key])


def linked_conversion_lags(
    events: DataFrame,
    orders: DataFrame,
    as_of: AsOf = None,
    names: EventNames = EventNames(),
    n_days: int | None = TRAILING_DAYS,
    within_days: int = CONVERSION_DAYS,
) -> DataFrame:
    """``conversion_lags`` of the carts that an order came out of within ``within_days``, as documented."""
    pairs = linked_visits(visits(events), orders, within_days)
    converted = staged(pairs.where(F.col("order_id").isNotNull()).select("cart_id").distinct(), "converted-carts")
    return conversion_lags(events, as_of, names, n_days).join(converted, "cart_id", "left_semi")
