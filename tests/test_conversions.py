import datetime as dt
import random

import pytest
from conftest import NOW, plan_of, rows

from signalloom.model import EventNames
from signalloom.operators import conversions
from signalloom.session import scratch_path
from signalloom.streaming import stateful

EVENTS = "event_id STRING, session_id STRING, customer_id STRING, cart_id STRING, event_type STRING, event_timestamp TIMESTAMP"
ORDERS = "order_id STRING, customer_id STRING, cart_id STRING, order_created_at TIMESTAMP"


def at(**parts):
    return NOW + dt.timedelta(**parts)


@pytest.mark.parametrize("n_days", [1, 7])
def test_bounded_join_is_that_of_all_pairs(spark, n_days):
    rng = random.Random(n_days)
    moment = lambda: None if rng.random() < 0.05 else NOW + dt.timedelta(hours=rng.randrange(-400, 900), seconds=rng.choice([0, 1]))
    key = lambda: rng.choice(["a", "b", "c", None])
    left = [(i, key(), moment()) for i in range(150)] + [(900, "a", NOW), (900, "a", NOW)]
    right = [(i, key(), moment()) for i in range(150)] + [(901, "a", NOW + dt.timedelta(days=n_days)), (902, "a", NOW), (903, "a", NOW + dt.timedelta(days=n_days, microseconds=1))]
    a = spark.createDataFrame(left, "l INT, k STRING, s TIMESTAMP")
    b = spark.createDataFrame(right, "r INT, k STRING, o TIMESTAMP")
    found = conversions.followed_within(a, b, ["k"], "s", "o", n_days)
    span = dt.timedelta(days=n_days)
    expected = sorted((x[0], y[0]) for x in left for y in right if x[1] and x[1] == y[1] and x[2] and y[2] and x[2] <= y[2] <= x[2] + span)
    assert sorted((r.l, r.r) for r in found.collect()) == expected
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    with pytest.raises(ValueError, match="both sides have o"):
        conversions.followed_within(b, b, ["k"], "o", "o", n_days)


def sample(spark):
    events = [
        ("1", "S1", "C1", None, "page_view", at(minutes=-20)),
        ("2", "S1", "C1", "K1", "add_to_cart", at()),
        ("3", "S1", "C1", "K2", "add_to_cart", at(minutes=10)),
        ("4", "S1", "C1", "K1", "checkout_complete", at(hours=20)),
        ("5", "S2", "C2", "K3", "add_to_cart", at()),
        ("6", "S3", None, "K4", "add_to_cart", at()),
        ("7", None, "C5", "K5", "add_to_cart", at()),
    ]
    orders = [
        ("in", "C1", "K1", at(days=6)),
        ("edge", "C1", "K2", at(days=7, minutes=-20)),
        ("late", "C2", "K3", at(days=7, seconds=1)),
        ("early", "C1", "K2", at(minutes=-21)),
        ("other", "C9", "K1", at(days=1)),
        ("none", "C4", None, at(days=1)),
    ]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(orders, ORDERS)


def test_orders_belong_to_visits_of_the_week_before(spark):
    events, orders = sample(spark)
    linked = conversions.linked_visits(conversions.visits(events), orders)
    assert rows(linked, "cart_id", "session_number", "order_id") == [("K1", 1, "in"), ("K1", 2, "in"), ("K2", 1, "edge"), ("K3", 1, None)]
    lags = conversions.linked_conversion_lags(events, orders, at(days=8), EventNames())
    assert rows(lags, "cart_id", "lag_minutes") == [("K1", 1200.0)]
    assert conversions.linked_visits(conversions.visits(events.where("false")), orders).isEmpty()


def test_streams_link_across_batches_and_restarts(spark):
    events, orders = sample(spark)
    root = scratch_path(spark, "linkage")
    events, orders = events.coalesce(1), orders.coalesce(1)
    ahead = [("9", "S9", None, None, "page_view", at(days=30))], [("far", "C9", "K9", at(days=30))]
    # Orders before events, half of each, the rest, and then what moves both watermarks on.
    rounds = [
        (None, orders.where("order_id IN ('in', 'late')")),
        (events.where("event_id IN ('1', '2', '3')"), orders.where("order_id NOT IN ('in', 'late')")),
        (events.where("event_id NOT IN ('1', '2', '3')"), None),
        (spark.createDataFrame(ahead[0], EVENTS), spark.createDataFrame(ahead[1], ORDERS)),
    ]
    for folder, schema in (("e", EVENTS), ("o", ORDERS)):
        spark.createDataFrame([], schema).write.parquet(f"{root}/{folder}")
    for some_events, some_orders in rounds:
        for part, folder in ((some_events, "e"), (some_orders, "o")):
            if part is not None:
                part.write.mode("append").parquet(f"{root}/{folder}")
        linked = stateful.linked_visits(
            spark.readStream.schema(EVENTS).parquet(f"{root}/e"), spark.readStream.schema(ORDERS).parquet(f"{root}/o"), lateness="3 days"
        )
        stateful.start_append(linked, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{root}/out")
    batch = conversions.linked_visits(conversions.visits(events), orders).where("order_id IS NOT NULL")
    columns = ["session_id", "started_at", "customer_id", "cart_id", "order_id"]
    assert rows(found, *columns) == rows(batch, *columns)
    assert {r.order_id for r in found.collect()} == {"in", "edge"}
