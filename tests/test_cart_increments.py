import datetime as dt
import random

import pytest
from conftest import NOW, ago, plan_of, rows
from pyspark.sql import functions as F

from signalloom.model import CartPolicy
from signalloom.plans.cart_increments import CartStore
from signalloom.plans.cart_recovery import SIGNAL_COLUMNS, cart_recovery_signal
from signalloom.session import scratch_path

EVENTS = "event_id STRING, cart_id STRING, customer_id STRING, event_type STRING, event_timestamp TIMESTAMP, price_at_event DOUBLE, quantity INT"
ORDERS = "order_id STRING, customer_id STRING, status STRING"
KINDS = ["add_to_cart", "add_to_cart", "add_to_cart", "remove_from_cart", "checkout_start", "page_view", None]


def event(n, cart, at, kind="add_to_cart", price=10.0, customer="C1"):
    return (f"e{n}", cart, customer, kind, at, price, 1)


def frame(spark, data):
    return spark.createDataFrame(data, EVENTS)


def orders(spark):
    return spark.createDataFrame([("o1", "C1", "delivered"), ("o2", "C2", "cancelled")], ORDERS)


def advanced(spark, increments, times, **options):
    store = CartStore(scratch_path(spark, "carts"), n_buckets=4)
    for n, (data, at) in enumerate(zip(increments, times)):
        store.advance(spark, n, frame(spark, data), at, **options)
    return store


@pytest.mark.parametrize("policy", [CartPolicy(), CartPolicy(percentile_days=12)])
def test_increments_give_the_rows_of_a_full_run(spark, policy):
    rng = random.Random(3)
    times = [NOW - dt.timedelta(days=x) for x in (14, 9, 3, 0)]
    data, arrival = [], []
    for n in range(1500):
        cart = None if rng.random() < 0.02 else f"K{rng.randrange(160)}"
        at = NOW - dt.timedelta(minutes=rng.randrange(-600, 30_000) if cart is None else int(cart[1:]) * 180 + rng.randrange(-300, 300))
        kind = "checkout_complete" if rng.random() < 0.03 else rng.choice(KINDS)
        data.append((f"e{n}", cart, rng.choice(["C1", "C2", None]), kind, at, rng.choice([5.0, 20.0, None]), rng.randrange(1, 4)))
        arrival.append(min(3, max(0, sum(at > t for t in times[:3]) + rng.choice([0, 0, 0, 1, 2, 3, -1]))))
    increments = [[d for d, a in zip(data, arrival) if a == n] for n in range(4)]
    store = advanced(spark, increments, times, policy=policy)
    columns = SIGNAL_COLUMNS[:-1]
    for n, at in enumerate(times):
        seen = frame(spark, [d for d, a in zip(data, arrival) if a <= n])
        full = cart_recovery_signal(seen, orders(spark), at, policy=policy, percentile_method="discrete")
        part = store.signal(spark, n, orders(spark), at, policy=policy, percentile_method="discrete")
        # Amounts are added in another order.
        rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(*columns).dtypes])
        assert rows(rounded(part)) == rows(rounded(full))
        assert n == 0 or not full.isEmpty()
    # Run again, an increment leaves what it left before.
    before = rows(store.carts(spark, 2))
    store.advance(spark, 2, frame(spark, increments[2]), times[2], policy=policy)
    assert rows(store.carts(spark, 2)) == before


def test_a_dormant_cart_returns_with_its_history(spark):
    first = [event(1, "old", ago(days=20), price=70.0, customer="C2"), event(2, "other", ago(days=20))]
    store = advanced(spark, [first, [event(3, "new", ago(days=8))], [event(4, "old", ago(hours=2), price=5.0)]], [ago(days=19), ago(days=8), NOW])
    assert rows(store.carts(spark, 1), "cart_id") == [("new",)]
    found = rows(store.carts(spark, 2), "cart_id", "customer_id", "added_value", "n_adds")
    assert found == [("old", "C2", 75.0, 2)]


def test_only_buckets_of_returned_carts_are_read(spark):
    first = [event(i, f"K{i}", ago(days=20)) for i in range(50)]
    store = advanced(spark, [first, [event(99, "later", ago(days=8))]], [ago(days=19), ago(days=8)])
    found = store._returned(spark, frame(spark, [event(1, "K7", NOW)]), 2)
    assert [r.cart_id for r in found.collect()] == ["K7"]
    assert "cart_bucket_no" in plan_of(found).split("PartitionFilters")[1].split("]")[0]
    assert len([p for p in found.inputFiles() if "cart_bucket_no" in p]) < 50


def test_events_of_the_future_wait(spark):
    early = [event(1, "K", ago(hours=30)), event(2, "K", ago(hours=3), "checkout_complete")]
    store = advanced(spark, [early, [], []], [ago(hours=10), ago(hours=5), NOW])
    signal = lambda n, at: rows(store.signal(spark, n, orders(spark), at, percentile_method="discrete"), "cart_id")
    assert signal(0, ago(hours=10)) == signal(1, ago(hours=5)) == [("K",)]
    assert signal(2, NOW) == []


def test_increments_have_no_gaps(spark):
    with pytest.raises(ValueError, match="increment 0"):
        CartStore(scratch_path(spark, "carts")).advance(spark, 1, frame(spark, []), NOW)
