import datetime as dt
import math
import re

import pytest
from conftest import NOW, ago, plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalloom.model import CartPolicy, OrderStates
from signalloom.operators import joins, staging
from signalloom.operators.carts import abandoned_carts, cart_state, conversion_lags
from signalloom.plans import cart_recovery
from signalloom.plans.cart_recovery import cart_recovery_signal, score_carts, top, value_cap

EVENTS = """event_id STRING, cart_id STRING, customer_id STRING, event_type STRING,
    event_timestamp TIMESTAMP_NTZ, price_at_event DOUBLE, quantity INT"""
ORDERS = "customer_id STRING, status STRING"


def events(spark, *data):
    return spark.createDataFrame([(f"e{i}", *row) for i, row in enumerate(data)], EVENTS)


def four_carts(spark):
    return events(
        spark,
        ("A", "CA", "add_to_cart", ago(minutes=90), 40.0, 3),
        ("B", "CB", "add_to_cart", ago(minutes=12), 15.0, 1),
        ("C", "CC", "add_to_cart", ago(days=9), 15.0, 1),
        ("D", "CD", "add_to_cart", ago(hours=2), 35.0, 1),
        ("D", "CD", "checkout_complete", ago(hours=1), None, None),
    )


def test_only_the_idle_unfinished_recent_cart_is_abandoned(spark):
    out = abandoned_carts(cart_state(four_carts(spark)), NOW)
    assert rows(out, "cart_id", "recoverable_cart_value", "minutes_since_last_activity") == [("A", 120.0, 90.0)]


def test_removed_items_are_deducted(spark):
    df = events(
        spark,
        ("A", "C", "add_to_cart", ago(minutes=70), 80.0, 2),
        ("A", "C", "remove_from_cart", ago(minutes=60), 80.0, 1),
        ("A", "C", "add_to_cart", ago(minutes=50), 7.5, 4),
    )
    row = abandoned_carts(cart_state(df), NOW).first()
    assert (row.recoverable_cart_value, row.item_count) == (110.0, 1)


def test_value_and_count_never_fall_below_zero_and_missing_prices_count_nothing(spark):
    df = events(
        spark,
        ("A", "C", "add_to_cart", ago(minutes=50), 10.0, 1),
        ("A", "C", "remove_from_cart", ago(minutes=48), 10.0, 3),
        ("A", "C", "remove_from_cart", ago(minutes=47), 10.0, 3),
        ("B", "C", "add_to_cart", ago(minutes=50), None, 1),
    )
    out = abandoned_carts(cart_state(df), NOW)
    assert rows(out, "cart_id", "recoverable_cart_value", "item_count") == [("A", 0.0, 0), ("B", 0.0, 1)]


def test_both_time_limits_are_exclusive(spark):
    df = events(
        spark,
        ("idle30", "C", "add_to_cart", ago(minutes=30), 1.0, 1),
        ("idle30+", "C", "add_to_cart", ago(minutes=30, seconds=1), 1.0, 1),
        ("week", "C", "add_to_cart", ago(days=7), 1.0, 1),
        ("week-", "C", "add_to_cart", ago(days=6, hours=23), 1.0, 1),
    )
    assert rows(abandoned_carts(cart_state(df), NOW), "cart_id") == [("idle30+",), ("week-",)]


def test_the_customer_is_the_first_one_named(spark):
    df = events(
        spark,
        ("A", None, "add_to_cart", ago(minutes=90), 1.0, 1),
        ("A", "second", "add_to_cart", ago(minutes=80), 1.0, 1),
        ("A", "first", "add_to_cart", ago(minutes=85), 1.0, 1),
        ("B", None, "add_to_cart", ago(minutes=85), 1.0, 1),
        ("A", "viewer", "page_view", ago(minutes=99), None, None),
    )
    assert rows(cart_state(df), "cart_id", "customer_id", "n_adds") == [("A", "first", 3), ("B", None, 1)]


def test_raw_events_are_hashed_not_sorted(spark):
    tree = plan_of(cart_state(four_carts(spark))).split("(1) ")[0]
    assert re.findall(r"\w+Aggregate", tree)[-2:] == ["HashAggregate", "HashAggregate"]


def test_a_buyer_is_loyal(spark):
    orders = spark.createDataFrame([("CA", "delivered"), ("CB", "cancelled")], ORDERS)
    df = events(
        spark,
        ("A", "CA", "add_to_cart", ago(minutes=45), 50.0, 1),
        ("B", "CB", "add_to_cart", ago(minutes=45), 50.0, 1),
        ("G", None, "add_to_cart", ago(minutes=45), 50.0, 1),
    )
    out = cart_recovery_signal(df, orders, NOW)
    assert out.columns == cart_recovery.SIGNAL_COLUMNS
    assert rows(out, "cart_id", "loyalty_score") == [("A", 100.0), ("B", 40.0), ("G", 40.0)]
    row = out.where("cart_id = 'A'").first()
    expected = 0.45 * 100 * math.exp(-45 / 180) + 0.40 * 100 + 0.15 * 100
    assert row.priority_score == pytest.approx(expected)


def test_completed_orders_only(spark):
    orders = spark.createDataFrame([("CA", "in_transit")], ORDERS)
    df = events(spark, ("A", "CA", "add_to_cart", ago(minutes=45), 50.0, 1))
    score = lambda **o: cart_recovery_signal(df, orders, NOW, policy=CartPolicy(**o)).first().loyalty_score
    assert score() == 100.0 and score(completed_orders_only=True) == 40.0


def test_no_abandoned_cart_gives_an_empty_signal_and_worthless_carts_score_zero(spark):
    orders = spark.createDataFrame([], ORDERS)
    fresh = events(spark, ("A", "CA", "add_to_cart", ago(minutes=1), 50.0, 1))
    assert cart_recovery_signal(fresh, orders, NOW).isEmpty()
    free = events(spark, ("A", "CA", "add_to_cart", ago(minutes=45), 0.0, 1))
    assert cart_recovery_signal(free, orders, NOW).first().value_score == 0.0


def test_recent_carts_keep_their_whole_history(spark, monkeypatch):
    df = events(
        spark,
        ("A", "C", "add_to_cart", ago(days=9), 7.0, 1),
        ("A", "C", "checkout_start", ago(hours=1), None, None),
        ("old", "C", "add_to_cart", ago(days=9), 7.0, 1),
    )
    recent = F.col("event_timestamp") > F.lit(str(ago(days=7))).cast("timestamp_ntz")
    reduced = joins.rows_of_recent_carts(df, recent)
    assert rows(reduced, "event_id") == [("e0",), ("e1",)]
    expected = rows(abandoned_carts(cart_state(df), NOW))
    assert rows(abandoned_carts(cart_state(reduced), NOW)) == expected
    monkeypatch.setattr(staging.broadcast_if_small, "__defaults__", (None, 0))
    assert rows(joins.rows_of_recent_carts(df, recent), "event_id") == [("e0",), ("e1",)]


def test_the_signal_is_the_same_with_and_without_days_to_prune_by(spark):
    orders = spark.createDataFrame([("CA", "delivered")], ORDERS)
    df = four_carts(spark).unionByName(
        events(spark, ("A", "CA", "add_to_cart", ago(days=20), 3.0, 1), (None, "N", "add_to_cart", ago(hours=2), 1.0, 1))
    )
    by_day = df.withColumn("event_date", F.to_date("event_timestamp"))
    plain, narrowed = (cart_recovery_signal(e, orders, NOW).drop("_gold_computed_at") for e in (df, by_day))
    assert rows(narrowed) == rows(plain)
    assert rows(plain, "cart_id", "recoverable_cart_value") == [("A", 123.0), (None, 1.0)]


def test_top_is_ranked_with_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "cart_id STRING, priority_score DOUBLE")
    assert [r.cart_id for r in top(df, "priority_score", "cart_id", 2).collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan_of(top(df, "priority_score", "cart_id", 2))


def test_conversion_lags(spark):
    df = events(
        spark,
        ("A", "C", "add_to_cart", ago(minutes=90), 1.0, 1),
        ("A", "C", "add_to_cart", ago(minutes=60), 1.0, 1),
        ("A", "C", "checkout_complete", ago(minutes=30), None, None),
        ("B", "C", "checkout_complete", ago(minutes=30), None, None),
        ("O", "C", "add_to_cart", ago(days=40), 1.0, 1),
        ("O", "C", "checkout_complete", ago(days=31), None, None),
        (None, "C", "checkout_complete", ago(minutes=30), None, None),
    )
    assert rows(conversion_lags(df, NOW), "cart_id", "lag_minutes") == [("A", 60.0), ("B", None)]


values = st.floats(0, 1e6)
idle = st.floats(0, 1e5)


def scored(spark, carts):
    df = spark.createDataFrame(
        [(f"c{i}", f"u{i}", NOW, m, v, 1) for i, (v, m) in enumerate(carts)],
        """cart_id STRING, customer_id STRING, last_activity_at TIMESTAMP_NTZ, minutes_since_last_activity DOUBLE,
        recoverable_cart_value DOUBLE, item_count INT""",
    )
    orders = spark.createDataFrame([("u0", "delivered")], ORDERS)
    policy = CartPolicy()
    return score_carts(df, orders, value_cap(df, policy, "approx"), OrderStates(), policy)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(values, idle), min_size=1, max_size=8))
def test_scores_stay_between_0_and_100(spark, carts):
    for row in scored(spark, carts).collect():
        for part in ("recency_score", "value_score", "loyalty_score", "priority_score"):
            assert -1e-6 <= row[part] <= 100 + 1e-6


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, min_size=2, max_size=8), idle)
def test_priority_never_falls_with_value(spark, amounts, minutes):
    out = scored(spark, [(0.0, minutes)] + [(v, minutes) for v in amounts]).where("cart_id <> 'c0'")
    ordered = sorted((r.recoverable_cart_value, r.priority_score) for r in out.collect())
    assert all(a[1] <= b[1] + 1e-9 for a, b in zip(ordered, ordered[1:]))


def test_time_zone_of_the_evaluation_time_is_honoured(spark):
    df = four_carts(spark).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    shifted = NOW.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=5)))
    assert rows(abandoned_carts(cart_state(df), shifted), "cart_id") == [("A",)]


def test_a_past_close_sees_nothing_later(spark):
    df = events(
        spark,
        ("A", "CA", "add_to_cart", ago(minutes=45), 50.0, 1),
        ("A", "CA", "checkout_complete", ago(minutes=-10), None, None),
        ("B", "CB", "add_to_cart", ago(minutes=45), 20.0, 1),
        ("B", "CB", "add_to_cart", ago(minutes=-5), 20.0, 1),
    )
    orders = spark.createDataFrame([], "customer_id STRING, status STRING")
    signal = cart_recovery_signal(df, orders, NOW)
    assert rows(signal, "cart_id", "recoverable_cart_value") == [("A", 50.0), ("B", 20.0)]
    assert conversion_lags(df, NOW).isEmpty()
    assert conversion_lags(df, NOW + dt.timedelta(hours=1)).count() == 1
