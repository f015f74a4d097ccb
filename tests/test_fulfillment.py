import datetime as dt
import uuid

import pytest
from conftest import NOW, ago, plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalloom.operators import fulfillment, layout, staging
from signalloom.plans.fulfillment_risk import SIGNAL_COLUMNS, fulfillment_risk_signal
from signalloom.session import scratch_path

TODAY = NOW.date()
ORDERS = "order_id STRING, customer_id STRING, order_total_usd DOUBLE, status STRING, promised_delivery_date DATE"
SHIPMENTS = "order_id STRING, carrier STRING, carrier_avg_transit_days INT, carrier_historical_late_rate_pct DOUBLE"
ITEMS = "order_id STRING, sku STRING"
STOCK = "sku STRING, warehouse_id STRING, backorder_flag BOOLEAN"


def in_days(n):
    return TODAY + dt.timedelta(days=n)


def tables(spark):
    orders = [
        ("late", "c", 10.0, "in_transit", in_days(-3)),
        ("half", "c", 10.0, "in_transit", in_days(2)),
        ("far", "c", 10.0, "in_transit", in_days(30)),
        ("zero", "c", 10.0, "in_transit", in_days(1)),
        ("unknown", "c", 10.0, "in_transit", in_days(1)),
        ("done", "c", 10.0, "delivered", in_days(1)),
        ("nopromise", "c", 10.0, "in_transit", None),
        ("unshipped", "c", 10.0, "in_transit", in_days(1)),
    ]
    transit = {"late": 4, "half": 4, "far": 4, "zero": 0, "unknown": None, "done": 4, "nopromise": 4}
    return (
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame([(k, "x", v, 10.0) for k, v in transit.items()], SHIPMENTS),
        spark.createDataFrame([("late", "s1"), ("half", "s1"), ("half", "s2"), ("far", "s3")], ITEMS),
        spark.createDataFrame([("s1", "w", False), ("s2", "w", False), ("s2", "v", True), ("s3", "w", None)], STOCK),
    )


EXPECTED = [
    ("far", 30, 0.0, 0.0, 2.0),
    ("half", 2, 50.0, 100.0, 57.0),
    ("late", -3, 100.0, 0.0, 52.0),
    ("unknown", 1, 0.0, 0.0, 2.0),
    ("zero", 1, 0.0, 0.0, 2.0),
]
SCORES = ["order_id", "days_to_promise", "time_pressure_score", "inventory_risk_score", "fulfillment_risk_score"]


def test_open_promised_shipped_orders_are_scored(spark):
    out = fulfillment_risk_signal(*tables(spark), NOW)
    assert out.columns == SIGNAL_COLUMNS
    assert rows(out, *SCORES) == EXPECTED


def test_same_scores_when_back_orders_are_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(staging.broadcast_if_small, "__defaults__", (None, 0))
    assert rows(fulfillment_risk_signal(*tables(spark), NOW), *SCORES) == EXPECTED


def test_one_row_per_order_however_many_warehouses(spark):
    orders, _, items, stock = tables(spark)
    assert fulfillment.with_inventory_risk(orders, items, stock).count() == orders.count()


def test_on_time_rate(spark):
    df = spark.createDataFrame(
        [
            (ago(days=1), in_days(0)),
            (ago(days=1), in_days(-5)),
            (ago(days=30), in_days(0)),
            (ago(days=30, seconds=1), in_days(-60)),
            (None, in_days(0)),
            (ago(days=2), None),
        ],
        "delivered_at TIMESTAMP_NTZ, promised_delivery_date DATE",
    )
    assert fulfillment.on_time_rate(df, NOW).first()[0] == pytest.approx(2 / 3)
    assert fulfillment.on_time_rate(df.where("false"), NOW).first()[0] is None


def scored(spark, data):
    df = spark.createDataFrame(
        [(i, in_days(d), t, b, r) for i, (d, t, b, r) in enumerate(data)],
        """order_id INT, promised_delivery_date DATE, carrier_avg_transit_days INT, has_backordered_item BOOLEAN,
        carrier_risk_score DOUBLE""",
    )
    return fulfillment.with_risk_scores(df, F.lit(TODAY)).orderBy("order_id").collect()


order = st.tuples(st.integers(-30, 60), st.integers(1, 14), st.booleans(), st.floats(0, 100))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(order, min_size=1, max_size=8))
def test_scores_stay_between_0_and_100(spark, data):
    for row in scored(spark, data):
        for part in ("time_pressure_score", "inventory_risk_score", "carrier_risk_score", "fulfillment_risk_score"):
            assert -1e-6 <= row[part] <= 100 + 1e-6


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-30, 60), min_size=2, max_size=8), st.integers(1, 14))
def test_pressure_never_grows_as_the_promise_moves_out(spark, offsets, transit):
    out = scored(spark, [(d, transit, False, 0.0) for d in sorted(offsets)])
    pressure = [r.time_pressure_score for r in out]
    assert all(a >= b for a, b in zip(pressure, pressure[1:]))


def test_tables_stored_by_order_are_joined_without_a_shuffle(spark, monkeypatch):
    orders, shipments, items, stock = tables(spark)
    expected = rows(fulfillment_risk_signal(orders, shipments, items, stock, NOW).drop("_gold_computed_at"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        label = uuid.uuid4().hex
        stored = [
            layout.write_bucketed(df, f"{name}_{label}", scratch_path(spark, name), "order_id", 4)
            for name, df in (("o", orders), ("s", shipments), ("i", items))
        ]
        signal = fulfillment_risk_signal(*stored, stock, NOW).drop("_gold_computed_at")
        plan = plan_of(signal)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "hashpartitioning(order_id" not in plan
        assert "hashpartitioning(order_id" in plan_of(fulfillment_risk_signal(orders, shipments, items, stock, NOW))
        assert rows(signal) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
