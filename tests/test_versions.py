import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from signalloom.operators import staging, versions
from signalloom.plans import executive
from signalloom.session import scratch_path

FACTS = "order_id STRING, customer_id STRING, status STRING, order_total_usd DOUBLE, promised_delivery_date DATE"
DAY = dt.date(2024, 3, 1)


def day(n):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n)


def extract(spark, states):
    return spark.createDataFrame([(o, "C1", s, 10.0, DAY) for o, s in states.items()], FACTS)


def record(spark, extracts, complete=False):
    path = scratch_path(spark, "history")
    for n, states in extracts:
        versions.record_extract(spark, extract(spark, states), path, ["order_id"], day(n), complete=complete)
    return path


def spans(spark, path):
    found = versions.intervals(versions.read_history(spark, path), ["order_id"])
    return sorted(
        ((r.order_id, r.status, (r.valid_from - day(0)).days, r.valid_to and (r.valid_to - day(0)).days) for r in found.collect()),
        key=lambda r: (str(r[0]), r[2]),
    )


def test_states_hold_until_the_next_extract_that_differs(spark):
    path = record(spark, [(0, {"a": "open", "b": "open"}), (3, {"a": "open", "b": "done", "c": None}), (5, {"a": "done", "b": "done", "c": "open"})])
    assert spans(spark, path) == [("a", "open", 0, 5), ("a", "done", 5, None), ("b", "open", 0, 3), ("b", "done", 3, None), ("c", None, 3, 5), ("c", "open", 5, None)]
    # Only what changed was written again.
    assert versions.read_history(spark, path).count() == 6


def test_recording_again_changes_nothing_and_deletions_end_a_state(spark):
    extracts = [(0, {"a": "open", None: "open"}), (2, {"a": "open"}), (4, {"a": "open", None: "open"})]
    once = record(spark, extracts, complete=True)
    expected = [(None, "open", 0, 2), (None, "open", 4, None), ("a", "open", 0, None)]
    assert spans(spark, once) == expected
    for n, states in extracts[::-1] + extracts:
        versions.record_extract(spark, extract(spark, states), once, ["order_id"], day(n), complete=True)
    assert spans(spark, once) == expected
    assert spans(spark, record(spark, extracts)) == [(None, "open", 0, None), ("a", "open", 0, None)]


def test_new_facts_are_a_change(spark):
    path = record(spark, [(0, {"a": "open"})])
    wider = extract(spark, {"a": "open"}).withColumn("carrier", F.lit("x"))
    versions.record_extract(spark, wider, path, ["order_id"], day(1))
    found = versions.intervals(versions.read_history(spark, path), ["order_id"])
    assert rows(found, "carrier", "valid_from") == [("x", day(1)), (None, day(0))]
    versions.record_extract(spark, extract(spark, {"a": "open"}), path, ["order_id"], day(2))
    found = versions.intervals(versions.read_history(spark, path), ["order_id"])
    assert rows(found, "carrier", "valid_to") == [("x", day(2)), (None, day(1)), (None, None)]
    with pytest.raises(ValueError, match="later extracts"):
        versions.record_extract(spark, wider, path, ["order_id"], day(1) + dt.timedelta(hours=1))


def test_as_of_join_is_that_of_a_scan(spark):
    rng = random.Random(1)
    history = defaultdict(list)
    extracts = []
    for n in range(0, 20, 2):
        states = {f"o{i}": rng.choice(["open", "open", "done", "lost"]) for i in range(40) if rng.random() < 0.9}
        extracts.append((n, states))
        for o, s in states.items():
            history[o].append((n, s))
    table = versions.intervals(versions.read_history(spark, record(spark, extracts)), ["order_id"])
    asked = [(f"o{rng.randrange(45)}", day(rng.randrange(-3, 25)) + dt.timedelta(hours=rng.choice([0, 5]))) for _ in range(300)] + [(None, day(3))]
    at = spark.createDataFrame(asked, "order_id STRING, at TIMESTAMP")
    joined = versions.as_of(at, table.select("order_id", "status", "valid_from", "valid_to"), ["order_id"], "at")
    expected = [(o, t, next((s for n, s in reversed(history[o]) if day(n) <= t), None)) for o, t in asked]
    assert rows(joined, "order_id", "at", "status") == rows(spark.createDataFrame(expected, "order_id STRING, at TIMESTAMP, status STRING"))
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)
    with pytest.raises(ValueError, match="status"):
        versions.as_of(at.withColumn("status", F.lit(1)), table, ["order_id"], "at")


def test_spans_of_a_key_become_one_where_they_meet(spark):
    d = lambda n: DAY + dt.timedelta(days=n)
    data = [("a", d(0), d(2)), ("a", d(2), d(4)), ("a", d(1), d(2)), ("a", d(6), None), ("a", d(7), d(8)), ("b", d(3), d(4)), (None, d(1), d(2))]
    found = versions.merged_spans(spark.createDataFrame(data, "k STRING, s DATE, e DATE"), "k", "s", "e")
    assert rows(found, "k", "s", "e") == [("a", d(0), d(4)), ("a", d(6), dt.date(9999, 12, 31)), ("b", d(3), d(4))]


def test_an_order_delivered_later_is_open_on_the_days_before(spark):
    extracts = [(0, {"a": "in_transit", "b": "in_transit"}), (10, {"a": "delivered", "b": "in_transit"})]
    states = versions.intervals(versions.read_history(spark, record(spark, extracts)), ["order_id"])
    shipments = spark.createDataFrame(
        [(o, "x", 5, 10.0) for o in "ab"],
        "order_id STRING, carrier STRING, carrier_avg_transit_days INT, carrier_historical_late_rate_pct DOUBLE",
    )
    items = spark.createDataFrame([(o, "s") for o in "ab"], "order_id STRING, sku STRING")
    stock = spark.createDataFrame([("s", True)], "sku STRING, backorder_flag BOOLEAN")
    first, last = DAY - dt.timedelta(days=1), DAY + dt.timedelta(days=12)
    by_day = lambda orders: {r[0]: r[1] for r in executive.delayed_revenue_by_day(orders, shipments, items, stock, first, last).collect()}
    recorded = by_day(states)
    expected = {first + dt.timedelta(days=n): None if n == 0 else 20.0 if n <= 10 else 10.0 for n in range(14)}
    assert recorded == expected
    # Today's states alone hide the open days of the delivered order.
    assert set(by_day(states.where("valid_to IS NULL").drop("valid_from", "valid_to")).values()) <= {None, 10.0}


def test_a_new_extract_is_written_once(spark, monkeypatch):
    """Only one that is recorded again, whose folder is read, is written beside it first."""
    written = []
    monkeypatch.setattr(versions, "staged", lambda df, label: written.append(label) or staging.staged(df, label))
    extracts = [(0, {"a": "open", None: "open"}), (3, {"a": "done", None: "open"}), (5, {"a": "done", "b": "open"})]
    path = record(spark, extracts)
    assert written == []
    expected = [(None, "open", 0, None), ("a", "open", 0, 3), ("a", "done", 3, None), ("b", "open", 5, None)]
    assert spans(spark, path) == expected
    versions.record_extract(spark, extract(spark, extracts[1][1]), path, ["order_id"], day(3))
    assert written == ["changes"] and spans(spark, path) == expected
