import datetime as dt
import random

import pytest
from conftest import NOW, ago, rows
from pyspark.sql import functions as F

from signalloom.functions.calendar import calendar
from signalloom.functions.tiers import CART_BANDS, banded, percent_label, traffic_light
from signalloom.operators import measures
from signalloom.operators.carts import abandoned_carts, cart_state
from signalloom.operators.fulfillment import with_risk_scores
from signalloom.plans import executive
from signalloom.plans.cart_recovery import cart_recovery_signal
from signalloom.plans.fulfillment_risk import fulfillment_risk_signal

EVENTS = """event_id STRING, cart_id STRING, customer_id STRING, event_type STRING,
    event_timestamp TIMESTAMP_NTZ, price_at_event DOUBLE, quantity INT"""
FIRST, LAST = dt.date(2024, 3, 1), dt.date(2024, 3, 14)


def close(day):
    return dt.datetime.combine(day, dt.time(23, 59))


def random_events(spark):
    """Carts over two weeks, with events right at and around the closing times."""
    rng, data = random.Random(7), []
    kinds = ["add_to_cart"] * 4 + ["remove_from_cart", "checkout_start", "checkout_complete"]
    for i in range(300):
        cart = rng.randrange(60)
        at = dt.datetime(2024, 2, 27) + dt.timedelta(minutes=rng.randrange(17 * 24 * 60))
        if i % 10 == 0:
            at = close(at.date()) + dt.timedelta(microseconds=rng.choice([-1, 0, 1, 30_000_000]))
        customer = rng.choice([None, f"u{cart}", f"u{cart + 1}"])
        data.append((f"e{i}", f"c{cart}", customer, rng.choice(kinds), at, float(rng.randrange(1, 50)), rng.randrange(1, 4)))
    return spark.createDataFrame(data, EVENTS)


def order_tables(spark):
    rng = random.Random(3)
    orders, shipments, items = [], [], []
    for i in range(120):
        promised = FIRST + dt.timedelta(days=rng.randrange(-10, 30))
        delivered = rng.choice([None, dt.datetime(2024, 2, 20) + dt.timedelta(minutes=rng.randrange(20 * 24 * 60))])
        if delivered and i % 6 == 0:
            delivered = close(delivered.date())
        orders.append((f"o{i}", f"u{i % 40}", float(rng.randrange(10, 99)), rng.choice(["in_transit", "delivered", "cancelled"]), promised))
        shipments.append((f"o{i}", "x", delivered, rng.choice([0, 1, 3, 7, 10, None]), float(rng.choice([0, 4, 14, 60, 100])), promised))
        items.append((f"o{i}", f"s{rng.randrange(6)}"))
    return (
        spark.createDataFrame(orders, "order_id STRING, customer_id STRING, order_total_usd DOUBLE, status STRING, promised_delivery_date DATE"),
        spark.createDataFrame(
            shipments,
            """order_id STRING, carrier STRING, delivered_at TIMESTAMP_NTZ, carrier_avg_transit_days INT,
            carrier_historical_late_rate_pct DOUBLE, promised_delivery_date DATE""",
        ),
        spark.createDataFrame(items, "order_id STRING, sku STRING"),
        spark.createDataFrame([("s1", True), ("s2", False), ("s3", True)], "sku STRING, backorder_flag BOOLEAN"),
    )


def test_abandoned_by_day_equals_a_rerun_at_every_close(spark):
    events = random_events(spark).cache()
    columns = ["cart_id", "customer_id", "last_activity_at", "recoverable_cart_value", "item_count", "minutes_since_last_activity"]
    history = executive.abandoned_by_day(events, FIRST, LAST).select("metric_date", *columns).collect()
    for offset in range((LAST - FIRST).days + 1):
        day = FIRST + dt.timedelta(days=offset)
        upto = events.where(F.col("event_timestamp") <= F.lit(str(close(day))).cast("timestamp_ntz"))
        expected = rows(abandoned_carts(cart_state(upto), close(day)), *columns)
        got = sorted((tuple(r[1:]) for r in history if r[0] == day), key=lambda r: tuple((v is None, str(v)) for v in r))
        assert got == expected, day


def test_the_history_equals_a_rerun_of_every_day(spark):
    events, (orders, shipments, items, stock) = random_events(spark).cache(), order_tables(spark)
    history = {
        r.metric_date: r
        for r in executive.summary_history(
            events, orders, shipments, items, stock, FIRST, LAST, method="discrete"
        ).collect()
    }
    assert len(history) == 14
    for offset in (0, 5, 13):
        day = FIRST + dt.timedelta(days=offset)
        now = close(day)
        upto = events.where(F.col("event_timestamp") <= F.lit(str(now)).cast("timestamp_ntz"))
        carts = cart_recovery_signal(upto, orders, now, percentile_method="discrete")
        risk = fulfillment_risk_signal(orders, shipments, items, stock, now)
        assert history[day].recoverable_revenue == pytest.approx(executive.recoverable_revenue(carts).first()[0])
        assert history[day].delayed_order_revenue_risk == pytest.approx(executive.delayed_revenue_risk(risk).first()[0])
        done = shipments.where(F.col("delivered_at") <= F.lit(str(now)).cast("timestamp_ntz"))
        rate = executive.on_time_rate(done, now).first()[0]
        assert history[day].on_time_delivery_rate == pytest.approx(rate, abs=1e-4)


def test_first_day_at_risk_is_that_of_the_score(spark):
    """Each order alone, so that a wrong day of one order cannot hide in a sum."""
    orders, shipments, items, stock = order_tables(spark)
    exposed = executive.with_inventory_risk(
        executive.open_orders_with_shipment(orders, shipments), items, stock
    ).cache()
    by_day = executive.delayed_revenue_by_day(orders, shipments, items, stock, FIRST, LAST)
    got = {r.metric_date: r[1] or 0.0 for r in by_day.collect()}
    for day, total in got.items():
        scored = with_risk_scores(exposed, F.lit(day)).where("fulfillment_risk_score >= 60")
        assert total == pytest.approx(scored.agg(F.coalesce(F.sum("order_total_usd"), F.lit(0.0))).first()[0]), day


def test_the_daily_row_has_nulls_where_there_is_nothing(spark):
    events = spark.createDataFrame([("e", "A", "CA", "add_to_cart", ago(hours=1), 5.0, 1)], EVENTS)
    orders, shipments, items, stock = (df.where("false") for df in order_tables(spark))
    row = executive.daily_summary(
        cart_recovery_signal(events, orders, NOW),
        fulfillment_risk_signal(orders, shipments, items, stock, NOW),
        shipments,
        events,
        NOW,
    )
    assert row.columns == executive.DAILY_COLUMNS
    assert tuple(row.first()) == (NOW.date(), 5.0, 0.0, None, None)


def day(n):
    return dt.date(2024, 1, n)


def daily(spark, data):
    return spark.createDataFrame(
        data,
        """metric_date DATE, recoverable_revenue DOUBLE, delayed_order_revenue_risk DOUBLE,
        on_time_delivery_rate DOUBLE, conversion_lag_median_minutes DOUBLE""",
    )


def test_trailing_sum_counts_days_not_rows(spark):
    df = daily(spark, [(day(n), float(n), 0.0, None, None) for n in (1, 2, 8, 9)])
    out = measures.trailing_sum(df, "recoverable_revenue", 7, "s")
    assert rows(out, "metric_date", "s") == [(day(1), 1.0), (day(2), 3.0), (day(8), 10.0), (day(9), 17.0)]


def test_week_over_week_is_by_date_and_blank_on_zero(spark):
    df = daily(spark, [(day(1), 0.0, 0.0, None, None), (day(2), 2.0, 0.0, None, None), (day(8), 5.0, 0.0, None, None), (day(9), 3.0, 0.0, None, None)])
    out = measures.week_over_week(df, "recoverable_revenue", "w")
    assert rows(out, "metric_date", "w") == [(day(1), None), (day(2), None), (day(8), None), (day(9), 0.5)]


def test_kpi_trend_covers_every_calendar_day(spark):
    df = daily(spark, [(day(n), 10.0, 1.0, 0.96, 30.0) for n in (1, 2, 3)])
    out = measures.kpi_trend(df, calendar(spark, day(1), day(20)), 7).collect()
    by_day = {r.metric_date: r for r in out}
    assert len(out) == 20
    assert by_day[day(9)].recoverable_revenue_trailing == 10.0
    assert by_day[day(8)].recovery_wow == pytest.approx(1.0)
    assert by_day[day(3)].on_time_rate_label == "96.0%" and by_day[day(3)].on_time_light == "green"
    assert by_day[day(20)].recoverable_revenue_trailing is None and by_day[day(20)].on_time_light is None


def test_weekly_rollup_starts_on_monday(spark):
    df = daily(spark, [(day(n), 1.0, 2.0, 0.5, 10.0) for n in (6, 7, 8)])
    out = rows(measures.weekly_rollup(df), "week_start", "n_days", "recoverable_revenue")
    assert out == [(day(1), 2, 2.0), (day(8), 1, 1.0)]


def test_label_of_a_half_rounds_by_its_exact_value_and_none_has_no_label(spark):
    given = [0.9625, 0.9525, 0.9255, 0.9345, 1.0, 0.0, None]
    rates = spark.createDataFrame([(i, r) for i, r in enumerate(given)], "i INT, r DOUBLE")
    found = [r[1] for r in sorted(rates.select("i", percent_label(F.col("r"))).collect())]
    assert found == [None if r is None else "%.1f%%" % (r * 100.0) for r in given]
    assert found[0] == "96.2%"


def test_bands_lights_and_labels(spark):
    df = spark.createDataFrame([(80.0,), (79.9,), (60.0,), (40.0,), (39.9,)], "s DOUBLE")
    names = [r[0][2:] for r in df.select(banded(F.col("s"), CART_BANDS)).collect()]
    assert names == ["Act now", "Today", "Today", "Monitor", "Low"]
    rates = spark.createDataFrame([(0.95,), (0.9499,), (0.9,), (0.89,), (None,)], "r DOUBLE")
    assert [r[0] for r in rates.select(traffic_light(F.col("r"))).collect()] == ["green", "amber", "amber", "red", None]
    assert rates.select(percent_label(F.col("r"))).first()[0] == "95.0%"


def test_histogram_puts_100_in_the_last_bucket(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (99.0,), (100.0,)], "s DOUBLE")
    assert rows(measures.histogram(df, "s")) == [(0, 2), (1, 1), (9, 2)]


def test_scorecard(spark):
    df = spark.createDataFrame([("x", 61.0, 10.0), ("x", 59.0, 20.0), ("y", 60.0, 5.0)], "carrier STRING, fulfillment_risk_score DOUBLE, carrier_risk_score DOUBLE")
    assert rows(measures.carrier_scorecard(df)) == [("x", 2, 1, 15.0), ("y", 1, 1, 5.0)]


def test_freshness(spark):
    df = spark.createDataFrame([(ago(minutes=10),)], "ts TIMESTAMP_NTZ")
    sets = {"fresh": (df, "ts"), "empty": (df.where("false"), "ts"), "stale": (df, "ts")}
    out = measures.freshness(sets, {"fresh": 15, "empty": 15, "stale": 5}, NOW)
    assert rows(out, "dataset", "lag_minutes", "within_sla") == [("empty", None, False), ("fresh", 10.0, True), ("stale", 10.0, False)]
