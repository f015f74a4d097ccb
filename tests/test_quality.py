import datetime as dt

import pytest
from conftest import NOW, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalloom.operators import quality as q
from signalloom.operators import standardize

PRICES = "id STRING, price DOUBLE, ts TIMESTAMP_NTZ"


def price_rules():
    return [
        q.Rule("missing_price", q.any_null("price")),
        q.Rule("negative_price", q.below_zero("price")),
        q.Rule("bad_timestamp", q.outside_clock_skew("ts", F.lit(str(NOW)).cast("timestamp_ntz"))),
    ]


def test_each_bad_row_is_quarantined_with_its_reason(spark):
    df = spark.createDataFrame(
        [("ok", 5.0, NOW), ("none", None, NOW), ("neg", -5.0, NOW), ("late", 5.0, NOW + dt.timedelta(days=2))],
        PRICES,
    )
    clean, bad = q.split(df, price_rules())
    assert rows(clean, "id") == [("ok",)]
    assert rows(bad, "id", F.array_join(q.REASONS, ",")) == [
        ("late", "bad_timestamp"),
        ("neg", "negative_price"),
        ("none", "missing_price"),
    ]
    assert q.WARNINGS not in bad.columns and q.REASONS not in clean.columns


def test_a_row_lists_every_rule_it_breaks(spark):
    df = spark.createDataFrame([("x", -1.0, None)], PRICES)
    assert q.split(df, price_rules())[1].first()[q.REASONS] == ["negative_price", "bad_timestamp"]


def test_warnings_keep_the_row(spark):
    df = spark.createDataFrame([("x", None), ("y", 1.0)], "id STRING, value DOUBLE")
    clean, bad = q.split(df, [q.Rule("missing_value", q.any_null("value"), q.WARN)])
    assert rows(clean, "id", F.array_join(q.WARNINGS, ",")) == [("x", "missing_value"), ("y", "")]
    assert bad.isEmpty()


def test_without_rules_everything_is_clean(spark):
    clean, bad = q.split(spark.range(3), [])
    assert clean.count() == 3 and bad.isEmpty()
    assert clean.first()[q.WARNINGS] == []


def test_severity_is_validated():
    with pytest.raises(ValueError):
        q.Rule("x", None, "fatal")


def test_a_null_condition_does_not_lose_the_row(spark):
    stock = spark.createDataFrame([("a", None), ("b", -1), ("c", 2)], "sku STRING, on_hand_qty INT")
    clean, bad = q.split(stock, q.inventory_rules())
    assert rows(clean, "sku") == [("a",), ("c",)] and rows(bad, "sku") == [("b",)]
    # An event of unknown type without cart and price breaks no cart rule.
    event = spark.createDataFrame(
        [(None, None, "s", None, NOW)],
        "event_type STRING, cart_id STRING, session_id STRING, price_at_event DOUBLE, event_timestamp TIMESTAMP_NTZ",
    )
    rules = q.clickstream_rules(F.lit(str(NOW)).cast("timestamp_ntz"))
    assert q.split(event, rules)[0].count() == 1


event_rows = st.lists(
    st.tuples(
        st.sampled_from([None, "add_to_cart", "remove_from_cart", "page_view"]),
        st.sampled_from([None, "c1"]),
        st.sampled_from([None, "s1"]),
        st.one_of(st.none(), st.floats(-10, 10)),
        st.one_of(st.none(), st.integers(-3 * 24 * 60, 60).map(lambda m: NOW + dt.timedelta(minutes=m))),
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(event_rows)
def test_clean_and_quarantine_make_up_the_input(spark, data):
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)],
        """id INT, event_type STRING, cart_id STRING, session_id STRING, price_at_event DOUBLE,
        event_timestamp TIMESTAMP_NTZ""",
    )
    clean, bad = q.split(df, q.clickstream_rules(F.lit(str(NOW)).cast("timestamp_ntz")))
    ids = [r.id for r in clean.select("id").collect()] + [r.id for r in bad.select("id").collect()]
    assert sorted(ids) == list(range(len(data)))


def test_split_once_agrees_with_split(spark):
    df = spark.createDataFrame([("a", None, NOW), ("b", 1.0, NOW), ("c", -1.0, NOW)], PRICES)
    for once, plain in zip(q.split_once(df, price_rules(), "t"), q.split(df, price_rules())):
        assert once.columns == plain.columns
        assert rows(once, "id") == rows(plain, "id")


def test_clock_skew_limits_are_inclusive(spark):
    edges = [dt.timedelta(days=-1), dt.timedelta(minutes=5), dt.timedelta(days=-1, seconds=-1), dt.timedelta(minutes=5, seconds=1)]
    df = spark.createDataFrame([(i, NOW + e) for i, e in enumerate(edges)], "i INT, ts TIMESTAMP_NTZ")
    skewed = q.outside_clock_skew("ts", F.lit(str(NOW)).cast("timestamp_ntz"))
    assert rows(df, "i", skewed) == [(0, False), (1, False), (2, True), (3, True)]


def test_order_rules_warn_on_a_missing_promise(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, "in_transit", None), ("b", 1.0, 1.0, "cancelled", None), ("c", -1.0, None, "delivered", None)],
        "order_id STRING, order_total_usd DOUBLE, fx_rate_to_usd DOUBLE, status STRING, promised_delivery_date DATE",
    )
    tagged = q.tag(df, q.order_rules())
    assert rows(tagged, "order_id", F.array_join(q.REASONS, ","), F.array_join(q.WARNINGS, ",")) == [
        ("a", "", "missing_promised_delivery_date"),
        ("b", "", ""),
        ("c", "negative_order_total,missing_fx_rate", "missing_promised_delivery_date"),
    ]


def test_orphans_and_referenced(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, customer_id STRING")
    known = spark.createDataFrame([("a",)], "customer_id STRING")
    assert rows(q.orphans(df, known, "customer_id"), "id") == [(2,)]
    assert rows(q.referenced(df, known, "customer_id"), "id") == [(1,)]


def test_pass_rate_and_rule_counts(spark):
    df = spark.createDataFrame([("a", None, NOW), ("b", 1.0, NOW), ("c", None, None)], PRICES)
    tagged = q.tag(df, price_rules())
    assert rows(q.rule_counts(tagged)) == [("fail", "bad_timestamp", 1), ("fail", "missing_price", 2)]
    assert q.pass_rate(tagged).first().pass_rate == pytest.approx(1 / 3)
    assert q.pass_rate(tagged.where("false")).first().pass_rate is None


def test_standard_forms(spark):
    events = spark.createDataFrame(
        [(NOW, " cust1 ", " Cart-1 ", "  MOBILE ")],
        "event_timestamp TIMESTAMP_NTZ, customer_id STRING, cart_id STRING, device_type STRING",
    )
    row = standardize.clickstream(events).first()
    assert (row.customer_id, row.cart_id, row.device_type, row.event_date) == (
        "CUST1", "Cart-1", "mobile", NOW.date(),
    )
    product = spark.createDataFrame([(" sku1", " Toys ")], "sku STRING, category STRING")
    assert tuple(standardize.products(product).first()) == ("SKU1", " toys ")
