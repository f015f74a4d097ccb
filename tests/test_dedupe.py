import datetime as dt

from conftest import NOW, plan_of, rows

from signalloom.operators.dedupe import latest_per_key, without_retries, without_retries_by_branch

EVENTS = """event_id STRING, cart_id STRING, event_type STRING, event_timestamp TIMESTAMP_NTZ,
    producer_ingested_at TIMESTAMP_NTZ, attempt STRING"""


def test_the_newest_row_of_a_key_stays(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "key STRING, n LONG, what STRING")
    assert rows(latest_per_key(df, ["key"], "n"), "key", "what") == [("a", "new"), ("b", "only")]


def test_equal_rows_are_settled_by_the_tie_breaker(spark):
    df = spark.createDataFrame([("a", 1, i) for i in (3, 1, 2)], "key STRING, n LONG, i INT").repartition(3)
    assert rows(latest_per_key(df, ["key"], "n", ["i"]), "i") == [(3,)]


def test_a_null_order_loses_and_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 5, 2)], "key STRING, n LONG, i INT")
    assert rows(latest_per_key(df, ["key"], "n"), "i") == [(2,)]


def test_ranking_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "key STRING, n LONG")
    plan = plan_of(latest_per_key(df, ["key"], "n"))
    assert plan.count("WindowGroupLimit") >= 2


def retries(spark):
    later = NOW + dt.timedelta(seconds=30)
    return spark.createDataFrame(
        [
            ("e1", "c1", "add_to_cart", NOW, NOW, "first"),
            ("e2", "c1", "add_to_cart", NOW, later, "retry"),
            ("e3", "c1", "checkout_start", NOW, NOW, "first"),
            ("v1", None, "page_view", NOW, NOW, "first"),
            ("v1", None, "page_view", NOW, later, "retry"),
            ("v2", None, "page_view", NOW, NOW, "first"),
        ],
        EVENTS,
    )


def test_retries_of_both_kinds_collapse(spark):
    expected = [("e2", "retry"), ("e3", "first"), ("v1", "retry"), ("v2", "first")]
    assert rows(without_retries(retries(spark)), "event_id", "attempt") == expected
    assert rows(without_retries_by_branch(retries(spark)), "event_id", "attempt") == expected


def test_deduping_twice_changes_nothing(spark):
    once = without_retries(retries(spark))
    assert rows(without_retries(once)) == rows(once)
