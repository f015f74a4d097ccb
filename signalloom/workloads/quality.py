"""Standard forms, row checks and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.operators import dedupe, quality, standardize
from signalloom.workloads import retail
from signalloom.workloads.registry import presented, sql_day, sql_time, workload
from signalloom.workloads.retail import NAMES, STATES, VIEWS, with_views

@workload(
    with_views("clickstream", "dirty_clickstream", "std_clickstream")
    + f"""SELECT event_id, customer_id, cart_id, device_type, {sql_day("event_date", "event_date")}
    FROM std_clickstream"""
)
def std_events(spark, sf_dir):
    return presented(
        standardize.clickstream(retail.dirty_clickstream(spark, sf_dir)).select(
            "event_id", "customer_id", "cart_id", "device_type", "event_date"
        )
    )


@workload(with_views("customers", "std_customers") + "SELECT * FROM std_customers")
def std_customers(spark, sf_dir):
    return standardize.customers(retail.customers(spark, sf_dir))


@workload(with_views("products", "std_products") + "SELECT * REPLACE (round(price, 6) AS price) FROM std_products")
def std_products(spark, sf_dir):
    return presented(standardize.products(retail.products(spark, sf_dir)))


@workload(
    with_views("shop_orders", "dirty_orders", "std_orders")
    + f"""SELECT order_id, customer_id, status, {sql_day("order_date", "order_date")} FROM std_orders"""
)
def std_orders(spark, sf_dir):
    return presented(
        standardize.orders(retail.dirty_orders(spark, sf_dir)).select(
            "order_id", "customer_id", "status", "order_date"
        )
    )


@workload(
    with_views("shop_orders")
    + """SELECT order_id, currency, round(order_total_usd * fx_rate_to_usd, 6) AS amount_usd FROM shop_orders"""
)
def fx_convert(spark, sf_dir):
    amount = standardize.to_usd("order_total_usd").alias("amount_usd")
    return presented(retail.orders(spark, sf_dir).select("order_id", "currency", amount))


# Row checks.

REASONS_SQL = """
    SELECT *, concat_ws(',',
        CASE WHEN session_id IS NULL THEN 'missing_session_id' END,
        CASE WHEN event_type IN ('click', 'error', 'signup', 'purchase') AND cart_id IS NULL
            THEN 'missing_cart_id_for_cart_event' END,
        CASE WHEN event_timestamp IS NULL OR event_timestamp < producer_ingested_at - INTERVAL 1 DAY
            OR event_timestamp > producer_ingested_at + INTERVAL 5 MINUTE THEN 'invalid_event_timestamp' END,
        CASE WHEN event_type IN ('click', 'error') AND (price_at_event IS NULL OR price_at_event < 0)
            THEN 'bad_price_at_event' END) AS reasons
    FROM std_clickstream
"""
VIEWS["checked_clickstream"] = REASONS_SQL
CHECKED = with_views("clickstream", "dirty_clickstream", "std_clickstream", "checked_clickstream")


def checked_clickstream(spark, sf_dir):
    events = standardize.clickstream(retail.dirty_clickstream(spark, sf_dir))
    return quality.tag(events, quality.clickstream_rules(F.col("producer_ingested_at"), NAMES))


@workload(
    CHECKED
    + """SELECT event_id, event_type, cart_id, round(price_at_event, 6) AS price_at_event, '' AS _dq_warnings
    FROM checked_clickstream WHERE reasons = ''"""
)
def dq_split_clean(spark, sf_dir):
    clean = quality.clean_rows(checked_clickstream(spark, sf_dir))
    return presented(clean.select("event_id", "event_type", "cart_id", "price_at_event", "_dq_warnings"))


@workload(CHECKED + "SELECT event_id, reasons AS _dq_fail_reasons FROM checked_clickstream WHERE reasons <> ''")
def dq_split_quarantine(spark, sf_dir):
    bad = quality.quarantined_rows(checked_clickstream(spark, sf_dir))
    return presented(bad.select("event_id", "_dq_fail_reasons"))


@workload(
    CHECKED
    + """SELECT 'clean' AS verdict, count(*) AS n_rows FROM checked_clickstream WHERE reasons = ''
    UNION ALL SELECT 'quarantined', count(*) FROM checked_clickstream WHERE reasons <> ''"""
)
def dq_split_is_complete(spark, sf_dir):
    """Both sides of a split that is checked and written once."""
    events = standardize.clickstream(retail.dirty_clickstream(spark, sf_dir))
    rules = quality.clickstream_rules(F.col("producer_ingested_at"), NAMES)
    clean, bad = quality.split_once(events, rules, "split")
    count = F.count(F.lit(1)).alias("n_rows")
    return clean.agg(count).select(F.lit("clean").alias("verdict"), "n_rows").unionByName(
        bad.agg(count).select(F.lit("quarantined").alias("verdict"), "n_rows")
    )


@workload(
    with_views("shop_orders", "dirty_orders", "std_orders")
    + """SELECT order_id, concat_ws(',',
        CASE WHEN order_total_usd IS NULL THEN 'missing_order_total' END,
        CASE WHEN order_total_usd < 0 THEN 'negative_order_total' END,
        CASE WHEN fx_rate_to_usd IS NULL THEN 'missing_fx_rate' END) AS _dq_fail_reasons,
        CASE WHEN promised_delivery_date IS NULL AND status <> 'P' THEN 'missing_promised_delivery_date' ELSE '' END
            AS _dq_warnings
    FROM std_orders"""
)
def dq_orders(spark, sf_dir):
    tagged = quality.tag(standardize.orders(retail.dirty_orders(spark, sf_dir)), quality.order_rules(STATES))
    return presented(tagged.select("order_id", "_dq_fail_reasons", "_dq_warnings"))


@workload(
    with_views("order_items")
    + """SELECT order_id, sku, qty, CASE WHEN qty - 3 <= 0 THEN 'non_positive_qty' ELSE '' END
        || CASE WHEN qty - 3 <= 0 AND unit_price < 1000 THEN ',' ELSE '' END
        || CASE WHEN unit_price < 1000 THEN 'negative_unit_price' ELSE '' END AS _dq_fail_reasons
    FROM order_items WHERE qty - 3 <= 0 OR unit_price < 1000"""
)
def dq_order_items(spark, sf_dir):
    shifted = retail.order_items(spark, sf_dir).withColumns(
        {"qty": F.col("qty") - 3, "unit_price": F.col("unit_price") - 1000}
    )
    bad = quality.split(shifted, quality.order_item_rules())[1]
    return presented(bad.select("order_id", "sku", (F.col("qty") + 3).alias("qty"), quality.REASONS))


@workload(
    with_views("products", "inventory", "std_products")
    + """SELECT 'products' AS source, sku, CASE WHEN price IS NULL OR price < 0 THEN 'negative_price' ELSE '' END
        AS _dq_fail_reasons FROM std_products
    UNION ALL SELECT 'inventory-' || warehouse_id, sku, CASE WHEN on_hand_qty < 0 THEN 'negative_on_hand_qty' ELSE '' END
    FROM inventory"""
)
def dq_products_inventory(spark, sf_dir):
    products = quality.tag(standardize.products(retail.products(spark, sf_dir)), quality.product_rules())
    stock = quality.tag(retail.inventory(spark, sf_dir), quality.inventory_rules())
    both = products.select(F.lit("products").alias("source"), "sku", "_dq_fail_reasons").unionByName(
        stock.select(F.concat(F.lit("inventory-"), "warehouse_id").alias("source"), "sku", "_dq_fail_reasons")
    )
    return presented(both)


@workload(
    with_views("clickstream", "dirty_clickstream")
    + f"""SELECT event_id, event_timestamp < TIMESTAMP '{retail.AS_OF}' - INTERVAL 1 DAY
        OR event_timestamp > TIMESTAMP '{retail.AS_OF}' + INTERVAL 5 MINUTE AS skewed FROM dirty_clickstream"""
)
def dq_clock_skew(spark, sf_dir):
    events = retail.dirty_clickstream(spark, sf_dir)
    as_of = F.lit(retail.AS_OF).cast("timestamp_ntz")
    return events.select("event_id", quality.outside_clock_skew("event_timestamp", as_of).alias("skewed"))


@workload(
    with_views("shop_orders")
    + f"""SELECT order_id FROM shop_orders WHERE order_created_at < TIMESTAMP '{retail.AS_OF}' - INTERVAL 365 DAY
        OR order_created_at > TIMESTAMP '{retail.AS_OF}' + INTERVAL 5 MINUTE"""
)
def dq_order_clock_skew(spark, sf_dir):
    rule = quality.order_clock_rule(F.lit(retail.AS_OF).cast("timestamp_ntz"), past_days=365)
    return quality.split(retail.orders(spark, sf_dir), [rule])[1].select("order_id")


@workload(
    with_views("clickstream", "customers", "std_customers")
    + """SELECT event_id, c.customer_id, 'orphan_customer_id' AS _dq_fail_reasons FROM clickstream c
    WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM std_customers WHERE is_returning)
    UNION ALL SELECT event_id, customer_id, '' FROM clickstream
    WHERE customer_id IN (SELECT customer_id FROM std_customers WHERE is_returning)"""
)
def dq_referential(spark, sf_dir):
    """Only returning customers count as known, so that there are orphans."""
    events = retail.clickstream(spark, sf_dir).select("event_id", "customer_id")
    known = standardize.customers(retail.customers(spark, sf_dir)).where("is_returning")
    matched = quality.referenced(events, known, "customer_id")
    return presented(
        quality.orphans(events, known, "customer_id").unionByName(
            matched.withColumn(quality.REASONS, F.array().cast("array<string>"))
        )
    )


@workload(
    CHECKED
    + """SELECT 'fail' AS severity, rule, count(*) AS n_rows
    FROM (SELECT unnest(string_split(reasons, ',')) AS rule FROM checked_clickstream WHERE reasons <> '') GROUP BY rule
    UNION ALL SELECT 'pass', 'rate_in_millionths', CAST(round(1e6 * count(*) FILTER (reasons = '') / count(*)) AS BIGINT)
    FROM checked_clickstream"""
)
def dq_pass_rate(spark, sf_dir):
    tagged = checked_clickstream(spark, sf_dir)
    rate = quality.pass_rate(tagged).select(
        F.lit("pass").alias("severity"),
        F.lit("rate_in_millionths").alias("rule"),
        F.round(F.col("pass_rate") * 1e6).cast("long").alias("n_rows"),
    )
    return quality.rule_counts(tagged).unionByName(rate)


# De-duplication.


@workload(
    f"""SELECT l_orderkey, l_linenumber, {sql_time("l_shipdate", "l_shipdate")}, l_partkey, l_extendedprice
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) = 1"""
)
def dedupe_last_write_wins(spark, sf_dir):
    lines = retail.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice"
    )
    keys, ties = ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_partkey"]
    return presented(dedupe.latest_per_key(lines, keys, "l_shipdate", ties))


VIEWS["retried"] = """
    SELECT event_id, cart_id, event_type, date_trunc('hour', event_timestamp) AS event_timestamp, producer_ingested_at
    FROM clickstream UNION ALL
    SELECT CASE WHEN cart_id IS NULL THEN event_id ELSE 'retry-' || event_id END, cart_id, event_type,
        date_trunc('hour', event_timestamp), producer_ingested_at + INTERVAL 30 SECOND FROM clickstream WHERE k % 3 = 0
"""


def retried_clickstream(spark, sf_dir):
    """Every third event is sent again later: cart events under a new id, others under their own."""
    events = retail.clickstream(spark, sf_dir).withColumn(
        "event_timestamp", F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz")
    )
    again = events.where("k % 3 = 0").withColumns(
        {
            "event_id": F.when(F.col("cart_id").isNull(), F.col("event_id")).otherwise(
                F.concat(F.lit("retry-"), "event_id")
            ),
            "producer_ingested_at": F.col("producer_ingested_at") + F.make_dt_interval(secs=F.lit(30)),
        }
    )
    return events.unionByName(again).select(
        "event_id", "cart_id", "event_type", "event_timestamp", "producer_ingested_at"
    )


RETRY_SQL = (
    with_views("clickstream", "retried")
    + f"""SELECT event_id, cart_id, event_type, {sql_time("producer_ingested_at", "producer_ingested_at")} FROM (
        SELECT * FROM retried WHERE cart_id IS NOT NULL QUALIFY row_number() OVER (
            PARTITION BY cart_id, event_type, event_timestamp ORDER BY producer_ingested_at DESC, event_id DESC) = 1
        UNION ALL SELECT * FROM retried WHERE cart_id IS NULL QUALIFY row_number() OVER (
            PARTITION BY event_id ORDER BY producer_ingested_at DESC) = 1)"""
)


@workload(RETRY_SQL)
def dedupe_two_key(spark, sf_dir):
    return presented(dedupe.without_retries(retried_clickstream(spark, sf_dir)).drop("event_timestamp"))


@workload(RETRY_SQL)
def dedupe_two_key_union(spark, sf_dir):
    return presented(dedupe.without_retries_by_branch(retried_clickstream(spark, sf_dir)).drop("event_timestamp"))
