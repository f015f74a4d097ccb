"""The given tables seen as retail tables, once in Spark and once in SQL.

``events`` stand for the clickstream (a cart is a user's day), ``orders``, ``lineitem``, ``part``
and ``customer`` for the order domain. Order dates are moved by a fixed number of days so that
both domains share one time line that ends on 2024-01-30. Event names stay raw, so that filters
on them reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.model import EventNames, OrderStates

AS_OF = "2024-01-31 00:00:00"
FIRST_DAY = "2024-01-01"
SHIFT_DAYS = 8217
NAMES = EventNames(add="click", remove="error", begin_checkout="signup", complete="purchase")
STATES = OrderStates(open="O", cancelled="P", done="F")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VIEWS: dict[str, str] = {}


def with_views(*names: str) -> str:
    """WITH clause that defines the named views, to be followed by ``SELECT`` or further views."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n"


# Clickstream.


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", k)
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            "event_type",
            F.col("ts").alias("event_timestamp"),
            F.concat(F.lit("S"), "user_id").alias("session_id"),
            F.when(F.col("k") % 10 != 3, F.concat(F.lit("CUST"), "user_id")).alias("customer_id"),
            F.when(
                F.col("event_type") != "view",
                F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")),
            ).alias("cart_id"),
            F.element_at(F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet")), F.col("k") % 3 + 1).alias(
                "device_type"
            ),
            (F.col("ts") + F.make_dt_interval(secs=F.col("k") % 45 + 1)).alias("producer_ingested_at"),
            F.concat(F.lit("SKU"), "k").alias("sku"),
            (F.col("k") % 3 + 1).alias("quantity"),
            F.col("value").alias("price_at_event"),
            F.to_date("ts").alias("event_date"),
            "k",
        )
    )


VIEWS["raw_k"] = "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
VIEWS["clickstream"] = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, ts AS event_timestamp,
        'S' || user_id AS session_id,
        CASE WHEN k % 10 <> 3 THEN 'CUST' || user_id END AS customer_id,
        CASE WHEN event_type <> 'view' THEN user_id || '-' || strftime(ts, '%Y%m%d') END AS cart_id,
        CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
        ts + to_seconds(k % 45 + 1) AS producer_ingested_at,
        'SKU' || k AS sku, k % 3 + 1 AS quantity, value AS price_at_event,
        CAST(ts AS DATE) AS event_date, k
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


def dirty_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream with untidy text and with bad values in rows picked by ``k``."""
    at_k = lambda n: F.col("k") == n
    return clickstream(spark, sf_dir).withColumns(
        {
            "session_id": F.when(~at_k(7), F.col("session_id")),
            "cart_id": F.when(~at_k(11), F.concat(F.lit(" "), "cart_id", F.lit(" "))),
            "customer_id": F.concat(F.lit(" "), F.lower("customer_id")),
            "device_type": F.concat(F.initcap("device_type"), F.lit("  ")),
            "price_at_event": F.when(at_k(17), -F.col("price_at_event")).when(
                ~at_k(13), F.col("price_at_event")
            ),
            "event_type": F.when(~at_k(19), F.col("event_type")),
            "event_timestamp": F.when(
                at_k(23), F.col("event_timestamp") + F.make_dt_interval(days=F.lit(2))
            ).otherwise(F.col("event_timestamp")),
        }
    )


VIEWS["dirty_clickstream"] = """
    SELECT event_id, CASE WHEN k <> 19 THEN event_type END AS event_type,
        CASE WHEN k = 23 THEN event_timestamp + INTERVAL 2 DAY ELSE event_timestamp END AS event_timestamp,
        CASE WHEN k <> 7 THEN session_id END AS session_id,
        ' ' || lower(customer_id) AS customer_id,
        CASE WHEN k <> 11 THEN ' ' || cart_id || ' ' END AS cart_id,
        upper(device_type[1]) || device_type[2:] || '  ' AS device_type,
        producer_ingested_at, sku, quantity,
        CASE WHEN k = 17 THEN -price_at_event WHEN k <> 13 THEN price_at_event END AS price_at_event,
        event_date, k
    FROM clickstream
"""

# Order domain.

TRANSIT_DAYS = """CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 5
    WHEN '4-NOT SPECIFIED' THEN 8 ELSE 10 END"""
LATE_RATE = """CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4.0 WHEN '2-HIGH' THEN 7.5 WHEN '3-MEDIUM' THEN 11.0
    WHEN '4-NOT SPECIFIED' THEN 16.0 ELSE 30.0 END AS DOUBLE)"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order lacks a promise. A third of the customers is new: all they ever ordered
    is cancelled."""
    created = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(SHIFT_DAYS))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), "o_orderkey").alias("order_id"),
        F.concat(F.lit("CUST"), "o_custkey").alias("customer_id"),
        F.when(
            F.col("o_orderkey") % 4 != 0,
            F.concat_ws(
                "-",
                "o_custkey",
                F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("o_orderkey") % 30).cast("int")), "yyyyMMdd"),
            ),
        ).alias("cart_id"),
        created.alias("order_created_at"),
        F.when(F.col("o_orderkey") % 4 != 0, "web").otherwise("phone").alias("channel"),
        F.expr("CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' ELSE 'EUR' END").alias("currency"),
        F.expr("CASE o_custkey % 3 WHEN 0 THEN 1.0D WHEN 1 THEN 0.73D ELSE 1.08D END").alias("fx_rate_to_usd"),
        F.col("o_totalprice").alias("order_total_usd"),
        F.when(F.col("o_custkey") % 3 == 0, "P").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(
            F.col("o_orderkey") % 7 != 0, F.date_add(F.to_date(created), F.expr(TRANSIT_DAYS) + 2)
        ).alias("promised_delivery_date"),
        F.col("o_orderpriority").alias("priority"),
    )


VIEWS["shop_orders"] = f"""
    SELECT 'O' || o_orderkey AS order_id, 'CUST' || o_custkey AS customer_id,
        CASE WHEN o_orderkey % 4 <> 0 THEN
            o_custkey || '-' || strftime(DATE '{FIRST_DAY}' + CAST(o_orderkey % 30 AS INTEGER), '%Y%m%d') END AS cart_id,
        o_orderdate + INTERVAL {SHIFT_DAYS} DAY AS order_created_at,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'web' ELSE 'phone' END AS channel,
        CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' ELSE 'EUR' END AS currency,
        CASE o_custkey % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.73::DOUBLE ELSE 1.08::DOUBLE END AS fx_rate_to_usd,
        o_totalprice AS order_total_usd,
        CASE WHEN o_custkey % 3 = 0 THEN 'P' ELSE o_orderstatus END AS status,
        CASE WHEN o_orderkey % 7 <> 0 THEN
            CAST(o_orderdate AS DATE) + {SHIFT_DAYS} + {TRANSIT_DAYS} + 2 END AS promised_delivery_date,
        o_orderpriority AS priority
    FROM orders
"""


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on the time line of the carts: placed from the day before the cart's day to nine days after it."""
    n = F.substring("order_id", 2, 20).cast("long")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (n % 30 + n % 11 - 1).cast("int"))
    at = day.cast("timestamp_ntz") + F.make_dt_interval(hours=(n % 24).cast("int"))
    return orders(spark, sf_dir).withColumn("order_created_at", at)


VIEWS["placed_orders"] = f"""
    SELECT * REPLACE (DATE '{FIRST_DAY}' + CAST(n % 30 + n % 11 - 1 AS INTEGER) + to_hours(CAST(n % 24 AS INTEGER))
        AS order_created_at)
    FROM (SELECT *, CAST(order_id[2:] AS BIGINT) AS n FROM shop_orders)
"""


EXTRACT_DAYS = ("2024-01-05", "2024-01-12", "2024-01-19", "2024-01-26")


def order_extract(spark: SparkSession, sf_dir: str, taken_at: str) -> DataFrame:
    """The orders as an extract at ``taken_at`` shows them: open until the day they closed, some with a moved promise."""
    n = F.substring("order_id", 2, 20).cast("long")
    taken = F.lit(taken_at).cast("date")
    closed = F.date_add(F.lit(FIRST_DAY).cast("date"), (n % 40).cast("int")) <= taken
    moved = (n % 5 == 0) & (taken >= F.lit(EXTRACT_DAYS[2]).cast("date"))
    return orders(spark, sf_dir).where(F.to_date("order_created_at") <= taken).withColumns(
        {
            "status": F.when(closed, F.col("status")).otherwise(F.lit(STATES.open)),
            "promised_delivery_date": F.when(moved, F.date_add("promised_delivery_date", 3)).otherwise(F.col("promised_delivery_date")),
        }
    )


VIEWS["order_extracts"] = f"""
    SELECT taken AS seen_at, order_id, customer_id, order_total_usd,
        CASE WHEN DATE '{FIRST_DAY}' + CAST(n % 40 AS INTEGER) <= taken THEN status ELSE 'O' END AS status,
        CASE WHEN n % 5 = 0 AND taken >= DATE '{EXTRACT_DAYS[2]}' THEN promised_delivery_date + 3
            ELSE promised_delivery_date END AS promised_delivery_date
    FROM (SELECT *, CAST(order_id[2:] AS BIGINT) AS n FROM shop_orders),
        (SELECT CAST(unnest(['{"', '".join(EXTRACT_DAYS)}']) AS DATE) AS taken)
    WHERE CAST(order_created_at AS DATE) <= taken
"""
VIEWS["order_versions"] = """
    SELECT * REPLACE (CAST(seen_at AS TIMESTAMP) AS seen_at),
        CAST(lead(seen_at) OVER (PARTITION BY order_id ORDER BY seen_at) AS TIMESTAMP) AS valid_to
    FROM (SELECT *, lag((status, promised_delivery_date)) OVER (PARTITION BY order_id ORDER BY seen_at) AS before,
            lag(seen_at) OVER (PARTITION BY order_id ORDER BY seen_at) AS earlier FROM order_extracts)
    WHERE earlier IS NULL OR before IS DISTINCT FROM (status, promised_delivery_date)
"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.substring("order_id", 2, 20).cast("long")
    return orders(spark, sf_dir).withColumns(
        {
            "order_id": F.concat(F.lit(" "), "order_id"),
            "customer_id": F.concat(F.lower("customer_id"), F.lit(" ")),
            "order_total_usd": F.when(n % 11 == 0, F.lit(None))
            .when(n % 13 == 0, -F.col("order_total_usd"))
            .otherwise(F.col("order_total_usd")),
            "fx_rate_to_usd": F.when(n % 17 != 0, F.col("fx_rate_to_usd")),
        }
    )


VIEWS["dirty_orders"] = """
    SELECT ' ' || order_id AS order_id, lower(customer_id) || ' ' AS customer_id, cart_id,
        order_created_at, channel, currency,
        CASE WHEN n % 17 <> 0 THEN fx_rate_to_usd END AS fx_rate_to_usd,
        CASE WHEN n % 11 = 0 THEN NULL WHEN n % 13 = 0 THEN -order_total_usd ELSE order_total_usd END
            AS order_total_usd,
        status, promised_delivery_date, priority
    FROM (SELECT *, CAST(order_id[2:] AS BIGINT) AS n FROM shop_orders)
"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per order that has lines; delivered when its order is done."""
    shift = F.make_dt_interval(days=F.lit(SHIFT_DAYS))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("shipped_on"), F.max("l_shipdate").alias("arrived_on"))
        .select(
            "l_orderkey", (F.col("shipped_on") + shift).alias("shipped_at"), (F.col("arrived_on") + shift).alias("arrived_at")
        )
    )
    heads = orders(spark, sf_dir).select(
        "order_id",
        F.concat(F.lit("carrier-"), F.substring("priority", 1, 1)).alias("carrier"),
        "status",
        F.col("priority").alias("o_orderpriority"),
        F.date_add(F.to_date("order_created_at"), 60).alias("promised_delivery_date"),
    )
    # By the number, by which the lines' sums are shuffled already.
    return heads.join(lines, F.substring("order_id", 2, 20).cast("long") == F.col("l_orderkey")).select(
        "order_id",
        "carrier",
        "shipped_at",
        F.when(F.col("status") == "F", F.col("arrived_at")).alias("delivered_at"),
        "status",
        F.expr(TRANSIT_DAYS).alias("carrier_avg_transit_days"),
        F.expr(LATE_RATE).alias("carrier_historical_late_rate_pct"),
        "promised_delivery_date",
    )


VIEWS["shipments"] = f"""
    SELECT h.order_id, 'carrier-' || priority[1] AS carrier, shipped_at,
        CASE WHEN status = 'F' THEN arrived_at END AS delivered_at, status,
        {TRANSIT_DAYS} AS carrier_avg_transit_days,
        {LATE_RATE} AS carrier_historical_late_rate_pct,
        CAST(order_created_at AS DATE) + 60 AS promised_delivery_date
    FROM (SELECT *, priority AS o_orderpriority FROM shop_orders) h
    JOIN (SELECT 'O' || l_orderkey AS order_id, min(l_shipdate) + INTERVAL {SHIFT_DAYS} DAY AS shipped_at,
            max(l_shipdate) + INTERVAL {SHIFT_DAYS} DAY AS arrived_at
          FROM lineitem GROUP BY l_orderkey) l ON h.order_id = l.order_id
"""


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("O"), "l_orderkey").alias("order_id"),
        F.concat(F.lit("SKU"), "l_partkey").alias("sku"),
        F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


VIEWS["order_items"] = """
    SELECT 'O' || l_orderkey AS order_id, 'SKU' || l_partkey AS sku, CAST(l_quantity AS INTEGER) AS qty,
        l_extendedprice / l_quantity AS unit_price
    FROM lineitem
"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two warehouses per article; one of them knows about back orders, the other has no flag."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("SKU"), "p_partkey").alias("sku"),
        F.explode(F.array(F.lit("east"), F.lit("west"))).alias("warehouse_id"),
        F.when(F.col("p_size") != 50, F.col("p_size") - 3).alias("on_hand_qty"),
        (F.col("p_size") <= 3).alias("_low"),
    ).withColumn("backorder_flag", F.when(F.col("warehouse_id") == "east", F.col("_low"))).drop("_low")


VIEWS["inventory"] = """
    SELECT 'SKU' || p_partkey AS sku, warehouse_id,
        CASE WHEN p_size <> 50 THEN p_size - 3 END AS on_hand_qty,
        CASE WHEN warehouse_id = 'east' THEN p_size <= 3 END AS backorder_flag
    FROM part, (VALUES ('east'), ('west')) AS w(warehouse_id)
"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" sku"), "p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_partkey") % 19 != 0, F.col("p_retailprice") - 905).alias("price"),
    )


VIEWS["products"] = """
    SELECT ' sku' || p_partkey AS sku, p_name AS name, p_type AS category,
        CASE WHEN p_partkey % 19 <> 0 THEN p_retailprice - 905 END AS price
    FROM part
"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" cust"), "c_custkey", F.lit(" ")).alias("customer_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") > 0).alias("is_returning"),
        F.col("c_nationkey").alias("home_tz_offset"),
    )


VIEWS["customers"] = """
    SELECT ' cust' || c_custkey || ' ' AS customer_id,
        CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal > 0 END AS is_returning,
        c_nationkey AS home_tz_offset
    FROM customer
"""

# Standard forms.

VIEWS["std_clickstream"] = """
    SELECT * REPLACE (CAST(event_timestamp AS DATE) AS event_date, upper(trim(customer_id)) AS customer_id,
        trim(cart_id) AS cart_id, lower(trim(device_type)) AS device_type)
    FROM dirty_clickstream
"""
VIEWS["std_orders"] = """
    SELECT * REPLACE (trim(order_id) AS order_id, upper(trim(customer_id)) AS customer_id),
        CAST(order_created_at AS DATE) AS order_date
    FROM dirty_orders
"""
VIEWS["std_customers"] = "SELECT * REPLACE (upper(trim(customer_id)) AS customer_id) FROM customers"
VIEWS["std_products"] = (
    "SELECT * REPLACE (upper(trim(sku)) AS sku, lower(category) AS category) FROM products"
)
