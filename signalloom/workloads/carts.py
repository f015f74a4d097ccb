"""Cart aggregation, abandonment, scoring and the cart report pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.functions.clock import days
from signalloom.operators import carts, conversions, joins, sessions, standardize
from signalloom.operators.measures import histogram
from signalloom.operators.percentiles import ACCURACY, percentile
from signalloom.operators.staging import staged
from signalloom.plans import cart_recovery, reports
from signalloom.plans.cart_increments import CartStore
from signalloom.session import scratch_path
from signalloom.workloads import retail
from signalloom.workloads.registry import presented, sql_time, workload
from signalloom.workloads.retail import AS_OF, NAMES, STATES, VIEWS, with_views

VIEWS["cart_state"] = """
    SELECT cart_id, arg_min(customer_id, (event_timestamp, customer_id)) FILTER (customer_id IS NOT NULL) AS customer_id,
        max(event_timestamp) AS last_activity_at,
        max(CAST(event_type = 'click' AS INTEGER)) AS has_add,
        max(CAST(event_type = 'purchase' AS INTEGER)) AS has_checkout_complete,
        sum(CASE WHEN event_type = 'click' THEN price_at_event * quantity ELSE 0.0 END) AS added_value,
        sum(CASE WHEN event_type = 'error' THEN price_at_event * quantity ELSE 0.0 END) AS removed_value,
        CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS n_adds,
        CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS n_removes
    FROM clickstream WHERE event_type IN ('click', 'error', 'signup', 'purchase') GROUP BY cart_id
"""


def abandoned_sql(as_of: str = f"TIMESTAMP '{AS_OF}'") -> str:
    return f"""
    SELECT cart_id, customer_id, last_activity_at, greatest(added_value - removed_value, 0.0) AS recoverable_cart_value,
        greatest(n_adds - n_removes, 0) AS item_count,
        (floor(epoch({as_of})) - floor(epoch(last_activity_at))) / 60.0 AS minutes_since_last_activity
    FROM cart_state WHERE has_add = 1 AND has_checkout_complete = 0
        AND last_activity_at < {as_of} - INTERVAL 30 MINUTE AND last_activity_at > {as_of} - INTERVAL 7 DAY
"""


VIEWS["lags"] = """
    SELECT cart_id, min(event_timestamp) FILTER (event_type = 'click') AS first_add_at,
        max(event_timestamp) FILTER (event_type = 'purchase') AS checkout_complete_at,
        (floor(epoch(checkout_complete_at)) - floor(epoch(first_add_at))) / 60.0 AS lag_minutes
    FROM clickstream WHERE event_type IN ('click', 'purchase') AND cart_id IS NOT NULL GROUP BY cart_id
"""
VIEWS["abandoned"] = abandoned_sql()
VIEWS["latest_abandoned"] = abandoned_sql("(SELECT max(event_timestamp) FROM clickstream)")


def signal_sql(source: str = "abandoned", cap: str | None = None, loyal: str = "status <> 'P'") -> str:
    cap = cap or f"(SELECT quantile_disc(recoverable_cart_value, 0.90) FROM {source})"
    return f"""
    SELECT *, 0.45 * recency_score + 0.40 * value_score + 0.15 * loyalty_score AS priority_score FROM (
        SELECT a.*, 100 * exp(-minutes_since_last_activity / 180.0) AS recency_score,
            100 * least(recoverable_cart_value / coalesce(nullif({cap}, 0), 1.0), 1.0) AS value_score,
            CASE WHEN customer_id IN (SELECT customer_id FROM shop_orders WHERE {loyal})
                THEN 100.0::DOUBLE ELSE 40.0::DOUBLE END AS loyalty_score
        FROM {source} a)
"""


VIEWS["cart_signal"] = signal_sql()
VIEWS["latest_cart_signal"] = signal_sql("latest_abandoned")
SIGNAL_VIEWS = ("clickstream", "shop_orders", "cart_state", "abandoned", "cart_signal")
SIGNAL_SELECT = f"""
    SELECT cart_id, customer_id, {sql_time("last_activity_at", "last_activity_at")},
    round(minutes_since_last_activity, 6) AS minutes_since_last_activity,
    round(recoverable_cart_value, 6) AS recoverable_cart_value, item_count,
    round(recency_score, 6) AS recency_score, round(value_score, 6) AS value_score,
    loyalty_score, round(priority_score, 6) AS priority_score FROM """


def signal(spark, sf_dir, as_of=AS_OF, **options):
    return cart_recovery.cart_recovery_signal(
        retail.clickstream(spark, sf_dir),
        retail.orders(spark, sf_dir),
        as_of,
        names=NAMES,
        states=STATES,
        percentile_method=options.pop("percentile_method", "discrete"),
        **options,
    )


@workload(
    with_views("clickstream", "cart_state")
    + f"""SELECT cart_id, customer_id, {sql_time("last_activity_at", "last_activity_at")}, has_add, has_checkout_complete,
    round(added_value, 6) AS added_value, round(removed_value, 6) AS removed_value, n_adds, n_removes FROM cart_state"""
)
def cart_aggregate(spark, sf_dir):
    return presented(carts.cart_state(retail.clickstream(spark, sf_dir), NAMES))


@workload(
    with_views("clickstream", "cart_state", "abandoned")
    + f"""SELECT cart_id, customer_id, {sql_time("last_activity_at", "last_activity_at")},
    round(recoverable_cart_value, 6) AS recoverable_cart_value, item_count,
    round(minutes_since_last_activity, 6) AS minutes_since_last_activity FROM abandoned"""
)
def cart_abandoned(spark, sf_dir):
    """Only the history of recently active carts is aggregated."""
    events = retail.clickstream(spark, sf_dir)
    # The raw time column, so that the filter reaches the scan.
    recent = F.col("event_timestamp") > F.lit(AS_OF).cast("timestamp_ntz") - days(7)
    history = joins.rows_of_recent_carts(events, recent & F.col("event_type").isin(*NAMES.cart))
    abandoned = carts.abandoned_carts(carts.cart_state(history, NAMES), AS_OF)
    return presented(
        abandoned.select(
            "cart_id", "customer_id", "last_activity_at", "recoverable_cart_value", "item_count",
            "minutes_since_last_activity",
        )
    )


def staged_abandoned(spark, sf_dir):
    state = carts.cart_state(retail.clickstream(spark, sf_dir), NAMES)
    return staged(carts.abandoned_carts(state, AS_OF), "abandoned")


@workload(
    with_views("clickstream", "cart_state", "abandoned")
    + """SELECT round(quantile_disc(recoverable_cart_value, 0.9), 6) AS p90_discrete,
    round(quantile_cont(recoverable_cart_value, 0.9), 6) AS p90_continuous FROM abandoned"""
)
def value_p90(spark, sf_dir):
    abandoned = staged_abandoned(spark, sf_dir)
    q = lambda method: percentile(abandoned, "recoverable_cart_value", 0.9, method=method).scalar()
    return presented(
        spark.range(1).select(q("discrete").alias("p90_discrete"), q("continuous").alias("p90_continuous"))
    )


@workload("SELECT count(*) AS n_values, true AS within_error FROM orders")
def value_p90_approx(spark, sf_dir):
    """The sketch percentile of a whole column, judged by its rank."""
    prices = retail.table(spark, sf_dir, "orders").select("o_totalprice")
    q = percentile(prices, "o_totalprice", 0.9).scalar()
    below, upto = F.count_if(F.col("o_totalprice") < q), F.count_if(F.col("o_totalprice") <= q)
    n = F.count("o_totalprice")
    slack = n / F.lit(ACCURACY) + 1
    return prices.agg(
        n.alias("n_values"), ((below <= 0.9 * n + slack) & (upto >= 0.9 * n - slack)).alias("within_error")
    )


@workload(
    """SELECT o_orderpriority, round(quantile_disc(o_totalprice, 0.9), 6) AS p90,
    round(quantile_cont(o_totalprice, 0.5), 6) AS median FROM orders GROUP BY o_orderpriority"""
)
def percentile_by_group(spark, sf_dir):
    """Exact percentiles of a whole table per group."""
    prices = retail.table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    by = ["o_orderpriority"]
    p90 = percentile(prices, "o_totalprice", 0.9, by=by, method="discrete", name="p90")
    median = percentile(prices, "o_totalprice", 0.5, by=by, method="continuous", name="median")
    return presented(p90.join(median, by))


@workload(
    with_views("shop_orders")
    + """SELECT customer_id, count(*) AS prior_order_count FROM shop_orders WHERE status <> 'P' GROUP BY customer_id"""
)
def prior_order_counts(spark, sf_dir):
    return carts.prior_order_counts(retail.orders(spark, sf_dir), F.col("status") != STATES.cancelled)


@workload(with_views(*SIGNAL_VIEWS) + SIGNAL_SELECT + "cart_signal")
def cart_recovery_signal(spark, sf_dir):
    scored = signal(spark, sf_dir).drop("_gold_computed_at")
    return presented(cart_recovery.ranked(scored, "priority_score", "cart_id"))


@workload(with_views(*SIGNAL_VIEWS) + SIGNAL_SELECT + "cart_signal")
def cart_recovery_incremental(spark, sf_dir):
    """The signal after three increments; a tenth of the events comes one increment late, a tenth too early."""
    store = CartStore(scratch_path(spark, "cart-store"))
    times = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", AS_OF]
    due = F.when(F.col("event_timestamp") < times[0], 0).when(F.col("event_timestamp") < times[1], 1).otherwise(2)
    shift = F.when(F.col("k") % 10 == 0, 1).when(F.col("k") % 10 == 1, -1).otherwise(0)
    events = retail.clickstream(spark, sf_dir).withColumn("increment", F.least(F.greatest(due + shift, F.lit(0)), F.lit(2)))
    for number, as_of in enumerate(times):
        store.advance(spark, number, events.where(F.col("increment") == number), as_of, names=NAMES)
    found = store.signal(spark, 2, retail.orders(spark, sf_dir), AS_OF, states=STATES, percentile_method="discrete")
    return presented(found.drop("_gold_computed_at"))


@workload()
def cart_recovery_signal_approx(spark, sf_dir):
    """The production form: sketch percentile."""
    return signal(spark, sf_dir, percentile_method="approx")


@workload(
    with_views("clickstream", "shop_orders", "cart_state", "latest_abandoned", "latest_cart_signal")
    + SIGNAL_SELECT
    + "latest_cart_signal"
)
def cart_recovery_at_latest_event(spark, sf_dir):
    latest = cart_recovery.latest_event_time(retail.clickstream(spark, sf_dir))
    return presented(signal(spark, sf_dir, as_of=latest).drop("_gold_computed_at"))


@workload(
    with_views(*SIGNAL_VIEWS)
    + """, s AS ("""
    + signal_sql(
        cap="""(SELECT quantile_disc(greatest(added_value - removed_value, 0.0), 0.90) FROM cart_state
            WHERE has_add = 1 AND has_checkout_complete = 0
            AND last_activity_at < TIMESTAMP '2024-01-30 23:30:00' AND last_activity_at > TIMESTAMP '2024-01-01')""",
        loyal="status = 'F'",
    )
    + ")"
    + SIGNAL_SELECT
    + "s"
)
def cart_recovery_documented_variant(spark, sf_dir):
    """The score as documented: 30-day percentile and completed orders only."""
    policy = cart_recovery.CartPolicy(percentile_days=30, completed_orders_only=True)
    return presented(signal(spark, sf_dir, policy=policy).drop("_gold_computed_at"))


@workload(
    with_views("clickstream", "products", "std_products")
    + """SELECT event_id, round(coalesce(CASE WHEN k % 4 <> 0 THEN price_at_event END, p.price), 6) AS effective_price
    FROM clickstream c LEFT JOIN (SELECT sku, price FROM std_products) p ON c.sku = p.sku"""
)
def price_fallback(spark, sf_dir):
    """A quarter of the events lacks its price."""
    events = retail.clickstream(spark, sf_dir).withColumn(
        "price_at_event", F.when(F.col("k") % 4 != 0, F.col("price_at_event"))
    )
    catalogue = standardize.products(retail.products(spark, sf_dir))
    return presented(joins.price_fallback(events, catalogue).select("event_id", "effective_price"))


@workload(
    with_views("clickstream", "shop_orders", "cart_state")
    + """SELECT c.cart_id, c.customer_id, o.order_id, x.n_with_cart, x.n_without_cart FROM cart_state c
    LEFT JOIN (SELECT customer_id, cart_id, order_id FROM shop_orders) o
        ON o.customer_id = c.customer_id AND o.cart_id = c.cart_id
    JOIN (SELECT count(cart_id) AS n_with_cart, count(*) - count(cart_id) AS n_without_cart FROM shop_orders) x ON true"""
)
def cart_order_linkage(spark, sf_dir):
    shop_orders = retail.orders(spark, sf_dir)
    linked = joins.link_orders(carts.cart_state(retail.clickstream(spark, sf_dir), NAMES), shop_orders)
    origin = joins.orders_by_origin(shop_orders).select(F.struct("*").alias("o")).scalar()
    return linked.select("cart_id", "customer_id", "order_id", origin.alias("o")).select(
        "cart_id", "customer_id", "order_id", "o.n_with_cart", "o.n_without_cart"
    )


VIEWS["visits"] = """
    SELECT session_id, n AS session_number, min(min(event_timestamp)) OVER (PARTITION BY session_id, n) AS started_at,
        customer_id, cart_id
    FROM (SELECT *, sum(CASE WHEN before IS NULL OR event_timestamp > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
            OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS n
        FROM (SELECT *, lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS before
            FROM clickstream))
    GROUP BY session_id, n, customer_id, cart_id
    QUALIFY customer_id IS NOT NULL AND cart_id IS NOT NULL
"""
VIEWS["linked_visits"] = """
    SELECT v.*, order_id, order_created_at FROM visits v LEFT JOIN placed_orders o
        ON o.customer_id = v.customer_id AND o.cart_id = v.cart_id
        AND o.order_created_at BETWEEN v.started_at AND v.started_at + INTERVAL 7 DAY
"""
LINKED_VIEWS = ("clickstream", "shop_orders", "placed_orders", "visits", "linked_visits")


@workload(
    with_views(*LINKED_VIEWS)
    + f"""SELECT session_id, CAST(session_number AS BIGINT) AS session_number, {sql_time("started_at", "started_at")},
    customer_id, cart_id, order_id, {sql_time("order_created_at", "order_created_at")} FROM linked_visits"""
)
def session_order_linkage(spark, sf_dir):
    """Sessions with the orders placed within seven days of their first event."""
    sessions_ = staged(conversions.visits(retail.clickstream(spark, sf_dir)), "visits")
    return presented(conversions.linked_visits(sessions_, retail.placed_orders(spark, sf_dir)))


@workload(
    with_views(*LINKED_VIEWS, "lags")
    + f"""SELECT count(*) AS n_carts, round(quantile_disc(lag_minutes, 0.5), 6) AS conversion_lag_median_minutes FROM lags
    WHERE checkout_complete_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF}'
        AND cart_id IN (SELECT cart_id FROM linked_visits WHERE order_id IS NOT NULL)"""
)
def linked_conversion_lag(spark, sf_dir):
    """The conversion lag as documented: only of carts whose session led to an order within seven days."""
    lags = staged(
        conversions.linked_conversion_lags(
            retail.clickstream(spark, sf_dir), retail.placed_orders(spark, sf_dir), AS_OF, NAMES
        ).select("lag_minutes"),
        "linked-lags",
    )
    median = percentile(lags, "lag_minutes", 0.5, method="discrete").scalar()
    return presented(lags.agg(F.count(F.lit(1)).alias("n_carts")).withColumn("conversion_lag_median_minutes", median))


TIER_SQL = """CASE WHEN priority_score >= 80 THEN '🔴 Act now' WHEN priority_score >= 60 THEN '🟠 Today'
    WHEN priority_score >= 40 THEN '🟡 Monitor' ELSE '⚪ Low' END"""


@workload(
    with_views(*SIGNAL_VIEWS, "customers", "std_customers")
    + f"""SELECT cart_id, s.customer_id, CASE WHEN is_returning THEN 'returning' WHEN NOT is_returning THEN 'new' END
        AS customer_segment, round(minutes_since_last_activity, 6) AS minutes_since_last_activity,
    round(recoverable_cart_value, 6) AS recoverable_cart_value, item_count, {TIER_SQL} AS priority_tier,
    round(priority_score, 6) AS priority_score
    FROM cart_signal s LEFT JOIN std_customers c ON s.customer_id = c.customer_id"""
)
def cart_ops_table(spark, sf_dir):
    people = standardize.customers(retail.customers(spark, sf_dir))
    return presented(reports.cart_action_list(signal(spark, sf_dir), people))


@workload(
    with_views(*SIGNAL_VIEWS)
    + """SELECT CAST(least(floor(priority_score / 10), 9) AS INTEGER) AS bucket, count(*) AS n_rows
    FROM cart_signal GROUP BY 1"""
)
def score_histogram(spark, sf_dir):
    return histogram(signal(spark, sf_dir), "priority_score")


@workload(
    with_views(*SIGNAL_VIEWS)
    + """SELECT cart_id, round(priority_score, 6) AS priority_score FROM cart_signal
    ORDER BY cart_signal.priority_score DESC, cart_id LIMIT 20"""
)
def top_n_carts(spark, sf_dir):
    best = cart_recovery.top(signal(spark, sf_dir), "priority_score", "cart_id", 20)
    return presented(best.select("cart_id", "priority_score"))


@workload(
    with_views("clickstream")
    + f"""SELECT event_id, event_type, {sql_time("event_timestamp", "event_timestamp")} FROM clickstream
    WHERE cart_id = (SELECT min(cart_id) FROM clickstream)"""
)
def cart_drillthrough(spark, sf_dir):
    events = retail.clickstream(spark, sf_dir)
    wanted = events.agg(F.min("cart_id")).scalar()
    return presented(carts.cart_history(events, wanted).select("event_id", "event_type", "event_timestamp"))


@workload(
    with_views("clickstream")
    + """, ordered AS (SELECT *, lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS before
        FROM clickstream),
    numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR event_timestamp > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS session_number FROM ordered)
    """
    + f"""SELECT session_id, CAST(session_number AS BIGINT) AS session_number, {sql_time("min(event_timestamp)", "started_at")},
    {sql_time("max(event_timestamp)", "ended_at")}, count(*) AS n_events FROM numbered GROUP BY session_id, session_number"""
)
def sessionize(spark, sf_dir):
    numbered = sessions.sessionize(
        retail.clickstream(spark, sf_dir).select("event_id", "session_id", "event_timestamp")
    )
    return presented(sessions.session_summary(numbered))
