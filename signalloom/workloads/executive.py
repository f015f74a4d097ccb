"""Headline KPIs, the daily row, its rebuilt history and the trend measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.functions.calendar import calendar
from signalloom.functions.tiers import percent_label, traffic_light
from signalloom.operators import measures, sketches, versions
from signalloom.operators.carts import conversion_lags
from signalloom.operators.staging import staged
from signalloom.plans import executive
from signalloom.session import scratch_path
from signalloom.sinks.tables import read_table, upsert
from signalloom.workloads import carts, fulfillment, retail
from signalloom.workloads.registry import presented, sql_day, sql_time, workload
from signalloom.workloads.retail import AS_OF, NAMES, STATES, VIEWS, with_views

BOTH_SIGNALS = ("clickstream", "cart_state", "abandoned", "shop_orders", "cart_signal", *fulfillment.RISK_VIEWS[1:])

REVENUE = "(SELECT coalesce(sum(recoverable_cart_value), 0.0) FROM cart_signal WHERE priority_score >= 60)"
DELAYED = "(SELECT coalesce(sum(order_total_usd), 0.0) FROM risk_signal WHERE fulfillment_risk_score >= 60)"
RATE = f"""(SELECT avg(CAST(CAST(delivered_at AS DATE) <= promised_delivery_date AS INTEGER)) FROM shipments
    WHERE delivered_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF}')"""
LAG = f"""(SELECT quantile_disc(lag_minutes, 0.5) FROM lags
    WHERE checkout_complete_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY)"""


@workload(with_views(*carts.SIGNAL_VIEWS) + f"SELECT round({REVENUE}, 2) AS recoverable_revenue")
def recoverable_revenue(spark, sf_dir):
    return presented(executive.recoverable_revenue(carts.signal(spark, sf_dir)))


@workload(with_views(*fulfillment.RISK_VIEWS) + f"SELECT round({DELAYED}, 2) AS delayed_order_revenue_risk")
def delayed_revenue_risk(spark, sf_dir):
    return presented(executive.delayed_revenue_risk(fulfillment.signal(spark, sf_dir)))


@workload(
    with_views(*fulfillment.RISK_VIEWS)
    + "SELECT count(*) AS at_risk_orders FROM risk_signal WHERE fulfillment_risk_score >= 60"
)
def at_risk_count(spark, sf_dir):
    return executive.at_risk_orders(fulfillment.signal(spark, sf_dir))


@workload(
    with_views(*BOTH_SIGNALS)
    + f"""SELECT round({REVENUE}, 2) AS recoverable_revenue, round({DELAYED}, 2) AS delayed_order_revenue_risk,
    (SELECT count(*) FROM risk_signal WHERE fulfillment_risk_score >= 60) AS at_risk_orders"""
)
def live_headline(spark, sf_dir):
    return presented(
        executive.live_headline(carts.signal(spark, sf_dir), fulfillment.signal(spark, sf_dir))
    )


@workload(with_views("clickstream", "lags") + f"SELECT round({LAG}, 6) AS conversion_lag_median_minutes")
def conversion_lag_median(spark, sf_dir):
    return presented(
        executive.conversion_lag_median(
            retail.clickstream(spark, sf_dir), AS_OF, names=NAMES, method="discrete"
        )
    )


DAILY_SQL = f"""SELECT '{AS_OF[:10]}' AS metric_date, round({REVENUE}, 2) AS recoverable_revenue,
    round({DELAYED}, 2) AS delayed_order_revenue_risk, round({RATE}, 6) AS on_time_delivery_rate,
    round({LAG}, 6) AS conversion_lag_median_minutes"""


@workload(with_views(*BOTH_SIGNALS, "lags") + DAILY_SQL)
def exec_summary_daily(spark, sf_dir):
    """The day's row merged into the history twice, and read back."""
    row = executive.daily_summary(
        carts.signal(spark, sf_dir),
        fulfillment.signal(spark, sf_dir),
        retail.shipments(spark, sf_dir),
        retail.clickstream(spark, sf_dir),
        AS_OF,
        names=NAMES,
        method="discrete",
    )
    path = scratch_path(spark, "exec-summary")
    stale = row.withColumn("recoverable_revenue", F.lit(0.0))
    upsert(spark, stale, path, ["metric_date"], n_buckets=1)
    upsert(spark, row, path, ["metric_date"], n_buckets=1)
    return presented(read_table(spark, path))


def days_of_events(spark, sf_dir):
    """The first and the last day that the events span."""
    span = retail.table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    return str(span["a"].date()), str(span["b"].date())


VIEWS["closes"] = """
    SELECT CAST(d AS DATE) AS d, d + INTERVAL 23 HOUR + INTERVAL 59 MINUTE AS closing
    FROM (SELECT unnest(generate_series((SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) FROM events),
        (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) FROM events), INTERVAL 1 DAY)) AS d)
"""
VIEWS["day_carts"] = """
    SELECT d, closing, cart_id,
        arg_min(customer_id, (event_timestamp, customer_id)) FILTER (customer_id IS NOT NULL) AS customer_id,
        max(event_timestamp) AS last_activity_at,
        greatest(sum(CASE WHEN event_type = 'click' THEN price_at_event * quantity ELSE 0.0 END)
            - sum(CASE WHEN event_type = 'error' THEN price_at_event * quantity ELSE 0.0 END), 0.0)
            AS recoverable_cart_value,
        (floor(epoch(closing)) - floor(epoch(max(event_timestamp)))) / 60.0 AS minutes_idle
    FROM closes JOIN clickstream ON event_timestamp <= closing
    WHERE event_type IN ('click', 'error', 'signup', 'purchase')
    GROUP BY d, closing, cart_id
    HAVING count(*) FILTER (event_type = 'click') > 0 AND count(*) FILTER (event_type = 'purchase') = 0
        AND max(event_timestamp) < closing - INTERVAL 30 MINUTE AND max(event_timestamp) > closing - INTERVAL 7 DAY
"""
VIEWS["day_revenue"] = """
    SELECT d, sum(recoverable_cart_value) AS revenue FROM (
        SELECT c.d, recoverable_cart_value, 0.45 * 100 * exp(-minutes_idle / 180.0)
            + 0.40 * 100 * least(recoverable_cart_value / coalesce(nullif(cap, 0), 1.0), 1.0)
            + 0.15 * CASE WHEN customer_id IN (SELECT customer_id FROM shop_orders WHERE status <> 'P') THEN 100 ELSE 40 END
            AS priority
        FROM day_carts c JOIN (SELECT d, quantile_disc(recoverable_cart_value, 0.9) AS cap FROM day_carts GROUP BY d) q
            ON c.d = q.d) WHERE priority >= 60 GROUP BY d
"""
VIEWS["day_delayed"] = """
    SELECT d, sum(order_total_usd) AS delayed FROM exposed_orders, closes
    WHERE 0.5 * 100 * (1 - least(greatest(promised_delivery_date - d, 0) / carrier_avg_transit_days, 1.0))
        + 0.3 * CASE WHEN has_backordered_item THEN 100 ELSE 0 END + 0.2 * carrier_risk_score >= 60
    GROUP BY d
"""
VIEWS["day_rate"] = """
    SELECT d, avg(CAST(CAST(delivered_at AS DATE) <= promised_delivery_date AS INTEGER)) AS rate FROM shipments, closes
    WHERE delivered_at BETWEEN closing - INTERVAL 30 DAY AND closing GROUP BY d
"""
VIEWS["day_lag"] = """
    SELECT d, quantile_disc(lag_minutes, 0.5) AS lag FROM lags, closes
    WHERE checkout_complete_at BETWEEN closing - INTERVAL 30 DAY AND closing AND first_add_at IS NOT NULL GROUP BY d
"""


@workload(
    with_views(
        "clickstream", "lags", *fulfillment.RISK_VIEWS[:-1], "closes", "day_carts", "day_revenue", "day_delayed",
        "day_rate", "day_lag",
    )
    + f"""SELECT {sql_day("closes.d", "metric_date")}, round(coalesce(revenue, 0.0), 2) AS recoverable_revenue,
    round(coalesce(delayed, 0.0), 2) AS delayed_order_revenue_risk, round(rate, 4) AS on_time_delivery_rate,
    round(lag, 1) AS conversion_lag_median_minutes
    FROM closes LEFT JOIN day_revenue USING (d) LEFT JOIN day_delayed USING (d) LEFT JOIN day_rate USING (d)
    LEFT JOIN day_lag USING (d)"""
)
def exec_history_backfill(spark, sf_dir):
    return presented(
        executive.summary_history(
            retail.clickstream(spark, sf_dir),
            retail.orders(spark, sf_dir),
            retail.shipments(spark, sf_dir),
            retail.order_items(spark, sf_dir),
            retail.inventory(spark, sf_dir),
            *days_of_events(spark, sf_dir),
            names=NAMES,
            states=STATES,
            method="discrete",
        )
    )


# The history from order states as they were recorded.

VIEWS["day_delayed_recorded"] = """
    SELECT d, sum(order_total_usd) AS delayed
    FROM (SELECT v.*, s.carrier_avg_transit_days, s.carrier_historical_late_rate_pct AS carrier_risk_score,
            order_id IN (SELECT order_id FROM backordered) AS has_backordered_item
        FROM order_versions v JOIN shipments s USING (order_id)
        WHERE v.status = 'O' AND v.promised_delivery_date IS NOT NULL) o
    JOIN closes ON closing >= seen_at AND (valid_to IS NULL OR closing < valid_to)
    WHERE 0.5 * 100 * (1 - least(greatest(promised_delivery_date - d, 0) / carrier_avg_transit_days, 1.0))
        + 0.3 * CASE WHEN has_backordered_item THEN 100 ELSE 0 END + 0.2 * carrier_risk_score >= 60
    GROUP BY d
"""
VIEWS["day_loyal"] = """
    SELECT DISTINCT d, customer_id FROM order_versions JOIN closes
        ON closing >= seen_at AND (valid_to IS NULL OR closing < valid_to) WHERE status <> 'P'
"""
VIEWS["day_revenue_recorded"] = """
    SELECT d, sum(recoverable_cart_value) AS revenue FROM (
        SELECT c.d, recoverable_cart_value, 0.45 * 100 * exp(-minutes_idle / 180.0)
            + 0.40 * 100 * least(recoverable_cart_value / coalesce(nullif(cap, 0), 1.0), 1.0)
            + 0.15 * CASE WHEN l.customer_id IS NOT NULL THEN 100 ELSE 40 END AS priority
        FROM day_carts c JOIN (SELECT d, quantile_disc(recoverable_cart_value, 0.9) AS cap FROM day_carts GROUP BY d) q
            ON c.d = q.d LEFT JOIN day_loyal l ON l.d = c.d AND l.customer_id = c.customer_id)
    WHERE priority >= 60 GROUP BY d
"""
RECORDED_VIEWS = (
    "clickstream", "lags", "shop_orders", "shipments", "order_items", "inventory", "backordered", "order_extracts",
    "order_versions", "closes", "day_carts", "day_loyal", "day_revenue_recorded", "day_delayed_recorded", "day_rate", "day_lag",
)
RECORDED_SQL = """
    SELECT closes.d, round(coalesce(revenue, 0.0), 2) AS recoverable_revenue,
        round(coalesce(delayed, 0.0), 2) AS delayed_order_revenue_risk, round(rate, 4) AS on_time_delivery_rate,
        round(lag, 1) AS conversion_lag_median_minutes
    FROM closes LEFT JOIN day_revenue_recorded USING (d) LEFT JOIN day_delayed_recorded USING (d)
        LEFT JOIN day_rate USING (d) LEFT JOIN day_lag USING (d)
"""


def recorded_orders(spark, sf_dir):
    """Four extracts recorded in turn, the third one twice, as validity intervals."""
    path = scratch_path(spark, "order-history")
    for day in (*retail.EXTRACT_DAYS[:3], *retail.EXTRACT_DAYS[2:]):
        extract = retail.order_extract(spark, sf_dir, day).select(
            "order_id", "customer_id", "order_total_usd", "status", "promised_delivery_date"
        )
        versions.record_extract(spark, extract, path, ["order_id"], day)
    return staged(versions.intervals(versions.read_history(spark, path), ["order_id"]), "order-versions")


@workload(
    with_views("shop_orders", "order_extracts", "order_versions")
    + f"""SELECT order_id, status, {sql_day("promised_delivery_date", "promised_delivery_date")},
    {sql_time("seen_at", "valid_from")}, {sql_time("valid_to", "valid_to")} FROM order_versions"""
)
def order_state_intervals(spark, sf_dir):
    return presented(
        recorded_orders(spark, sf_dir).select("order_id", "status", "promised_delivery_date", "valid_from", "valid_to")
    )


@workload(
    with_views("shop_orders", "shipments", "order_extracts", "order_versions")
    + """SELECT s.order_id, v.status, count(*) AS n FROM shipments s LEFT JOIN order_versions v
        ON v.order_id = s.order_id AND s.shipped_at >= v.seen_at AND (v.valid_to IS NULL OR s.shipped_at < v.valid_to)
    GROUP BY ALL"""
)
def order_state_when_shipped(spark, sf_dir):
    """The state that each shipment's order was in, as recorded, when it left."""
    sent = retail.shipments(spark, sf_dir).select("order_id", F.col("shipped_at").cast("timestamp").alias("shipped_at"))
    found = versions.as_of(sent, recorded_orders(spark, sf_dir), ["order_id"], "shipped_at")
    return found.groupBy("order_id", "status").agg(F.count(F.lit(1)).alias("n"))


def recorded_history(spark, sf_dir):
    return executive.summary_history(
        retail.clickstream(spark, sf_dir),
        retail.orders(spark, sf_dir),
        # Read twice, and made of all lines.
        staged(retail.shipments(spark, sf_dir), "shipments"),
        retail.order_items(spark, sf_dir),
        retail.inventory(spark, sf_dir),
        *days_of_events(spark, sf_dir),
        names=NAMES,
        states=STATES,
        method="discrete",
        order_versions=recorded_orders(spark, sf_dir),
    )


@workload(
    with_views(*RECORDED_VIEWS)
    + f"SELECT * EXCLUDE (d), {sql_day('d', 'metric_date')} FROM ({RECORDED_SQL})"
)
def exec_history_as_recorded(spark, sf_dir):
    """The daily history with each day's own order states."""
    return presented(recorded_history(spark, sf_dir))


# Trend measures, over a daily history.

VIEWS["all_days"] = """
    SELECT event_date AS metric_date, sum(price_at_event) FILTER (event_type = 'click') AS recoverable_revenue,
        sum(price_at_event) FILTER (event_type = 'error') AS delayed_order_revenue_risk,
        avg(CASE WHEN k % 20 <> 0 THEN 1.0 ELSE 0.0 END) AS on_time_delivery_rate,
        avg(CAST(k AS DOUBLE)) AS conversion_lag_median_minutes
    FROM clickstream GROUP BY event_date
"""
def all_days(spark, sf_dir):
    kind, price = F.col("event_type"), F.col("price_at_event")
    return (
        retail.clickstream(spark, sf_dir)
        .groupBy(F.col("event_date").alias("metric_date"))
        .agg(
            F.sum(F.when(kind == "click", price)).alias("recoverable_revenue"),
            F.sum(F.when(kind == "error", price)).alias("delayed_order_revenue_risk"),
            F.avg((F.col("k") % 20 != 0).cast("int")).alias("on_time_delivery_rate"),
            F.avg("k").alias("conversion_lag_median_minutes"),
        )
    )


ALL_DAYS = with_views("clickstream", "all_days")
LAST_7 = "OVER (ORDER BY metric_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"


@workload(
    f"""SELECT {sql_day("d", "date")}, {sql_day("date_trunc('week', d)", "week_start")},
    {sql_day("date_trunc('month', d)", "month_start")} FROM (
        SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events),
            INTERVAL 1 DAY)) AS d)"""
)
def calendar_days(spark, sf_dir):
    """The days the events span."""
    return presented(calendar(spark, *days_of_events(spark, sf_dir)))


@workload(
    ALL_DAYS
    + f"""SELECT {sql_day("metric_date", "metric_date")},
    round(sum(recoverable_revenue) OVER (ORDER BY metric_date RANGE BETWEEN INTERVAL 0 DAY PRECEDING AND CURRENT ROW), 2) AS d1,
    round(sum(recoverable_revenue) {LAST_7}, 2) AS d7,
    round(sum(recoverable_revenue) OVER (ORDER BY metric_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW), 2) AS d30
    FROM all_days"""
)
def trailing_n_sum(spark, sf_dir):
    out = all_days(spark, sf_dir).select("metric_date", "recoverable_revenue")
    for n_days in (1, 7, 30):
        out = measures.trailing_sum(out, "recoverable_revenue", n_days, f"d{n_days}")
    return presented(out.drop("recoverable_revenue"))


@workload(
    ALL_DAYS
    + f"""SELECT {sql_day("metric_date", "metric_date")}, round(avg(on_time_delivery_rate) {LAST_7}, 6) AS rate_trend FROM all_days"""
)
def rate_trend(spark, sf_dir):
    trend = measures.trailing_average(all_days(spark, sf_dir), "on_time_delivery_rate", 7, "rate_trend")
    return presented(trend.select("metric_date", "rate_trend"))


@workload(
    ALL_DAYS
    + f"""SELECT {sql_day("h.metric_date", "metric_date")},
    round((h.recoverable_revenue - b.recoverable_revenue) / b.recoverable_revenue, 6) AS wow
    FROM all_days h LEFT JOIN all_days b ON b.metric_date = h.metric_date - 7"""
)
def wow_pct(spark, sf_dir):
    return presented(
        measures.week_over_week(all_days(spark, sf_dir), "recoverable_revenue", "wow").select("metric_date", "wow")
    )


LIGHT = "CASE WHEN {0} >= 0.95 THEN 'green' WHEN {0} >= 0.9 THEN 'amber' WHEN {0} IS NOT NULL THEN 'red' END"
BY_DAY = LAST_7.replace("metric_date", "d")
TREND_SQL = f"""t AS (SELECT d AS metric_date, sum(recoverable_revenue) {BY_DAY} AS revenue,
        sum(delayed_order_revenue_risk) {BY_DAY} AS delayed, avg(on_time_delivery_rate) {BY_DAY} AS rate,
        avg(conversion_lag_median_minutes) {BY_DAY} AS lag
        FROM closes LEFT JOIN history ON metric_date = d)
    SELECT {sql_day("t.metric_date", "metric_date")}, round(t.revenue, 2) AS recoverable_revenue_trailing,
    round(t.delayed, 2) AS delayed_order_revenue_risk_trailing,
    round((t.revenue - b.revenue) / nullif(b.revenue, 0), 6) AS recovery_wow, round(t.rate, 6) AS on_time_rate_trend,
    printf('%.1f%%', t.rate * 100) AS on_time_rate_label, {LIGHT.format("t.rate")} AS on_time_light,
    round(t.lag, 6) AS conversion_lag_trend FROM t LEFT JOIN t b ON b.metric_date = t.metric_date - 7"""


@workload(
    with_views("clickstream", "all_days", "closes")
    + f""", history AS (SELECT * FROM all_days), {TREND_SQL}"""
)
def kpi_trend(spark, sf_dir):
    return presented(measures.kpi_trend(all_days(spark, sf_dir), calendar(spark, *days_of_events(spark, sf_dir))))


@workload(with_views(*RECORDED_VIEWS) + f", history AS (SELECT d AS metric_date, * EXCLUDE (d) FROM ({RECORDED_SQL})), {TREND_SQL}")
def kpi_trend_as_recorded(spark, sf_dir):
    """The trend page over the daily history that was rebuilt from recorded order states."""
    rebuilt = staged(recorded_history(spark, sf_dir), "rebuilt-history")
    return presented(measures.kpi_trend(rebuilt, calendar(spark, *days_of_events(spark, sf_dir))))


@workload(
    ALL_DAYS
    + """SELECT round(avg(on_time_delivery_rate), 6) AS avg_on_time_rate,
    round(avg(conversion_lag_median_minutes), 6) AS avg_median_lag FROM all_days"""
)
def history_averages(spark, sf_dir):
    return presented(measures.history_averages(all_days(spark, sf_dir)))


@workload(
    ALL_DAYS
    + f"""SELECT {sql_day("date_trunc('week', metric_date)", "week_start")}, count(*) AS n_days,
    round(sum(recoverable_revenue), 2) AS recoverable_revenue,
    round(sum(delayed_order_revenue_risk), 2) AS delayed_order_revenue_risk,
    round(avg(on_time_delivery_rate), 6) AS avg_on_time_rate, round(avg(conversion_lag_median_minutes), 6) AS avg_median_lag
    FROM all_days GROUP BY date_trunc('week', metric_date)"""
)
def weekly_rollup(spark, sf_dir):
    return presented(measures.weekly_rollup(all_days(spark, sf_dir)))


@workload(
    ALL_DAYS
    + f"""SELECT {sql_day("metric_date", "metric_date")}, {LIGHT.format("on_time_delivery_rate")} AS light,
    printf('%.1f%%', on_time_delivery_rate * 100) AS label FROM all_days"""
)
def rag_status(spark, sf_dir):
    rate = F.col("on_time_delivery_rate")
    return presented(
        all_days(spark, sf_dir).select(
            "metric_date", traffic_light(rate).alias("light"), percent_label(rate).alias("label")
        )
    )


@workload(
    with_views("clickstream", "shop_orders", "shipments")
    + f"""SELECT dataset, {sql_time("latest_at", "latest_at")}, sla_minutes,
    round((epoch(TIMESTAMP '{AS_OF}') - floor(epoch(latest_at))) / 60.0, 6) AS lag_minutes,
    (epoch(TIMESTAMP '{AS_OF}') - floor(epoch(latest_at))) / 60.0 <= sla_minutes AS within_sla FROM (
        SELECT 'clickstream' AS dataset, max(event_timestamp) AS latest_at, 15.0::DOUBLE AS sla_minutes FROM clickstream
        UNION ALL SELECT 'orders', max(order_created_at), 1440.0 FROM shop_orders
        UNION ALL SELECT 'shipments', max(shipped_at), 1440.0 FROM shipments)"""
)
def freshness(spark, sf_dir):
    datasets = {
        "clickstream": (retail.clickstream(spark, sf_dir), "event_timestamp"),
        "orders": (retail.orders(spark, sf_dir), "order_created_at"),
        "shipments": (retail.shipments(spark, sf_dir), "shipped_at"),
    }
    limits = {"clickstream": 15, "orders": 1440, "shipments": 1440}
    return presented(measures.freshness(datasets, limits, AS_OF))


# Quantiles of spans of days, from sketches kept per day. An answer is right if its rank is within the sketch's bound.


def judged(spark, answers, values, by, quantiles):
    """``answers`` with, instead of each quantile, whether enough and not too many of the group's values lie below it."""
    slack = sketches.rank_error() + 1e-9
    q = answers.select(*by, *quantiles)
    found = values.join(F.broadcast(q), by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.struct(F.count_if(F.col("_value") < F.col(c)).alias("below"), F.count_if(F.col("_value") <= F.col(c)).alias("upto")).alias(c)
            for c in quantiles
        ],
    )
    right = {c: (F.col(f"{c}.below") <= (p + slack) * F.col("_n") + 1) & (F.col(f"{c}.upto") >= (p - slack) * F.col("_n") - 1) for c, p in quantiles.items()}
    return answers.drop(*quantiles).join(found.select(*by, *[x.alias(c) for c, x in right.items()]), by)


VIEWS["day_lags"] = "SELECT CAST(checkout_complete_at AS DATE) AS d, lag_minutes FROM lags WHERE lag_minutes IS NOT NULL"


def recorded_sketches(spark, df, value):
    """Daily sketches kept in a table, the second half of the days in a run of its own, the last day twice."""
    path = scratch_path(spark, "sketches")
    half = F.dayofmonth("metric_date") <= 15
    late = df.where(~half)
    for part in (df.where(half), late, late.where(F.dayofmonth("metric_date") == 30)):
        sketches.record_days(spark, sketches.sketched(part, value, ["metric_date"]), path)
    return read_table(spark, path)


@workload(
    with_views("clickstream", "lags", "day_lags")
    + f"""SELECT {sql_day("date_trunc('week', d)", "week_start")}, CAST(count(*) AS BIGINT) AS n_values,
    round(min(lag_minutes), 6) AS least, round(max(lag_minutes), 6) AS most, true AS median, true AS p90 FROM day_lags GROUP BY 1"""
)
def weekly_lag_quantiles(spark, sf_dir):
    """A week's median lag over its conversions, not over its days' medians."""
    lags = conversion_lags(retail.clickstream(spark, sf_dir), names=NAMES, n_days=None).select(
        F.to_date("checkout_complete_at").alias("metric_date"), "lag_minutes"
    )
    lags = staged(lags.where("lag_minutes IS NOT NULL"), "day-lags")
    quantiles = {"median": 0.5, "p90": 0.9}
    weekly = staged(sketches.with_quantiles(sketches.per_week(recorded_sketches(spark, lags, "lag_minutes")), quantiles), "weekly")
    values = lags.select(F.to_date(F.date_trunc("week", "metric_date")).alias("week_start"), F.col("lag_minutes").alias("_value"))
    return presented(judged(spark, weekly, values, ["week_start"], quantiles))


@workload(
    with_views("clickstream", "closes", "day_carts")
    + f"""SELECT {sql_day("c.d", "metric_date")}, CAST(count(*) AS BIGINT) AS n_values, round(min(recoverable_cart_value), 6) AS least,
    round(max(recoverable_cart_value), 6) AS most, true AS p90
    FROM closes c JOIN day_carts v ON v.d BETWEEN c.d - 6 AND c.d GROUP BY c.d"""
)
def trailing_value_p90(spark, sf_dir):
    """For each day the 90th percentile of the values of carts abandoned at the last seven closes."""
    first, last = days_of_events(spark, sf_dir)
    values = staged(
        executive.abandoned_by_day(retail.clickstream(spark, sf_dir), first, last, names=NAMES).select("metric_date", "recoverable_cart_value"),
        "day-values",
    )
    daily = recorded_sketches(spark, values, "recoverable_cart_value")
    answers = staged(sketches.with_quantiles(sketches.trailing(daily, 7, first, last), {"p90": 0.9}), "trailing")
    spread = values.select(
        F.explode(F.sequence("metric_date", F.least(F.date_add("metric_date", 6), F.lit(last).cast("date")))).alias("metric_date"),
        F.col("recoverable_cart_value").alias("_value"),
    )
    return presented(judged(spark, answers, spread, ["metric_date"], {"p90": 0.9}))
