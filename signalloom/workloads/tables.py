"""Sources, sinks, merges, the batch refresh and the layout jobs; written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.operators import layout, quality, standardize
from signalloom.plans.refresh import refresh
from signalloom.session import scratch_path
from signalloom.sinks import tables
from signalloom.sinks.audit import audited, read_audit_log
from signalloom.sources.files import EXTRACTS, Lake, read_extracts, read_json_landing
from signalloom.operators.staging import staged
from signalloom.sources import discovery
from signalloom.sources.rescue import rescued_json
from signalloom.streaming.landing import CLICKSTREAM
from signalloom.workloads import carts, executive, retail
from signalloom.workloads.registry import presented, sql_day, sql_time, workload
from signalloom.workloads.quality import CHECKED, retried_clickstream
from signalloom.workloads.retail import AS_OF, NAMES, VIEWS, with_views

RETAIL_STATUS = "CASE status WHEN 'O' THEN 'in_transit' WHEN 'F' THEN 'delivered' ELSE 'cancelled' END"


def export_extracts(spark, sf_dir, names) -> str:
    """The order domain as CSV extracts with the declared columns."""
    folder = scratch_path(spark, "extracts")
    status = F.expr(RETAIL_STATUS)
    frames = {
        "customers": lambda: retail.customers(spark, sf_dir),
        "products": lambda: retail.products(spark, sf_dir),
        "inventory": lambda: retail.inventory(spark, sf_dir),
        "orders": lambda: retail.orders(spark, sf_dir).withColumn("status", status),
        # Extracts hold a key once.
        "order_items": lambda: retail.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
            F.sum(F.col("l_quantity").cast("int")).alias("qty"), F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price")
        ).select(F.concat(F.lit("O"), "l_orderkey").alias("order_id"), F.concat(F.lit("SKU"), "l_partkey").alias("sku"), "qty", "unit_price"),
        "shipments": lambda: retail.shipments(spark, sf_dir).withColumn("status", status),
    }
    for extract in EXTRACTS:
        if extract.name in names:
            df = frames[extract.name]()
            columns = [
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in extract.schema.fields
            ]
            tables.export_csv(df.select(*columns), f"{folder}/{extract.name}.csv")
    return folder


@workload(
    with_views("shop_orders", "inventory")
    + f"""SELECT order_id AS key, customer_id AS owner, {sql_time("order_created_at", "at")},
    {sql_day("promised_delivery_date", "promised")}, round(order_total_usd, 6) AS amount, true AS has_lineage
    FROM shop_orders UNION ALL
    SELECT sku || '@' || warehouse_id, CAST(backorder_flag AS VARCHAR), NULL, NULL, CAST(on_hand_qty AS DOUBLE), true
    FROM inventory"""
)
def csv_ingest(spark, sf_dir):
    folder = export_extracts(spark, sf_dir, {"orders", "inventory"})
    extracts = read_extracts(spark, folder, [e for e in EXTRACTS if e.name in ("orders", "inventory")])
    lineage = (
        F.col("_source_file").endswith(".csv")
        & F.col("_bronze_ingested_at").isNotNull()
        & (F.col("_batch_run_id") == "manual")
    ).alias("has_lineage")
    orders = extracts["orders"].select(
        F.col("order_id").alias("key"),
        F.col("customer_id").alias("owner"),
        F.col("order_created_at").alias("at"),
        F.col("promised_delivery_date").alias("promised"),
        F.col("order_total_usd").alias("amount"),
        lineage,
    )
    stock = extracts["inventory"].select(
        F.concat_ws("@", "sku", "warehouse_id").alias("key"),
        F.col("backorder_flag").cast("string").alias("owner"),
        F.lit(None).cast("timestamp").alias("at"),
        F.lit(None).cast("date").alias("promised"),
        F.col("on_hand_qty").cast("double").alias("amount"),
        lineage,
    )
    return presented(orders.unionByName(stock))


def raw_records(spark, sf_dir):
    """The untidy clickstream in its raw form: times as ISO text under the producer's names."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    return (
        retail.dirty_clickstream(spark, sf_dir)
        .withColumns(
            {
                "event_timestamp": F.date_format("event_timestamp", iso),
                "_ingested_at": F.date_format("producer_ingested_at", iso),
                "page_type": F.when(F.col("event_type") == "view", "product"),
            }
        )
        .select(*CLICKSTREAM.fieldNames(), F.col("event_date").alias("dt"), "k")
    )


@workload(
    with_views("clickstream", "dirty_clickstream")
    + f"""SELECT event_id, event_type, quantity, round(price_at_event, 6) AS price_at_event, {sql_day("event_date", "dt")}
    FROM dirty_clickstream"""
)
def json_partitioned_scan(spark, sf_dir):
    folder = scratch_path(spark, "json")
    raw_records(spark, sf_dir).drop("k").write.partitionBy("dt").json(folder)
    landed = read_json_landing(spark, folder)
    return presented(landed.select("event_id", "event_type", "quantity", "price_at_event", "dt"))


@workload(
    with_views("clickstream")
    + """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type NOT IN ('error', 'signup') THEN quantity END AS quantity,
    CASE event_type WHEN 'error' THEN '_line=#' || event_id WHEN 'signup' THEN 'quantity=many'
        WHEN 'purchase' THEN 'coupon=C' || quantity ELSE '' END AS rescued
    FROM clickstream"""
)
def rescued_data(spark, sf_dir):
    """Error events are no JSON, sign-ups have text for a number, purchases an unknown field."""
    kind = F.col("event_type")
    good = F.to_json(F.struct("event_id", "event_type", "quantity"))
    wrong_type = F.to_json(F.struct("event_id", "event_type", F.lit("many").alias("quantity")))
    extra = F.to_json(
        F.struct("event_id", "event_type", "quantity", F.concat(F.lit("C"), "quantity").alias("coupon"))
    )
    line = (
        F.when(kind == "error", F.concat(F.lit("#"), "event_id"))
        .when(kind == "signup", wrong_type)
        .when(kind == "purchase", extra)
        .otherwise(good)
    )
    rows = rescued_json(retail.clickstream(spark, sf_dir).select(line.alias("value")), CLICKSTREAM)
    text = F.array_join(
        F.transform(F.map_entries(F.col("_rescued_data")), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
    )
    return rows.select("event_id", "quantity", F.coalesce(text, F.lit("")).alias("rescued"))


def evolving_lines(spark, sf_dir):
    """Events with fields that the schema has not: points, a rate, a coupon, tags and an address, and lines of rubbish."""
    kind, k = F.col("event_type"), F.col("k")
    rows = retail.clickstream(spark, sf_dir).select(
        "event_id", "event_type", "quantity",
        F.when(kind == "click", k).alias("points"),
        F.when(kind == "error", k / 2 + 0.25).alias("rate"),
        F.when(kind == "purchase", F.concat(F.lit("C"), "quantity")).alias("coupon"),
        F.when(kind == "signup", F.array("quantity")).alias("tags"),
        F.when(kind == "signup", F.struct(F.col("quantity").alias("no"), F.col("session_id").alias("street"))).alias("address's"),
    )
    line = F.to_json(F.struct(*rows.columns))
    rubbish = F.when(F.col("event_type") == "view", F.concat(F.lit("["), "event_id", F.lit("]"))).otherwise(line)
    return rows.select("event_id", rubbish.alias("value"))


@workload(
    with_views("clickstream")
    + """, f AS (SELECT unnest([CASE WHEN event_type = 'click' THEN 'points' END, CASE WHEN event_type = 'error' THEN 'rate' END,
        CASE WHEN event_type = 'purchase' THEN 'coupon' END, CASE WHEN event_type = 'signup' THEN 'tags' END,
        CASE WHEN event_type = 'signup' THEN 'address''s' END]) AS field FROM clickstream)
    SELECT field, count(*) AS n_rows, 0::BIGINT AS n_nulls, CASE field WHEN 'points' THEN 'BIGINT' WHEN 'rate' THEN 'DOUBLE'
        WHEN 'coupon' THEN 'STRING' ELSE 'STRING' END AS promoted_to FROM f WHERE field IS NOT NULL GROUP BY field"""
)
def unknown_fields_report(spark, sf_dir):
    lines = staged(evolving_lines(spark, sf_dir), "lines")
    report = staged(discovery.unknown_fields(lines, CLICKSTREAM), "report")
    kinds = discovery.promotable(report)
    to = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return report.select("field", "n_rows", "n_nulls", F.element_at(to, F.col("field")).alias("promoted_to"))


@workload(
    with_views("clickstream")
    + """SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(k AS BIGINT) END AS points,
    CASE WHEN event_type = 'error' THEN round(k / 2 + 0.25, 6) END AS rate,
    CASE WHEN event_type = 'purchase' THEN 'C' || quantity END AS coupon,
    CASE WHEN event_type = 'signup' THEN '{"no":' || quantity || ',"street":"' || session_id || '"}' END AS address,
    CASE WHEN event_type = 'signup' THEN '[' || quantity || ']' END AS tags FROM clickstream"""
)
def promoted_fields(spark, sf_dir):
    """Every field that the report names as a column."""
    lines = staged(evolving_lines(spark, sf_dir), "lines")
    kinds = discovery.promotable(discovery.unknown_fields(lines, CLICKSTREAM))
    rows = discovery.promoted(lines, kinds).withColumnRenamed("address's", "address")
    return presented(rows.select("event_id", "points", "rate", "coupon", "address", "tags"))


@workload(
    """SELECT 'count_orders' AS job_name, 'silver' AS layer, 'retail_dev.silver.orders' AS target_table,
    count(*) AS row_count, 'success' AS status FROM orders
    UNION ALL SELECT 'count_orders', 'silver', 'retail_dev.silver.orders', NULL, 'failed'"""
)
def literal_rows_audit(spark, sf_dir):
    """A run that succeeds and one that fails, as the audit log shows them."""
    lake = Lake(scratch_path(spark, "lake"))
    with audited(spark, lake, "count_orders", "silver", "orders") as counts:
        counts.row_count = retail.orders(spark, sf_dir).count()
    try:
        with audited(spark, lake, "count_orders", "silver", "orders"):
            raise LookupError("no such table")
    except LookupError:
        pass
    return read_audit_log(spark, lake).select("job_name", "layer", "target_table", "row_count", "status")


@workload(
    with_views(*carts.SIGNAL_VIEWS)
    + "SELECT cart_id, customer_id, round(recoverable_cart_value, 6) AS recoverable_cart_value, item_count FROM cart_signal"
)
def mart_export(spark, sf_dir):
    """A signal as CSV, read back as text."""
    path = scratch_path(spark, "export")
    tables.export_csv(carts.signal(spark, sf_dir), path)
    rows = spark.read.csv(path, header=True)
    value, items = F.col("recoverable_cart_value").cast("double"), F.col("item_count").cast("long")
    return presented(
        rows.select("cart_id", "customer_id", value.alias("recoverable_cart_value"), items.alias("item_count"))
    )


# Merges.


@workload(
    with_views("shop_orders")
    + """SELECT order_id, cart_id, CASE WHEN status = 'O' THEN 'F' ELSE status END AS status,
    round(CASE WHEN status = 'O' THEN order_total_usd + 1 ELSE order_total_usd END, 6) AS order_total_usd
    FROM shop_orders
    UNION ALL SELECT 'again-' || order_id, cart_id, 'O', round(order_total_usd, 6) FROM shop_orders
    WHERE priority = '5-LOW'"""
)
def upsert_merge(spark, sf_dir):
    """Open orders are completed and low-priority ones ordered again; the key has null parts."""
    path, keys = scratch_path(spark, "upsert"), ["order_id", "cart_id"]
    columns = [*keys, "status", "order_total_usd", "priority"]
    orders = retail.orders(spark, sf_dir).select(*columns)
    changed = orders.where("status = 'O'").withColumns(
        {"status": F.lit("F"), "order_total_usd": F.col("order_total_usd") + 1}
    )
    added = orders.where("priority = '5-LOW'").withColumns(
        {"status": F.lit("O"), "order_id": F.concat(F.lit("again-"), "order_id")}
    )
    for source in (orders, changed.unionByName(added), changed.unionByName(added)):
        tables.upsert(spark, source, path, keys, n_buckets=8)
    return presented(tables.read_table(spark, path).drop("priority"))


@workload(
    with_views("clickstream")
    + f"""SELECT event_id, round(CASE WHEN event_type = 'view' THEN price_at_event + 1 ELSE price_at_event END, 6)
    AS price_at_event, {sql_day("event_date", "event_date")} FROM clickstream"""
)
def insert_only_merge(spark, sf_dir):
    """Everything but views is stored first; a later load with other prices adds the views only."""
    path = scratch_path(spark, "insert")
    events = retail.clickstream(spark, sf_dir).select("event_id", "event_type", "price_at_event", "event_date")
    later = events.withColumn("price_at_event", F.col("price_at_event") + 1)
    for source in (events.where("event_type <> 'view'"), later, later):
        tables.insert_new(spark, source, path, "event_id", "event_date")
    return presented(spark.read.parquet(path).drop("event_type"))


VIEWS["newest_actions"] = """
    SELECT cart_id, event_type, event_timestamp, max(producer_ingested_at) AS producer_ingested_at
    FROM retried WHERE cart_id IS NOT NULL GROUP BY ALL
"""


@workload(
    with_views("clickstream", "retried", "newest_actions")
    + f"""SELECT cart_id, event_type, {sql_time("event_timestamp", "event_timestamp")},
    {sql_time("producer_ingested_at", "producer_ingested_at")} FROM newest_actions"""
)
def merge_latest_across_batches(spark, sf_dir):
    """Retries that arrive in a second batch replace the stored copy of the action."""
    path, keys = scratch_path(spark, "merge"), ["cart_id", "event_type", "event_timestamp"]
    rows = retried_clickstream(spark, sf_dir).where(F.col("cart_id").isNotNull())
    rows = rows.withColumn("event_date", F.to_date("event_timestamp"))
    retry = F.col("event_id").startswith("retry-")
    for batch in (rows.where(~retry), rows.where(retry), rows.where(retry)):
        tables.merge_latest(spark, batch, path, keys, "producer_ingested_at", "event_date", ["event_id"])
    return presented(spark.read.parquet(path).drop("event_id", "event_date"))


@workload(
    with_views("products", "std_products")
    + "SELECT sku, category, round(price * 2, 6) AS doubled FROM std_products"
)
def snapshot_overwrite(spark, sf_dir):
    """A second snapshot with another schema replaces the first."""
    path = scratch_path(spark, "snapshot")
    products = standardize.products(retail.products(spark, sf_dir))
    tables.write_snapshot(products, path)
    tables.write_snapshot(
        tables.read_snapshot(spark, path).select("sku", "category", (F.col("price") * 2).alias("doubled")), path
    )
    return presented(tables.read_snapshot(spark, path))


@workload(
    CHECKED
    + """SELECT event_id, reasons AS _dq_fail_reasons, true AS stamped FROM checked_clickstream WHERE reasons <> ''"""
)
def quarantine_append(spark, sf_dir):
    """A batch that is quarantined twice is stored once."""
    path = scratch_path(spark, "quarantine")
    events = standardize.clickstream(retail.dirty_clickstream(spark, sf_dir))
    rules = quality.clickstream_rules(F.col("producer_ingested_at"), NAMES)
    clean, bad = quality.split_once(events, rules, "split")
    tables.write_quarantine(bad, path, 0)
    tables.write_quarantine(bad, path, 0)
    tables.write_quarantine(clean.where(F.lit(False)), path, 1)
    stored = spark.read.parquet(path)
    return presented(
        stored.select("event_id", "_dq_fail_reasons", F.col("_quarantined_at").isNotNull().alias("stamped"))
    )


CLEAN_INVENTORY = f"SELECT * FROM ({VIEWS['inventory']}) WHERE coalesce(on_hand_qty, 0) >= 0"


@workload(
    with_views("clickstream", "shop_orders", "cart_state", "abandoned", "cart_signal", "shipments", "order_items", "lags")
    + f", inventory AS ({CLEAN_INVENTORY}), "
    + ", ".join(f"{v} AS ({VIEWS[v]})" for v in ("open_orders", "backordered", "exposed_orders", "risk_signal"))
    + executive.DAILY_SQL
)
def medallion_refresh(spark, sf_dir):
    """Extracts to signals and KPIs; inventory with negative stock is quarantined."""
    lake = Lake(scratch_path(spark, "lake"))
    folder = export_extracts(spark, sf_dir, {e.name for e in EXTRACTS})
    tables.write_partitions(
        retail.clickstream(spark, sf_dir), lake.path("silver", "clickstream_events"), ["event_date"]
    )
    refresh(spark, lake, folder, AS_OF, names=NAMES, n_buckets=4, method="discrete")
    return presented(tables.read_table(spark, lake.path("gold", "exec_summary_daily")))


@workload(
    with_views("clickstream", "shop_orders", "order_items", "shipments")
    + """, lines AS (SELECT DISTINCT order_id, sku FROM order_items),
    good AS (SELECT order_id FROM shop_orders WHERE cart_id IS NULL
        OR cart_id IN (SELECT cart_id FROM clickstream WHERE cart_id IS NOT NULL))
    SELECT dataset, reasons, count(*) AS n_rows FROM (
        SELECT 'orders' AS dataset, CASE WHEN order_id NOT IN (FROM good) THEN 'orphan_cart_id' ELSE '' END AS reasons FROM shop_orders
        UNION ALL SELECT 'order_items', CASE WHEN order_id NOT IN (FROM good) THEN 'orphan_order_id' ELSE '' END FROM lines
        UNION ALL SELECT 'shipments', CASE WHEN order_id NOT IN (FROM good) THEN 'orphan_order_id' ELSE '' END FROM shipments)
    GROUP BY dataset, reasons"""
)
def refresh_with_references(spark, sf_dir):
    """What a refresh stores and what it puts aside, if carts have to be known by a session and lines by an order."""
    lake = Lake(scratch_path(spark, "lake"))
    folder = export_extracts(spark, sf_dir, {e.name for e in EXTRACTS})
    tables.write_partitions(retail.clickstream(spark, sf_dir), lake.path("silver", "clickstream_events"), ["event_date"])
    refresh(spark, lake, folder, AS_OF, names=NAMES, n_buckets=4, references=True)
    out = None
    for name in ("orders", "order_items", "shipments"):
        kept = tables.read_table(spark, lake.path("silver", name)).select(F.lit("").alias("reasons"))
        bad = spark.read.parquet(lake.path("silver", f"{name}_quarantine")).select(F.array_join("_dq_fail_reasons", ",").alias("reasons"))
        part = kept.unionByName(bad).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("dataset", "reasons").agg(F.count(F.lit(1)).alias("n_rows"))


# Layout.


def stored_events(spark, sf_dir) -> str:
    """The clickstream by day, written in two loads."""
    path = scratch_path(spark, "events")
    events = retail.clickstream(spark, sf_dir).drop("k")
    for part in (events.where("event_type = 'view'"), events.where("event_type <> 'view'")):
        part.write.mode("append").partitionBy("event_date").parquet(path)
    return path


CONTENT_SQL = (
    with_views("clickstream")
    + f"""SELECT event_id, cart_id, {sql_time("event_timestamp", "event_timestamp")}, {sql_day("event_date", "event_date")}
    FROM clickstream"""
)
CONTENT = ["event_id", "cart_id", "event_timestamp", "event_date"]


@workload(CONTENT_SQL)
def compact_layout(spark, sf_dir):
    path = scratch_path(spark, "compact")
    layout.compact(spark.read.parquet(stored_events(spark, sf_dir)), path)
    return presented(spark.read.parquet(path).select(*CONTENT))


@workload(CONTENT_SQL)
def clustered_layout(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    layout.cluster_table(spark, stored_events(spark, sf_dir), path, "cart_id")
    return presented(spark.read.parquet(path).select(*CONTENT))


@workload()
def layout_comparison(spark, sf_dir):
    plain, clustered = stored_events(spark, sf_dir), scratch_path(spark, "clustered")
    layout.cluster_table(spark, plain, clustered, "cart_id")
    return layout.compare_layouts(spark, {"partitioned": plain, "partitioned and clustered": clustered})


@workload(
    with_views("clickstream")
    + """, x AS (SELECT cart_id, event_date AS d FROM clickstream WHERE cart_id IS NOT NULL ORDER BY cart_id, event_date LIMIT 1),
    n AS (SELECT count(*) AS n FROM clickstream, x WHERE clickstream.cart_id = x.cart_id AND event_date >= d - 7)
    SELECT layout, n AS n_found, layout <> 'partitioned' AS scans_less,
        CASE WHEN layout <> 'partitioned' THEN layout = 'with filter' END AS skips_absent
    FROM n, (VALUES ('partitioned'), ('clustered'), ('with filter')) AS l(layout)"""
)
def layout_scan_costs(spark, sf_dir):
    """Rows scanned by the lookup of a cart, and of one that is not there, as the executed scans report them."""
    stored = stored_events(spark, sf_dir)
    events = spark.read.parquet(stored)
    clustered = {"clustered": scratch_path(spark, "clustered"), "with filter": scratch_path(spark, "clustered")}
    # Without a dictionary either way, as a column of very many values has none.
    ordered = events.repartitionByRange(120, "event_date", "cart_id").sortWithinPartitions("event_date", "cart_id")
    plain = ordered.write.partitionBy("event_date").option("parquet.enable.dictionary#cart_id", "false")
    plain.option("parquet.page.row.count.limit", layout.PAGE_ROWS).parquet(clustered["clustered"])
    layout.cluster(events, clustered["with filter"], "cart_id", n_files=120, bloom=True)
    tables_ = {"partitioned": events} | {name: spark.read.parquet(path) for name, path in clustered.items()}
    value, day = layout.sample_lookup(events, "cart_id")
    present = {r["layout"]: r["rows_scanned"] for r in layout.lookup_costs(tables_, "cart_id", value, day).collect()}
    of_clustered = {name: table for name, table in tables_.items() if name in clustered}
    absent = {r["layout"]: r["rows_scanned"] == 0 for r in layout.lookup_costs(of_clustered, "cart_id", f"{value}0", day).collect()}
    rows = [
        (name, layout.point_lookup(table, "cart_id", value, day).count(), present[name] < present["partitioned"], absent.get(name))
        for name, table in tables_.items()
    ]
    return spark.createDataFrame(rows, "layout STRING, n_found LONG, scans_less BOOLEAN, skips_absent BOOLEAN")


@workload(
    with_views("clickstream")
    + f"""SELECT event_id, cart_id, {sql_time("event_timestamp", "event_timestamp")}, {sql_day("event_date", "event_date")}
    FROM clickstream WHERE cart_id = (SELECT min(cart_id) FROM clickstream)
        AND event_date >= (SELECT min(event_date) FROM clickstream WHERE cart_id = (SELECT min(cart_id) FROM clickstream)) - 7"""
)
def point_lookup(spark, sf_dir):
    stored = spark.read.parquet(stored_events(spark, sf_dir))
    value, day = layout.sample_lookup(stored, "cart_id")
    return presented(layout.point_lookup(stored, "cart_id", value, day).select(*CONTENT))
