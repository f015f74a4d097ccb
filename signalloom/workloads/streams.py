"""Streams over files made from the events, drained to the end and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.session import scratch_path
from signalloom.streaming import conform, landing, late, progress, stateful
from signalloom.workloads import carts, retail
from signalloom.workloads.quality import CHECKED, retried_clickstream
from signalloom.workloads.registry import presented, sql_time, workload
from signalloom.workloads.retail import AS_OF, FIRST_DAY, NAMES, with_views
from signalloom.workloads.tables import raw_records


def append_lines(records, folder) -> None:
    records.select(F.to_json(F.struct(*landing.CLICKSTREAM.fieldNames())).alias("value")).write.mode("append").text(folder)


def land(spark, root) -> None:
    landing.start_landing(
        spark, f"{root}/raw", f"{root}/landed", f"{root}/checkpoints/landing"
    ).awaitTermination()


@workload(
    with_views("clickstream", "dirty_clickstream")
    + f"""SELECT event_id, event_type, {sql_time("event_timestamp", "event_timestamp")}, quantity,
    round(price_at_event, 6) AS price_at_event, true AS has_lineage FROM dirty_clickstream"""
)
def stream_bronze(spark, sf_dir):
    root = scratch_path(spark, "stream")
    append_lines(raw_records(spark, sf_dir), f"{root}/raw")
    land(spark, root)
    rows = spark.read.parquet(f"{root}/landed")
    lineage = F.col("_source_file").isNotNull() & F.col("_source_file_mtime").isNotNull() & F.col("_rescued_data").isNull()
    return presented(
        rows.select(
            "event_id", "event_type", "event_timestamp", "quantity", "price_at_event", lineage.alias("has_lineage")
        )
    )


@workload(
    CHECKED
    + """SELECT event_id, CASE WHEN reasons = '' THEN 'stored' ELSE reasons END AS outcome FROM checked_clickstream"""
)
def stream_silver_exactly_once(spark, sf_dir):
    """Three rounds over one checkpoint: the first week, the rest, and nothing new."""
    root = scratch_path(spark, "stream")
    records = raw_records(spark, sf_dir)
    early = F.col("dt") < F.date_add(F.lit(FIRST_DAY).cast("date"), 7)
    step = conform.Conform(
        f"{root}/silver", f"{root}/quarantine", names=NAMES, as_of=F.col("producer_ingested_at")
    )
    for arrivals in (records.where(early), records.where(~early), None):
        if arrivals is not None:
            append_lines(arrivals, f"{root}/raw")
        land(spark, root)
        schema = spark.read.parquet(f"{root}/landed").schema
        conform.start_conform(
            spark, f"{root}/landed", schema, step, f"{root}/checkpoints/silver"
        ).awaitTermination()
    stored = spark.read.parquet(f"{root}/silver").select("event_id", F.lit("stored").alias("outcome"))
    bad = spark.read.parquet(f"{root}/quarantine").select(
        "event_id", F.array_join("_dq_fail_reasons", ",").alias("outcome")
    )
    return stored.unionByName(bad)


def as_stream(spark, df):
    """``df`` written to files and read back as a stream."""
    path = scratch_path(spark, "stream-input")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def drained(spark, stream):
    out = scratch_path(spark, "stream-output")
    stateful.start_append(stream, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out)


@workload(
    with_views("clickstream", "retried")
    + f"""SELECT DISTINCT cart_id, event_type, {sql_time("event_timestamp", "event_timestamp")},
    CASE WHEN cart_id IS NULL THEN event_id END AS own_id FROM retried"""
)
def stream_dedupe(spark, sf_dir):
    rows = retried_clickstream(spark, sf_dir)
    rows = rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    kept = drained(spark, stateful.first_copies(as_stream(spark, rows)))
    own = F.when(F.col("cart_id").isNull(), F.col("event_id")).alias("own_id")
    return presented(kept.select("cart_id", "event_type", "event_timestamp", own))


@workload(
    with_views("clickstream")
    + """, ordered AS (SELECT *, lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp) AS before
        FROM clickstream),
    numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR event_timestamp > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY session_id ORDER BY event_timestamp) AS n FROM ordered)
    """
    + f"""SELECT session_id, {sql_time("min(event_timestamp)", "started_at")}, {sql_time("max(event_timestamp)", "ended_at")},
    count(*) AS n_events FROM numbered GROUP BY session_id, n"""
)
def session_window_stream(spark, sf_dir):
    """A last event a day later moves the watermark past the end of every real session."""
    events = retail.clickstream(spark, sf_dir).select(
        "session_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp")
    )
    closing = events.agg(
        F.lit("closing").alias("session_id"), (F.max("event_timestamp") + F.make_dt_interval(days=F.lit(1))).alias("event_timestamp")
    )
    sessions = drained(spark, stateful.sessions(as_stream(spark, events.unionByName(closing))))
    return presented(sessions.where("session_id <> 'closing'"))


@workload(
    with_views(*carts.LINKED_VIEWS)
    + f"""SELECT session_id, {sql_time("started_at", "started_at")}, customer_id, cart_id, order_id,
    {sql_time("order_created_at", "order_created_at")} FROM linked_visits WHERE order_id IS NOT NULL"""
)
def session_order_linkage_stream(spark, sf_dir):
    """The linkage from two streams; an event and an order far ahead move both watermarks past the end."""
    # With a customer and a cart: rows that can't join are filtered before they could move a watermark.
    ahead = lambda at: [
        (F.max(at) + F.make_dt_interval(days=F.lit(30))).alias(at), F.lit("ahead").alias("customer_id"), F.lit("ahead").alias("cart_id")
    ]
    events = retail.clickstream(spark, sf_dir).select(
        "session_id", "customer_id", "cart_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp")
    )
    orders = retail.placed_orders(spark, sf_dir).select(
        "order_id", "customer_id", "cart_id", F.col("order_created_at").cast("timestamp").alias("order_created_at")
    )
    events = events.unionByName(events.agg(*ahead("event_timestamp")), allowMissingColumns=True)
    orders = orders.unionByName(orders.agg(*ahead("order_created_at")), allowMissingColumns=True)
    linked = stateful.linked_visits(as_stream(spark, events), as_stream(spark, orders))
    return presented(
        drained(spark, linked).select("session_id", "started_at", "customer_id", "cart_id", "order_id", "order_created_at")
    )


@workload(
    with_views("clickstream")
    + """, ordered AS (SELECT *, lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS before
        FROM clickstream),
    numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR event_timestamp > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS n FROM ordered)
    """
    + f"""SELECT session_id, {sql_time("min(event_timestamp)", "started_at")}, {sql_time("max(event_timestamp)", "ended_at")},
    count(*) AS n_events, true AS some_late FROM numbered GROUP BY session_id, n"""
)
def sessions_with_late_rows(spark, sf_dir):
    """Three rounds of a stream in which a tenth of the events comes a round late; the late ones mend the sessions."""
    root = scratch_path(spark, "late-sessions")
    at = F.col("event_timestamp")
    due = F.when(at < "2024-01-11", 0).when(at < "2024-01-21", 1).otherwise(2)
    events = retail.clickstream(spark, sf_dir).select(
        "event_id", "session_id", at.cast("timestamp").alias("event_timestamp"), F.least(due + (F.col("k") % 10 == 0).cast("int"), F.lit(2)).alias("round")
    )
    step = late.SessionsWithLate(f"{root}/sessions")
    for number in range(3):
        part = events.where(F.col("round") == number).drop("round")
        part.write.mode("append").parquet(f"{root}/raw")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/raw")
        late.start_sessions(stream, step, f"{root}/checkpoint").awaitTermination()
    some_late = step.late(spark).agg(F.count(F.lit(1)) > 0).scalar()
    return presented(step.repaired(spark).withColumn("some_late", some_late))


@workload(
    with_views("clickstream", "dirty_clickstream")
    + f"""SELECT dataset, CASE WHEN dataset = 'landed' THEN n_rows END AS n_rows, {sql_time("date_trunc('milliseconds', latest_at)", "latest_at")}, sla_minutes,
    (epoch(TIMESTAMP '{AS_OF}') - floor(epoch(latest_at))) / 60.0 <= sla_minutes AS within_sla
    FROM (SELECT count(*) AS n_rows, max(event_timestamp) AS latest_at FROM dirty_clickstream),
        (VALUES ('landed', 5.0::DOUBLE), ('conformed', 5.0::DOUBLE * 1440)) AS l(dataset, sla_minutes)
    UNION ALL SELECT 'unheard of', NULL, NULL, 15.0, false"""
)
def stream_freshness(spark, sf_dir):
    """Freshness as the landing query and the one behind it report it while they run, in two rounds."""
    root = scratch_path(spark, "stream")
    records = raw_records(spark, sf_dir)
    early = F.col("dt") < F.date_add(F.lit(FIRST_DAY).cast("date"), 7)
    step = conform.Conform(f"{root}/silver", f"{root}/quarantine", names=NAMES, as_of=F.col("producer_ingested_at"))
    label = root.rsplit("-", 1)[-1]
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        for arrivals in (records.where(early), records.where(~early)):
            append_lines(arrivals, f"{root}/raw")
            first = landing.start_landing(spark, f"{root}/raw", f"{root}/landed", f"{root}/checkpoints/landing", name=f"landed-{label}")
            first.awaitTermination()
            schema = spark.read.parquet(f"{root}/landed").schema
            second = conform.start_conform(
                spark, f"{root}/landed", schema, step, f"{root}/checkpoints/silver", name=f"conformed-{label}"
            )
            second.awaitTermination()
            log.wait_for(first, second)
    finally:
        spark.streams.removeListener(log)
    limits = {f"landed-{label}": 5, f"conformed-{label}": 5 * 1440, f"unheard of-{label}": 15}
    found = log.freshness(spark, limits, AS_OF).withColumn("dataset", F.substring_index("dataset", "-", 1))
    return presented(
        found.select("dataset", F.when(F.col("dataset") == "landed", F.col("n_rows")).alias("n_rows"), F.date_trunc("millisecond", "latest_at").alias("latest_at"), "sla_minutes", "within_sla")
    )
