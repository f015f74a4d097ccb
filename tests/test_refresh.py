import datetime as dt

import pytest
from conftest import NOW, ago, rows
from test_sources import write_lines

from pyspark.sql import functions as F

from signalloom.plans import refresh as plan
from signalloom.plans.refresh import CONFORMINGS, conform_table, content_id, ingest_extract, refresh
from signalloom.session import scratch_path
from signalloom.sinks import tables as sinks
from signalloom.sinks.audit import read_audit_log
from signalloom.sinks.tables import read_snapshot, read_table, write_partitions
from signalloom.sources.files import EXTRACTS as EXTRACT_SPECS
from signalloom.sources.files import RUN_ID_SETTING, Lake

PROMISED = NOW.date()
EXTRACTS = {
    "customers": ["customer_id,first_seen_date,is_returning,home_tz_offset", " cust1 ,2024-01-01,true,0"],
    "products": ["sku,name,category,price", "sku1,Lamp,HOME,10.0", "sku2,Bad,HOME,-1"],
    "inventory": ["sku,warehouse_id,on_hand_qty,backorder_flag,snapshot_date", "SKU1,w1,,true,2024-01-01"],
    "orders": [
        "order_id,customer_id,cart_id,order_created_at,channel,currency,fx_rate_to_usd,order_total_usd,status,promised_delivery_date",
        f"o1,cust1,,2024-03-01T00:00:00Z,web,USD,1.0,75.0,in_transit,{PROMISED}",
        "o2,cust1,,2024-03-01T00:00:00Z,web,USD,1.0,-5.0,in_transit,",
    ],
    "order_items": ["order_id,sku,qty,unit_price", "o1,SKU1,1,75.0"],
    "shipments": [
        "order_id,carrier,shipped_at,delivered_at,status,carrier_avg_transit_days,carrier_historical_late_rate_pct,promised_delivery_date",
        f"o1,x,2024-03-02T00:00:00Z,,in_transit,3,10.0,{PROMISED}",
        "o0,x,2024-03-01T00:00:00Z,2024-03-05T00:00:00Z,delivered,3,10.0,2024-03-05",
    ],
}


def test_extracts_become_signals_and_a_rerun_changes_nothing(spark):
    lake, folder = Lake(scratch_path(spark, "lake")), scratch_path(spark, "extracts")
    for name, lines in EXTRACTS.items():
        write_lines(spark, f"{folder}/{name}.csv", *lines)
    events = spark.createDataFrame(
        [("e1", "c1", "CUST1", "add_to_cart", ago(minutes=45), ago(days=0).date(), 40.0, 1)],
        """event_id STRING, cart_id STRING, customer_id STRING, event_type STRING, event_timestamp TIMESTAMP_NTZ,
        event_date DATE, price_at_event DOUBLE, quantity INT""",
    )
    write_partitions(events, lake.path("silver", "clickstream_events"), ["event_date"])
    for _ in range(2):
        refresh(spark, lake, folder, NOW, n_buckets=2)
        assert rows(read_table(spark, lake.path("silver", "orders")), "order_id", "customer_id") == [("o1", "CUST1")]
        assert spark.read.parquet(lake.path("silver", "orders_quarantine")).count() == 1
        assert read_table(spark, lake.path("silver", "inventory")).count() == 1
        risk = read_snapshot(spark, lake.path("gold", "fulfillment_risk_signal"))
        assert rows(risk, "order_id", "fulfillment_risk_score") == [("o1", 82.0)]
        kpis = read_table(spark, lake.path("gold", "exec_summary_daily"))
        assert rows(kpis) == [(NOW.date(), 40.0, 75.0, 1.0, None)]
    log = read_audit_log(spark, lake)
    assert log.where("status = 'success'").count() == log.count() == 2 * 15
    orders = log.where("job_name = 'conform_orders'").first()
    assert (orders.row_count, orders.quarantined_count) == (1, 1)


def test_only_new_rows_are_conformed_under_the_full_contract(spark):
    lake = Lake(scratch_path(spark, "lake"))
    extracts = {e.name: e for e in EXTRACT_SPECS}
    tables = {c.name: c for c in CONFORMINGS}
    folder = scratch_path(spark, "extracts")
    write_lines(spark, f"{folder}/customers.csv", *EXTRACTS["customers"])
    fresh, head = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), EXTRACTS["orders"][0]

    def line(order, customer, at):
        return f"{order},{customer},,{at},web,USD,1.0,75.0,in_transit,{PROMISED}"

    runs = {
        "r1": [line("o1", "cust1", fresh), line("o2", "nobody", fresh), line("o3", "", fresh)],
        "r2": [line("o4", "cust1", fresh), line("o5", "cust1", "2020-01-01T00:00:00Z")],
    }
    seen = {}
    try:
        for run, lines in runs.items():
            spark.conf.set(RUN_ID_SETTING, run)
            orders = scratch_path(spark, "extracts")
            write_lines(spark, f"{orders}/orders.csv", head, *lines)
            ingest_extract(spark, lake, folder, extracts["customers"], 2)
            ingest_extract(spark, lake, orders, extracts["orders"], 2)
            for name in ("customers", "orders"):
                conform_table(spark, lake, tables[name], 2, only_run=run, full_contract=True)
            log = read_audit_log(spark, lake).where(f"job_name = 'conform_orders' AND run_id = '{run}'").first()
            seen[run] = (log.row_count, log.quarantined_count)
    finally:
        spark.conf.unset(RUN_ID_SETTING)
    assert seen == {"r1": (2, 1), "r2": (1, 1)}
    silver = read_table(spark, lake.path("silver", "orders"))
    assert sorted(r.order_id for r in silver.collect()) == ["o1", "o3", "o4"]
    assert not [c for c in silver.columns if c.startswith("_orphan")]
    bad = spark.read.parquet(lake.path("silver", "orders_quarantine"))
    reasons = rows(bad, "order_id", F.array_join("_dq_fail_reasons", ","))
    assert reasons == [("o2", "orphan_customer_id"), ("o5", "invalid_order_created_at")]


def test_references_are_checked_in_turn(spark):
    """An order whose cart no session holds goes aside, and with it its lines and its shipment."""
    lake, folder = Lake(scratch_path(spark, "lake")), scratch_path(spark, "extracts")
    head = EXTRACTS["orders"][0]
    order = lambda o, customer, cart: f"{o},{customer},{cart},2024-03-01T00:00:00Z,web,USD,1.0,75.0,in_transit,{PROMISED}"
    extracts = {
        "customers": EXTRACTS["customers"],
        "orders": [head, order("o1", "cust1", "c1"), order("o2", "cust1", "lost"), order("o3", "who", "lost"), order("o4", "cust1", "")],
        "order_items": ["order_id,sku,qty,unit_price", "o1,S,1,1.0", "o2,S,1,1.0", "o4,S,1,1.0", "o9,S,1,1.0"],
    }
    for name, lines in extracts.items():
        write_lines(spark, f"{folder}/{name}.csv", *lines)
    specs, tables = {e.name: e for e in EXTRACT_SPECS}, {c.name: c for c in CONFORMINGS}
    assert [c.name for c in CONFORMINGS].index("orders") < [c.name for c in CONFORMINGS].index("order_items")
    events = spark.createDataFrame([("e1", "c1"), ("e2", "c1"), ("e3", None)], "event_id STRING, cart_id STRING")
    write_partitions(events, lake.path("silver", "clickstream_events"), [])
    for name in extracts:
        ingest_extract(spark, lake, folder, specs[name], 2)
    for name in extracts:
        conform_table(spark, lake, tables[name], 2, references=True)
    stored = lambda name: [r.order_id for r in read_table(spark, lake.path("silver", name)).orderBy("order_id").collect()]
    assert stored("orders") == ["o1", "o4"] and stored("order_items") == ["o1", "o4"]
    reasons = lambda name: rows(spark.read.parquet(lake.path("silver", f"{name}_quarantine")), "order_id", F.array_join("_dq_fail_reasons", ","))
    assert reasons("orders") == [("o2", "orphan_cart_id"), ("o3", "orphan_customer_id,orphan_cart_id")]
    assert reasons("order_items") == [("o2", "orphan_order_id"), ("o9", "orphan_order_id")]


def test_only_new_needs_a_run_id(spark):
    with pytest.raises(ValueError, match=RUN_ID_SETTING):
        refresh(spark, Lake(scratch_path(spark, "lake")), scratch_path(spark, "extracts"), NOW, only_new=True)


def test_runs_without_an_id_keep_each_others_quarantine(spark):
    one, other = (spark.createDataFrame([(i, "x", str(i))], "k INT, v STRING, _batch STRING") for i in (1, 2))
    again = one.withColumn("_batch", F.lit("another run"))
    assert content_id(one) == content_id(again) != content_id(other)


def test_a_new_conformed_table_is_written_with_its_checks(spark, monkeypatch):
    """Once, with what goes aside; a commit that dies is finished, and a second run merges into it as before."""
    lake, folder = Lake(scratch_path(spark, "lake")), scratch_path(spark, "extracts")
    spec, table = ({x.name: x for x in xs}["order_items"] for xs in (EXTRACT_SPECS, CONFORMINGS))
    write_lines(spark, f"{folder}/order_items.csv", "order_id,sku,qty,unit_price", "o1,S,1,1.0", "o1,T,0,1.0", "o2,S,2,1.0", ",,-1,1.0", ",,-1,1.0")
    with pytest.raises(ValueError, match="repeats a key"):
        ingest_extract(spark, lake, folder, spec, 2)
    folder = scratch_path(spark, "extracts")
    write_lines(spark, f"{folder}/order_items.csv", "order_id,sku,qty,unit_price", "o1,S,1,1.0", "o1,T,0,1.0", "o2,S,2,1.0", ",,-1,1.0")
    ingest_extract(spark, lake, folder, spec, 2)
    path = lake.path("silver", "order_items")
    with monkeypatch.context() as m:
        m.setattr(plan, "upsert", lambda *_, **__: pytest.fail("the clean rows were written twice"))
        m.setattr(sinks, "_move_in", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError, match="died"):
            conform_table(spark, lake, table, 2)
    expected = [("o1", "S", 1), ("o2", "S", 2)]
    for again in range(3):
        stored = read_table(spark, path)
        assert rows(stored, "order_id", "sku", "qty") == expected and "_dq_fail_reasons" not in stored.columns
        bad = spark.read.parquet(lake.path("silver", "order_items_quarantine"))
        assert rows(bad, "order_id", "sku") == [("o1", "T"), (None, None)] and "key_bucket_no" not in bad.columns
        conform_table(spark, lake, table, 2)
    log = rows(spark.read.parquet(lake.path("gold", "pipeline_audit_log")).where("job_name = 'conform_order_items' AND status = 'success'"), "row_count", "quarantined_count")
    assert log == [(2, 2)] * 3
    fresh = Lake(scratch_path(spark, "lake"))
    ingest_extract(spark, fresh, folder, spec, 2)
    conform_table(spark, fresh, table, 2)
    assert rows(read_table(spark, fresh.path("silver", "order_items")), "order_id", "sku", "qty") == expected
    fs, where = sinks.hadoop_path(spark, fresh.path("silver", "order_items"))
    assert not [x for x in fs.listStatus(where) if x.getPath().getName().startswith(("_checked", "_merge"))]
