import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from signalloom.session import scratch_path
from signalloom.streaming import conform, landing, stateful

BASE = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)


def record(event_id, **changes):
    base = {
        "event_id": event_id,
        "event_type": "add_to_cart",
        "event_timestamp": BASE.isoformat(),
        "session_id": "s1",
        "customer_id": " cust1 ",
        "cart_id": f"cart-{event_id}",
        "device_type": "Mobile",
        "_ingested_at": BASE.isoformat(),
        "sku": "SKU1",
        "quantity": 1,
        "price_at_event": 9.5,
    }
    return json.dumps({**base, **changes})


def add(spark, root, *lines):
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("append").text(f"{root}/raw")


def run(spark, root, **options):
    landing.start_landing(spark, f"{root}/raw", f"{root}/landed", f"{root}/cp/landing").awaitTermination()
    schema = spark.read.parquet(f"{root}/landed").schema
    step = conform.Conform(f"{root}/silver", f"{root}/quarantine", **options)
    conform.start_conform(spark, f"{root}/landed", schema, step, f"{root}/cp/silver").awaitTermination()


def stored(spark, root):
    return [r[0] for r in rows(spark.read.parquet(f"{root}/silver"), "event_id")]


def test_three_rounds_on_one_checkpoint(spark):
    root, seen = scratch_path(spark, "stream"), []
    count = lambda *facts: seen.append(facts)
    add(spark, root, record("e1"), record("e2"), record("e3"), record("bad1", session_id=None))
    run(spark, root, on_batch=count)
    assert stored(spark, root) == ["e1", "e2", "e3"]
    assert rows(spark.read.parquet(f"{root}/quarantine"), "event_id", F.array_join("_dq_fail_reasons", ",")) == [
        ("bad1", "missing_session_id")
    ]
    add(spark, root, record("e4"), record("e5"))
    run(spark, root, on_batch=count)
    assert stored(spark, root) == ["e1", "e2", "e3", "e4", "e5"]
    run(spark, root, on_batch=count)
    assert stored(spark, root) == ["e1", "e2", "e3", "e4", "e5"]
    assert seen == [(0, 3, 1), (1, 2, 0)]
    row = spark.read.parquet(f"{root}/silver").first()
    assert (row.customer_id, row.device_type, row.event_date) == ("CUST1", "mobile", BASE.date())
    assert row._source_file and row._silver_processed_at and row._dq_warnings == []


def test_a_replayed_batch_changes_nothing(spark):
    root = scratch_path(spark, "stream")
    add(spark, root, record("e1"), record("bad1", price_at_event=-1.0))
    landing.start_landing(spark, f"{root}/raw", f"{root}/landed", f"{root}/cp/landing").awaitTermination()
    batch = spark.read.parquet(f"{root}/landed")
    step = conform.Conform(f"{root}/silver", f"{root}/quarantine")
    for _ in range(2):
        step(batch, 0)
    assert stored(spark, root) == ["e1"]
    assert spark.read.parquet(f"{root}/quarantine").count() == 1


def test_bad_lines_never_stop_the_stream(spark):
    root = scratch_path(spark, "stream")
    old = (BASE - dt.timedelta(days=3)).isoformat()
    add(
        spark, root, record("good"), "no json", record("when", event_timestamp="yesterday"), record("old", event_timestamp=old),
        record("many", quantity="many", coupon="X"),
    )
    run(spark, root)
    landed = spark.read.parquet(f"{root}/landed")
    rescued = {r.event_id: r._rescued_data for r in landed.collect()}
    assert rescued == {
        "good": None, None: {"_line": "no json"}, "when": None, "old": None, "many": {"quantity": "many", "coupon": "X"},
    }
    assert stored(spark, root) == ["good", "many"]
    reasons = rows(spark.read.parquet(f"{root}/quarantine"), "event_id", F.array_join("_dq_fail_reasons", ","))
    assert reasons == [
        ("old", "invalid_event_timestamp"),
        ("when", "invalid_event_timestamp"),
        (None, "missing_session_id,invalid_event_timestamp"),
    ]


def test_retries_in_a_later_batch(spark):
    later = (BASE + dt.timedelta(seconds=30)).isoformat()
    for across, expected in ((False, ["e1", "e2"]), (True, ["e2"])):
        root = scratch_path(spark, "stream")
        add(spark, root, record("e1", cart_id="c"))
        run(spark, root, across_batches=across)
        add(spark, root, record("e2", cart_id="c", _ingested_at=later))
        run(spark, root, across_batches=across)
        assert stored(spark, root) == expected


def test_an_interval_keeps_the_stream_running(spark):
    root = scratch_path(spark, "stream")
    add(spark, root, record("e1"))
    query = landing.start_landing(
        spark, f"{root}/raw", f"{root}/landed", f"{root}/cp", every="100 milliseconds", max_files=1
    )
    try:
        query.processAllAvailable()
        add(spark, root, record("e2"))
        query.processAllAvailable()
        assert query.isActive
        assert rows(spark.read.parquet(f"{root}/landed"), "event_id") == [("e1",), ("e2",)]
    finally:
        query.stop()


def test_first_copies_survive_a_restart(spark):
    root = scratch_path(spark, "stream")
    schema = "event_id STRING, cart_id STRING, event_type STRING, event_timestamp TIMESTAMP"
    for ids in (["a", "b"], ["c"], []):
        if ids:
            spark.createDataFrame([(i, "c1", "add_to_cart", BASE) for i in ids], schema).write.mode("append").parquet(f"{root}/in")
        stream = stateful.first_copies(spark.readStream.schema(schema).parquet(f"{root}/in"))
        stateful.start_append(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 1


def test_a_session_is_emitted_once_the_watermark_passes_it(spark):
    root, schema = scratch_path(spark, "stream"), "session_id STRING, event_timestamp TIMESTAMP"
    times = [0, 30, 61]

    def feed(*data):
        spark.createDataFrame(list(data), schema).write.mode("append").parquet(f"{root}/in")
        stream = stateful.sessions(spark.readStream.schema(schema).parquet(f"{root}/in"))
        stateful.start_append(stream, f"{root}/out", f"{root}/cp").awaitTermination()
        return spark.read.schema("session_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP, n_events LONG").parquet(f"{root}/out")

    assert feed(*[("s", BASE + dt.timedelta(minutes=m)) for m in times]).count() == 0
    out = feed(("late", BASE + dt.timedelta(days=1)))
    assert rows(out.where("session_id = 's'"), "n_events") == [(1,), (2,)]


def test_first_copies_keep_distinct_rows_without_a_cart(spark):
    root = scratch_path(spark, "stream")
    schema = "event_id STRING, cart_id STRING, event_type STRING, event_timestamp TIMESTAMP"
    early = BASE - dt.timedelta(hours=5)
    batches = [
        [("a", None, "page_view", BASE), ("b", None, "page_view", BASE), ("c", "c1", "add_to_cart", BASE)],
        [("a", None, "page_view", BASE), ("d", "c1", "add_to_cart", early), ("e", "c1", "add_to_cart", BASE)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{root}/in")
        stream = stateful.first_copies(spark.readStream.schema(schema).parquet(f"{root}/in"))
        stateful.start_append(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/out"), "event_id") == [("a",), ("b",), ("c",), ("d",)]


def test_rows_without_an_event_id_are_put_aside(spark):
    root = scratch_path(spark, "stream")
    add(spark, root, record("e1"), record(None, cart_id=None, event_type="page_view"), record(None))
    run(spark, root, require_event_id=True)
    assert stored(spark, root) == ["e1"]
    reasons = rows(spark.read.parquet(f"{root}/quarantine"), F.array_join("_dq_fail_reasons", ","))
    assert reasons == [("missing_event_id",)] * 2
