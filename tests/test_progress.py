import datetime as dt
import uuid

from conftest import NOW, ago, rows
from pyspark.sql import functions as F

from signalloom.session import scratch_path
from signalloom.streaming import progress

EVENTS = "event_id STRING, event_timestamp TIMESTAMP"


def drain(spark, root, name, log):
    stream = progress.with_freshness(spark.readStream.schema(EVENTS).parquet(f"{root}/raw"))
    query = (
        stream.writeStream.queryName(name).format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start(f"{root}/out")
    )
    query.awaitTermination()
    assert log.wait_for(query)


def test_freshness_comes_from_running_queries(spark):
    root, name = scratch_path(spark, "progress"), f"events-{uuid.uuid4().hex}"
    log = progress.ProgressLog(most=50)
    spark.streams.addListener(log)
    try:
        for batch in ([("1", ago(minutes=40)), ("2", ago(minutes=20))], [("3", ago(minutes=3)), ("4", None)], [("5", ago(days=9))]):
            spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/raw")
            drain(spark, root, name, log)
    finally:
        spark.streams.removeListener(log)
    triggers = progress.lag_per_trigger(log.triggers(spark)).where("n_rows > 0")
    assert rows(triggers.select("n_rows", "latest_at")) == [(1, ago(days=9)), (2, ago(minutes=20)), (2, ago(minutes=3))]
    late = triggers.where(F.col("latest_at") == ago(minutes=3)).first()
    ended = late.triggered_at + dt.timedelta(seconds=late.seconds)
    assert abs(late.lag_seconds - (ended - ago(minutes=3)).total_seconds()) < 0.01
    found = log.freshness(spark, {name: 5, "silent": 5}, NOW)
    assert rows(found, "dataset", "n_rows", "latest_at", "lag_minutes", "within_sla") == [
        (name, 5, ago(minutes=3), 3.0, True), ("silent", 0, None, None, False),
    ]
    assert not log.freshness(spark, {name: 2.5}, NOW).first()["within_sla"]

    path = scratch_path(spark, "triggers")
    noted = log.triggers(spark).count()
    assert log.flush(spark, path) == noted and log.flush(spark, path) == 0
    assert spark.read.parquet(path).count() == noted and log.triggers(spark).isEmpty()


def test_unnamed_queries_are_not_noted(spark):
    root, log = scratch_path(spark, "progress"), progress.ProgressLog()
    spark.createDataFrame([("1", NOW)], EVENTS).write.parquet(f"{root}/raw")
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema(EVENTS).parquet(f"{root}/raw")
        query = stream.writeStream.format("noop").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        assert log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    assert log.triggers(spark).isEmpty()
