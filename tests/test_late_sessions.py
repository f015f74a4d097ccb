import datetime as dt
import random

from conftest import NOW, rows

from signalloom.operators.sessions import session_summary, sessionize
from signalloom.session import scratch_path
from signalloom.streaming.late import SessionsWithLate, joined_spans, start_sessions

EVENTS = "event_id STRING, session_id STRING, event_timestamp TIMESTAMP"


def at(minutes):
    return NOW + dt.timedelta(minutes=minutes)


def run(spark, rounds, **options):
    root = scratch_path(spark, "late")
    step = SessionsWithLate(f"{root}/sessions", **options)
    for data in rounds:
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/raw")
        start_sessions(spark.readStream.schema(EVENTS).parquet(f"{root}/raw"), step, f"{root}/checkpoint").awaitTermination()
    return step


def sessions_of(spark, data):
    df = spark.createDataFrame([d for d in data if d[1] and d[2]], EVENTS)
    return rows(session_summary(sessionize(df)), "session_id", "started_at", "ended_at", "n_events")


def test_no_row_is_lost_over_three_batches(spark):
    rng = random.Random(7)
    data = [(f"e{i}", rng.choice(["a", "b", "c", None]), None if rng.random() < 0.02 else at(rng.randrange(0, 3000))) for i in range(400)]
    arrival = [min(2, (0 if d[2] is None else (d[2] - NOW) // dt.timedelta(minutes=1000)) + rng.choice([0, 0, 0, 1, 2])) for d in data]
    rounds = [[d for d, a in zip(data, arrival) if a == n] for n in range(3)]
    step = run(spark, rounds)
    late = [tuple(r) for r in step.late(spark).collect()]
    held = sum(r.n_events for r in step.closed(spark).unionByName(step.open(spark)).collect())
    assert held + len(late) == len(data)
    assert any(d[1] and d[2] for d in late)
    assert rows(step.repaired(spark), "session_id", "started_at", "ended_at", "n_events") == sessions_of(spark, data)
    # In time is what a watermark would have kept.
    newest = max(d[2] for d in rounds[0] if d[2])
    assert {d[0] for d in rounds[1] if d[1] and d[2] and d[2] < newest - dt.timedelta(hours=2)} <= {d[0] for d in late}


def test_a_late_row_bridges_two_closed_sessions(spark):
    step = run(spark, [[("1", "a", at(0)), ("2", "a", at(50)), ("9", "z", at(1000))], [("3", "a", at(25)), ("4", "b", at(5)), ("10", "z", at(1010))]])
    assert rows(step.closed(spark), "started_at", "n_events") == [(at(0), 1), (at(50), 1)]
    assert rows(step.late(spark), "event_id") == [("3",), ("4",)]
    assert rows(step.repaired(spark), "session_id", "started_at", "n_events") == [("a", at(0), 3), ("b", at(5), 1), ("z", at(1000), 2)]


def test_a_replayed_batch_changes_nothing(spark):
    rounds = [[("1", "a", at(0))], [("2", "a", at(20)), ("3", "b", at(900))], [("4", "a", at(10)), ("5", "b", at(905))]]
    step = run(spark, rounds)
    before = rows(step.repaired(spark)), rows(step.late(spark))
    for n, data in enumerate(rounds):
        step(spark.createDataFrame(data, EVENTS), n)
    assert (rows(step.repaired(spark)), rows(step.late(spark))) == before


def test_spans_join_at_the_gap_and_not_beyond(spark):
    data = [("a", at(0), at(5), 2), ("a", at(35), at(36), 1), ("a", at(67), at(67), 1), ("a", at(1), at(200), 1), ("b", at(0), at(0), 1)]
    found = joined_spans(spark.createDataFrame(data, "k STRING, started_at TIMESTAMP, ended_at TIMESTAMP, n_events LONG"), "k", 30)
    assert rows(found, "k", "started_at", "ended_at", "n_events") == [("a", at(0), at(200), 5), ("b", at(0), at(0), 1)]
