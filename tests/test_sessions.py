import datetime as dt
import random

from conftest import NOW, rows

from signalloom.operators.sessions import session_summary, sessionize

EVENTS = "event_id INT, session_id STRING, event_timestamp TIMESTAMP_NTZ"


def brute_force(data):
    out, last, number = {}, {}, {}
    for event_id, key, at in sorted(data, key=lambda r: (r[2], r[0])):
        if key not in last or at > last[key] + dt.timedelta(minutes=30):
            number[key] = number.get(key, 0) + 1
        last[key] = at
        out[event_id] = number[key]
    return out


def test_sessions_equal_brute_force_with_a_hot_key(spark):
    rng, data = random.Random(5), []
    for i in range(400):
        key = "hot" if i % 3 == 0 else f"s{rng.randrange(12)}"
        data.append((i, key, NOW + dt.timedelta(minutes=rng.randrange(3 * 24 * 60), seconds=rng.randrange(60))))
    for hot_rows, slice_minutes in ((1000, 15), (50, 15), (50, 600), (0, 1), (0, 45)):
        out = sessionize(spark.createDataFrame(data, EVENTS), hot_rows=hot_rows, slice_minutes=slice_minutes)
        assert {r.event_id: r.session_number for r in out.collect()} == brute_force(data)


def test_a_gap_of_exactly_30_minutes_stays_inside(spark):
    data = [(1, "s", NOW), (2, "s", NOW + dt.timedelta(minutes=30)), (3, "s", NOW + dt.timedelta(minutes=60, microseconds=1))]
    out = session_summary(sessionize(spark.createDataFrame(data, EVENTS)))
    assert rows(out, "session_number", "n_events") == [(1, 2), (2, 1)]


def test_rows_without_key_or_time_are_kept(spark):
    data = [(1, "s", NOW), (2, None, NOW), (3, "s", None)]
    for hot_rows in (10, 0):
        out = sessionize(spark.createDataFrame(data, EVENTS), hot_rows=hot_rows)
        assert rows(out, "event_id", "session_number") == [(1, 1), (2, None), (3, None)]
        assert set(out.columns) == {"event_id", "session_id", "event_timestamp", "session_number"}
