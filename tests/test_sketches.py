import bisect
import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from signalloom.operators import sketches
from signalloom.session import scratch_path
from signalloom.sinks.tables import read_table

DAY = dt.date(2024, 3, 4)  # a Monday


def values(n=30_000, seed=1):
    rng = random.Random(seed)
    days = [DAY + dt.timedelta(days=i) for i in range(21)]
    # A hot day, a day without rows, ties, negative values and nulls.
    data = [(rng.choices(days, [50 if i == 3 else 0 if i == 9 else 1 for i in range(21)])[0], rng.choice([rng.gauss(0, 1000), 7.0, None])) for _ in range(n)]
    return data + [(days[20], -5.5)]


def off_by(sorted_values, answer, p):
    below, upto = bisect.bisect_left(sorted_values, answer), bisect.bisect_right(sorted_values, answer)
    wanted = p * len(sorted_values)
    return max(below - wanted, wanted - upto, 0) / len(sorted_values)


def test_weeks_and_windows_from_daily_sketches_stay_in_bound(spark):
    data = values()
    df = spark.createDataFrame(data, "metric_date DATE, v DOUBLE").repartition(6)
    daily = sketches.sketched(df, "v", ["metric_date"])
    ps = {"a": 0.01, "b": 0.5, "c": 0.9, "top": 1.0, "low": 0.0}
    bound = sketches.rank_error()
    for r in sketches.with_quantiles(sketches.per_week(daily), ps).collect():
        held = sorted(v for d, v in data if v is not None and r.week_start <= d < r.week_start + dt.timedelta(days=7))
        assert (r.n_values, r.least, r.most) == (len(held), held[0], held[-1])
        assert (r.low, r.top) == (held[0], held[-1])
        assert all(off_by(held, r[c], p) <= bound + 1 / len(held) for c, p in ps.items())
        assert r.b in held
    first, last = DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=20)
    for r in sketches.with_quantiles(sketches.trailing(daily, 3, first, last), ps).collect():
        held = sorted(v for d, v in data if v is not None and r.metric_date - dt.timedelta(days=2) <= d <= r.metric_date)
        assert r.n_values == len(held) and first <= r.metric_date <= last
        assert off_by(held, r.c, 0.9) <= bound + 1 / len(held)


def test_a_median_of_merged_days_is_no_average_of_medians(spark):
    data = [(DAY, float(v)) for v in range(100)] + [(DAY + dt.timedelta(days=1), 1_000_000.0)]
    daily = sketches.sketched(spark.createDataFrame(data, "metric_date DATE, v DOUBLE"), "v", ["metric_date"])
    weekly = sketches.with_quantiles(sketches.per_week(daily), {"median": 0.5})
    assert 49 <= weekly.first()["median"] <= 51


def test_days_recorded_again_replace_their_sketch(spark):
    path = scratch_path(spark, "sketches")
    df = spark.createDataFrame([(DAY, "x", 1.0), (DAY, "y", 5.0), (DAY + dt.timedelta(days=1), "x", 3.0)], "metric_date DATE, g STRING, v DOUBLE")
    by = ["metric_date", "g"]
    for part in (df, df.where(F.col("v") == 5.0).withColumn("v", F.lit(6.0)), df.where(F.col("v") == 3.0)):
        sketches.record_days(spark, sketches.sketched(part, "v", by), path, by=["g"])
    found = sketches.with_quantiles(sketches.per_week(read_table(spark, path), by=["g"]), {"q": 1.0})
    assert rows(found, "g", "n_values", "q") == [("x", 2, 3.0), ("y", 1, 6.0)]


def test_nothing_gives_nothing(spark):
    df = spark.createDataFrame([(DAY, None)], "metric_date DATE, v DOUBLE")
    daily = sketches.sketched(df, "v", ["metric_date"])
    assert daily.isEmpty() and sketches.per_week(daily).isEmpty()
