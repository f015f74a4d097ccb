import math

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalloom.operators import percentiles
from signalloom.operators.percentiles import percentile

numbers = st.lists(st.sampled_from([0.0, 1.0, 1.0, 1.0, 2.5, 7.0, 7.25, 100.0]) | st.floats(-1e3, 1e3), min_size=1, max_size=30)


def discrete(data, p):
    return sorted(data)[max(math.ceil(len(data) * p), 1) - 1]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers, st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_exact_percentiles(spark, data, p):
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "v DOUBLE")
    assert percentile(df, "v", p, method="discrete").first().q == discrete(data, p)
    assert percentile(df, "v", p, method="continuous").first().q == pytest.approx(np.quantile(data, p), abs=1e-9)


def test_exact_beyond_the_sketch_and_with_a_hot_value(spark):
    """A coarse sketch still brackets the exact rank; a third of the rows share one value."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(500.0)).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("v")
    )
    data = [500.0 if i % 3 == 0 else float(i * 7919 % 10007) for i in range(n)]
    for p in (0.25, 0.5, 0.9):
        assert percentile(df, "v", p, method="discrete", accuracy=100).first().q == discrete(data, p)
        exact = percentile(df, "v", p, method="continuous", accuracy=100).first().q
        assert exact == pytest.approx(np.quantile(data, p))


def test_groups_and_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("c", None), (None, 5.0)], "g STRING, v DOUBLE")
    assert rows(percentile(df, "v", 0.5, by=["g"], method="continuous", name="m"), "g", "m") == [("a", 2.0), ("b", 10.0), (None, 5.0)]
    assert rows(percentile(df, "v", 0.5, by=["g"], method="discrete"), "g", "q") == [("a", 1.0), ("b", 10.0), (None, 5.0)]


@pytest.mark.parametrize("method", ["approx", "discrete", "continuous"])
def test_nothing_gives_null(spark, method):
    df = spark.createDataFrame([(None,)], "v DOUBLE")
    assert percentile(df, "v", 0.9, method=method).collect() == [(None,)]


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        percentile(spark.range(1), "id", 0.5, method="guess")


@pytest.mark.parametrize("bounds, method", [((5, 4), "continuous"), ((40, 64), "discrete")])
def test_brackets_beyond_the_bound_are_narrowed(spark, monkeypatch, bounds, method):
    """A sketch so coarse that the bracket holds everything; heavy ties, a heavy tail and groups of unlike size."""
    monkeypatch.setattr(percentiles, "BRACKET_VALUES", bounds[0])
    monkeypatch.setattr(percentiles, "PIECES", bounds[1])
    rng = np.random.default_rng(5)
    groups = {"even": rng.uniform(0, 1, 700), "tail": np.exp(rng.normal(0, 6, 400)), "few": np.array([1.0, 2.0]), None: rng.integers(0, 30, 500) * 1.0}
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(4)
    exact = discrete if method == "discrete" else lambda x, p: float(np.quantile(x, p))
    for p in (0.37, 1.0):
        found = {r.g: r.q for r in percentile(df, "v", p, by=["g"], method=method, accuracy=5).collect()}
        assert found == {g: pytest.approx(exact(list(x), p), rel=1e-12) for g, x in groups.items()}
    whole = percentile(df.select("v"), "v", 0.5, method=method, accuracy=5).first().q
    assert whole == pytest.approx(exact([v for _, v in data], 0.5), rel=1e-12)


def test_narrowing_splits_over_tasks_and_takes_any_ordered_type(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "BRACKET_VALUES", 10)
    seen = []
    staged = percentiles.staged
    monkeypatch.setattr(percentiles, "staged", lambda df, label: seen.append(staged(df, label)) or seen[-1])
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.range(5000, numPartitions=4).select((start + F.make_dt_interval(secs=F.col("id") * 37 % 5000)).alias("v"))
    found = percentile(df, "v", 0.9, method="discrete", accuracy=3).first().q
    assert found == df.orderBy("v").collect()[4499].v
    # Each round leaves about a piece in 64 of the one before.
    sizes = [x.where("_v IS NOT NULL").count() for x in seen]
    assert sizes[0] > 1000 and sizes[-1] <= 10 and len(sizes) <= 4
