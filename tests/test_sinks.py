import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from signalloom.operators import staging
from signalloom.session import scratch_path
from signalloom.sinks import tables
from signalloom.sinks.audit import audited, counted, read_audit_log
from signalloom.sources.files import Lake

TABLE = "k1 STRING, k2 STRING, v INT"


def frame(spark, *data):
    return spark.createDataFrame(list(data), TABLE)


@pytest.fixture(params=["broadcast", "shuffle"])
def either_join(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(staging.broadcast_if_small, "__defaults__", (None, 0))
        monkeypatch.setitem(tables.upsert.__kwdefaults__, "broadcast_bytes", 0)


def test_upsert_updates_inserts_and_matches_nulls(spark, either_join):
    path = scratch_path(spark, "t")
    tables.upsert(spark, frame(spark, ("a", None, 1), ("b", "x", 1), ("c", None, 1)), path, ["k1", "k2"], n_buckets=3)
    change = frame(spark, ("a", None, 2), ("b", "y", 2), (None, None, 2))
    for _ in range(2):
        tables.upsert(spark, change, path, ["k1", "k2"], n_buckets=3)
    assert rows(tables.read_table(spark, path)) == [
        ("a", None, 2), ("b", "x", 1), ("b", "y", 2), ("c", None, 1), (None, None, 2),
    ]


def test_upsert_of_nothing_changes_nothing(spark):
    path = scratch_path(spark, "t")
    tables.upsert(spark, frame(spark, ("a", "x", 1)), path, ["k1"])
    tables.upsert(spark, frame(spark, ("a", "x", 1)).where("false"), path, ["k1"])
    assert rows(tables.read_table(spark, path)) == [("a", "x", 1)]


def test_upsert_rejects_repeated_keys_unless_told_which_wins(spark):
    path, twice = scratch_path(spark, "t"), frame(spark, ("a", "x", 1), ("a", "x", 2))
    with pytest.raises(ValueError, match="repeats a key"):
        tables.upsert(spark, twice, path, ["k1", "k2"])
    assert not tables.table_exists(spark, path)
    tables.upsert(spark, twice, path, ["k1", "k2"], newest="v")
    assert rows(tables.read_table(spark, path)) == [("a", "x", 2)]


def test_upsert_accepts_new_columns(spark):
    path = scratch_path(spark, "t")
    tables.upsert(spark, frame(spark, ("a", "x", 1), ("b", "x", 1)), path, ["k1"], n_buckets=1)
    tables.upsert(spark, frame(spark, ("a", "x", 2)).withColumn("note", F.lit("n")), path, ["k1"], n_buckets=1)
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(merged, "k1", "v", "note") == [("a", 2, "n"), ("b", 1, None)]


def test_upsert_rewrites_only_the_buckets_it_meets(spark):
    path = scratch_path(spark, "t")
    tables.upsert(spark, spark.range(200), path, ["id"], n_buckets=16)
    before = set(spark.read.parquet(path).inputFiles())
    tables.upsert(spark, spark.range(1), path, ["id"], n_buckets=16)
    after = set(spark.read.parquet(path).inputFiles())
    assert tables.read_table(spark, path).count() == 200
    assert len({f.rsplit("/", 2)[-2] for f in before - after}) == 1


def test_upsert_compacts_crowded_buckets(spark, monkeypatch):
    path = scratch_path(spark, "t")
    for i in range(4):
        tables.upsert(spark, spark.range(i * 10, i * 10 + 10), path, ["id"], n_buckets=2)
    assert len(spark.read.parquet(path).inputFiles()) > 4
    monkeypatch.setattr(tables, "MOST_FILES", 1)
    tables.upsert(spark, spark.range(10), path, ["id"], n_buckets=2)
    assert len(spark.read.parquet(path).inputFiles()) <= 2
    assert tables.read_table(spark, path).count() == 40


@pytest.mark.parametrize("dies_at", range(6))
def test_a_driver_that_dies_in_a_merge_loses_nothing(spark, monkeypatch, dies_at):
    """It dies before the note of the commit, at it, or between the moves of four buckets; then the merge is repeated."""
    path = scratch_path(spark, "t")
    old = spark.range(40).select("id", F.lit(1).alias("v"))
    change = spark.range(20, 60).select("id", F.lit(2).alias("v"), F.lit("n").alias("note"))
    tables.upsert(spark, old, path, ["id"], n_buckets=4)
    before, after = rows(old), [(i, 1, None) for i in range(20)] + [(i, 2, "n") for i in range(20, 60)]
    steps = {"n": 0}

    def counted(fn):
        def step(*args):
            if steps["n"] == dies_at:
                raise KeyboardInterrupt
            steps["n"] += 1
            return fn(*args)

        return step

    with monkeypatch.context() as m:
        m.setattr(tables, "_move_in", counted(tables._move_in))
        m.setattr(tables, "_commit", counted(tables._commit))
        with pytest.raises(KeyboardInterrupt):
            tables.upsert(spark, change, path, ["id"], n_buckets=4)
            raise KeyboardInterrupt
    key = lambda r: r["id"]
    found = [tuple(r) for r in sorted(tables.read_table(spark, path).collect(), key=key)]
    assert found == (sorted(before) if dies_at == 0 else after)
    for _ in range(2):
        tables.upsert(spark, change, path, ["id"], n_buckets=4)
        assert [tuple(r) for r in sorted(tables.read_table(spark, path).collect(), key=key)] == after
    assert spark.read.parquet(path).count() == 60


def test_a_first_merge_that_dies_is_repeated(spark, monkeypatch):
    path = scratch_path(spark, "t")
    with monkeypatch.context() as m:
        m.setattr(tables, "_move_in", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.upsert(spark, spark.range(9), path, ["id"], n_buckets=2)
    tables.upsert(spark, spark.range(5, 12), path, ["id"], n_buckets=2)
    assert tables.read_table(spark, path).count() == 12


def test_insert_new_keeps_what_is_stored(spark, either_join):
    path = scratch_path(spark, "t")
    tables.insert_new(spark, frame(spark, ("a", "d1", 1), ("b", "d1", 1)), path, "k1", "k2")
    batch = frame(spark, ("a", "d2", 9), ("c", "d2", 2))
    for _ in range(2):
        tables.insert_new(spark, batch, path, "k1", "k2")
    assert rows(spark.read.parquet(path), "k1", "k2", "v") == [("a", "d1", 1), ("b", "d1", 1), ("c", "d2", 2)]


def test_insert_new_may_look_in_the_own_partition_only(spark, either_join):
    path = scratch_path(spark, "t")
    tables.insert_new(spark, frame(spark, ("a", "d1", 1), ("n", None, 1)), path, "k1", "k2")
    batch = frame(spark, ("a", "d1", 9), ("a", "d2", 9), ("m", None, 2))
    for _ in range(2):
        tables.insert_new(spark, batch, path, "k1", "k2", copies_share_partition=True)
    assert rows(spark.read.parquet(path), "k1", "k2", "v") == [
        ("a", "d1", 1), ("a", "d2", 9), ("m", None, 2), ("n", None, 1),
    ]


def test_merge_latest_across_batches(spark):
    path = scratch_path(spark, "t")
    batches = [
        frame(spark, ("a", "d1", 1), ("b", "d1", 5), ("z", "d0", 1)),
        frame(spark, ("a", "d1", 2), ("b", "d1", 4)),
    ]
    for batch in (*batches, batches[0]):
        tables.merge_latest(spark, batch, path, ["k1", "k2"], "v", "k2")
    assert rows(spark.read.parquet(path), "k1", "k2", "v") == [("a", "d1", 2), ("b", "d1", 5), ("z", "d0", 1)]


def test_a_snapshot_replaces_rows_and_schema(spark):
    path = scratch_path(spark, "s")
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path)
    tables.write_snapshot(frame(spark, ("a", "x", 1)), path)
    tables.write_snapshot(tables.read_snapshot(spark, path).select("k1", F.lit(2.5).alias("w")), path)
    assert tables.read_snapshot(spark, path).collect() == [("a", 2.5)]


def test_a_failed_snapshot_is_never_read(spark):
    path = scratch_path(spark, "s")
    tables.write_snapshot(frame(spark, ("a", "x", 1)), path)
    broken = frame(spark, ("a", "x", 2)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(PySparkException):
        tables.write_snapshot(broken, path)
    assert rows(tables.read_snapshot(spark, path), "v") == [(1,)]
    tables.write_snapshot(frame(spark, ("a", "x", 3)), path)
    assert rows(tables.read_snapshot(spark, path), "v") == [(3,)]


def test_quarantine_is_skipped_when_empty_and_replaced_on_replay(spark):
    path, bad = scratch_path(spark, "q"), frame(spark, ("a", "x", 1))
    assert not tables.write_quarantine(bad.where("false"), path, 0)
    assert not tables.table_exists(spark, path)
    for _ in range(2):
        assert tables.write_quarantine(bad, path, 1)
    assert tables.write_quarantine(bad, path, 2)
    assert spark.read.parquet(path).count() == 2
    # A batch that is run again and finds nothing wrong leaves nothing of its first run.
    assert not tables.write_quarantine(bad.where("false"), path, 2)
    assert spark.read.parquet(path).count() == 1


def test_csv_export_has_a_header(spark):
    path = scratch_path(spark, "csv")
    tables.export_csv(frame(spark, ("a", "x", 1)), path)
    assert spark.read.csv(path, header=True).collect() == [("a", "x", "1")]


def test_audit_logs_success_and_failure_with_counts(spark):
    lake = Lake(scratch_path(spark, "lake"), env="staging")
    with audited(spark, lake, "good", "gold", "t") as counts:
        df, seen = counted(spark.range(7))
        df.write.format("noop").mode("overwrite").save()
        counts.row_count, counts.quarantined_count = seen.get["n_rows"], 2
    with pytest.raises(RuntimeError):
        with audited(spark, lake, "bad", "silver", "t"):
            raise RuntimeError("no")
    log = read_audit_log(spark, lake)
    assert rows(log, "job_name", "layer", "target_table", "row_count", "quarantined_count", "run_id", "status") == [
        ("bad", "silver", "retail_staging.silver.t", None, 0, "manual", "failed"),
        ("good", "gold", "retail_staging.gold.t", 7, 2, "manual", "success"),
    ]
    assert log.where("finished_at < started_at").isEmpty()


def test_staging_area_is_removed_at_its_end(spark):
    with staging.staging_area(spark, "area"):
        df = staging.staged(spark.range(3), "t")
        path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert df.count() == 3 and tables.table_exists(spark, path)
    assert not tables.table_exists(spark, path)


def test_broadcast_only_within_the_limit(spark):
    df = frame(spark, ("a", "x", 1), ("b", "y", 2))
    assert staging.broadcast_if_small(df, limit_bytes=10) is df
    assert staging.broadcast_if_small(df, limit_bytes=10_000) is not df
    long_text = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert staging.broadcast_if_small(long_text, limit_bytes=9_000) is long_text


def test_upsert_keeps_columns_and_buckets_and_refuses_other_types(spark):
    path = scratch_path(spark, "layout")
    first = spark.createDataFrame([(i, "a") for i in range(20)], "k INT, v STRING")
    tables.upsert(spark, first, path, ["k"], n_buckets=4)
    tables.upsert(spark, spark.createDataFrame([(3, "b", 7)], "k INT, v STRING, extra INT"), path, ["k"], n_buckets=64)
    tables.upsert(spark, spark.createDataFrame([(i, "c") for i in range(20) if i != 3], "k INT, v STRING"), path, ["k"])
    stored = tables.read_table(spark, path)
    assert stored.count() == 20
    assert rows(stored.where("k = 3"), "k", "v", "extra") == [(3, "b", 7)]
    with pytest.raises(ValueError, match="stores k as int"):
        tables.upsert(spark, spark.createDataFrame([(5, "x")], "k LONG, v STRING"), path, ["k"])
    with pytest.raises(ValueError, match="merged by k"):
        tables.upsert(spark, first, path, ["v"])
    assert tables.read_table(spark, path).count() == 20


def test_a_new_table_is_made_in_one_pass(spark, monkeypatch):
    """Its source is neither written beside it first nor shuffled, and what repeats is still found, whatever the hashes."""
    monkeypatch.setattr(tables, "staged", lambda *_: pytest.fail("the source was written twice"))
    monkeypatch.setattr(tables, "_most_of", lambda rows, *by, f=tables._most_of: asked.append(len(by)) or f(rows, *by))
    asked, path = [], scratch_path(spark, "t")
    # Hashes skip nulls: both rows have the same one.
    data = frame(spark, ("a", None, 1), (None, "a", 2), ("b", "x", 3))
    tables.upsert(spark, data, path, ["k1", "k2"], n_buckets=4)
    assert asked == [1, 2] and rows(tables.read_table(spark, path)) == rows(data)
    twice = scratch_path(spark, "t")
    with pytest.raises(ValueError, match="repeats a key"):
        tables.upsert(spark, data.unionByName(frame(spark, (None, "a", 2))), twice, ["k1", "k2"], n_buckets=4)
    assert not tables.table_exists(spark, twice)
    tables.upsert(spark, data.where("v = 9"), twice, ["k1", "k2"])
    assert not tables.table_exists(spark, twice)
