from conftest import NOW, plan_of, rows
from pyspark.sql import functions as F

from signalloom.operators import layout
from signalloom.session import scratch_path


def stored(spark):
    """Four days of events in many small files; one cart holds a third of all rows."""
    path = scratch_path(spark, "events")
    df = spark.range(1200).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 100)).alias("cart_id"),
        (F.lit(str(NOW)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_timestamp"),
        F.date_add(F.lit(NOW.date()), (F.col("id") % 4).cast("int")).alias("event_date"),
    )
    df.repartition(6).write.partitionBy("event_date").parquet(path)
    return path


def test_compaction_keeps_rows_and_drops_files(spark):
    source, path = stored(spark), scratch_path(spark, "compact")
    layout.compact(spark.read.parquet(source), path)
    before, after = spark.read.parquet(source), spark.read.parquet(path)
    assert rows(after) == rows(before)
    assert len(after.inputFiles()) < len(before.inputFiles())


def test_clustering_narrows_files_and_splits_a_hot_value(spark):
    source, path = stored(spark), scratch_path(spark, "clustered")
    layout.cluster(spark.read.parquet(source), path, "cart_id", n_files=16)
    after = spark.read.parquet(path)
    assert rows(after) == rows(spark.read.parquet(source))
    file = F.input_file_name()
    assert after.where("cart_id = 'hot'").select(file).distinct().count() > 4
    assert after.where("cart_id = 'c1'").select(file).distinct().count() <= 4


def test_a_lookup_prunes_days_and_pushes_the_value(spark):
    df = spark.read.parquet(stored(spark))
    value, day = layout.sample_lookup(df, "cart_id")
    assert (value, day) == ("c0", str(NOW.date()))
    found = layout.point_lookup(df, "cart_id", value, day)
    assert found.count() == df.where(F.col("cart_id") == value).count()
    plan = plan_of(found)
    assert "EqualTo(cart_id,c0)" in plan and "PartitionFilters: [isnotnull(event_date" in plan


def test_comparison_reports_every_layout(spark):
    source, path = stored(spark), scratch_path(spark, "clustered")
    layout.cluster_table(spark, source, path, "cart_id")
    out = layout.compare_layouts(spark, {"plain": source, "clustered": path}, n_runs=2).collect()
    assert [r.layout for r in out] == ["plain", "clustered"]
    assert all(0 < r.min_seconds <= r.avg_seconds for r in out)
    assert out[1].num_files < out[0].num_files


def test_scans_report_what_they_read(spark):
    source, path = stored(spark), scratch_path(spark, "clustered")
    layout.cluster(spark.read.parquet(source), path, "cart_id", n_files=40)
    plain, clustered = spark.read.parquet(source), spark.read.parquet(path)
    whole = layout.scan_metrics(plain)
    assert (whole.rows, whole.files) == (1200, len(plain.inputFiles())) and whole.bytes > 0
    one_day = layout.scan_metrics(plain.where(F.col("event_date") == NOW.date()))
    assert one_day.rows == 300 and one_day.files < whole.files
    value, day = layout.sample_lookup(plain, "cart_id")
    costs = {r.layout: r for r in layout.lookup_costs({"plain": plain, "clustered": clustered}, "cart_id", value, day).collect()}
    assert 0 < costs["clustered"].rows_scanned < costs["plain"].rows_scanned
    # Also below an exchange, where the plan is adaptive.
    assert layout.scan_metrics(plain.groupBy("cart_id").count()).rows == 1200


def test_a_bloom_filter_spares_a_value_that_is_not_there(spark):
    df = spark.range(20000).select(
        F.col("id").cast("string").alias("event_id"),
        F.concat(F.lit("c"), F.xxhash64("id")).alias("cart_id"),
        F.lit(NOW).alias("event_timestamp"),
        F.lit(NOW.date()).alias("event_date"),
    )
    with_filter, without = scratch_path(spark, "bloom"), scratch_path(spark, "plain")
    layout.cluster(df, with_filter, "cart_id", bloom=True)
    df.sortWithinPartitions("cart_id").coalesce(1).write.partitionBy("event_date").option("parquet.enable.dictionary#cart_id", "false").parquet(without)
    tables = {"with": spark.read.parquet(with_filter), "without": spark.read.parquet(without)}
    scanned = lambda value: {r.layout: r.rows_scanned for r in layout.lookup_costs(tables, "cart_id", value, str(NOW.date())).collect()}
    absent = scanned("c5")
    assert absent["with"] == 0 and absent["without"] > 0
    there = df.first().cart_id
    assert scanned(there)["with"] > 0
    assert layout.point_lookup(tables["with"], "cart_id", there, str(NOW.date())).count() == 1


def test_the_smallest_value_is_looked_up_in_fewer_rows_of_a_clustered_table(spark):
    """Any layout finds the page of the smallest value by its minimum; a clustered one has smaller pages."""
    source, path = scratch_path(spark, "events"), scratch_path(spark, "clustered")
    df = spark.range(60_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.concat(F.lit("c"), F.xxhash64("id").cast("string")).alias("cart_id"),
        F.lit(str(NOW)).cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(NOW.date()).alias("event_date"),
    )
    df.repartition(4).write.partitionBy("event_date").parquet(source)
    layout.cluster_table(spark, source, path, "cart_id")
    stored_ = {"plain": spark.read.parquet(source), "clustered": spark.read.parquet(path)}
    value, day = layout.sample_lookup(stored_["plain"], "cart_id")
    seen = {r.layout: r.rows_scanned for r in layout.lookup_costs(stored_, "cart_id", value, day).collect()}
    assert 0 < seen["clustered"] <= layout.PAGE_ROWS < seen["plain"]


def test_a_task_sorts_a_bounded_part_of_a_table(spark, monkeypatch):
    source, path = stored(spark), scratch_path(spark, "clustered")
    monkeypatch.setattr(layout, "stored_bytes", lambda *_: 250 * 1024 * 1024)
    layout.cluster_table(spark, source, path, "cart_id")
    after = spark.read.parquet(path)
    assert rows(after) == rows(spark.read.parquet(source))
    # Four days; in one task each would be a file.
    assert len(after.inputFiles()) >= 8
