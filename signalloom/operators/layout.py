"""File layout of the event table: compaction, clustering, point lookups and their comparison.

Rewrites go to a new path. The directory of a streaming sink is never touched in place: its
readers obey the sink's own log and would not see files added beside it.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.session import stored_bytes
from signalloom.sinks.tables import files_for, write_partitions

#: Stored bytes that one task of ``cluster_table`` sorts. Rows take about ten times as much in memory.
SORTED_BYTES = 32 * 1024 * 1024
#: Rows of a page of a clustered table. A lookup reads whole pages, by default of 20,000 rows.
PAGE_ROWS = 1000


def compact(df: DataFrame, path: str, by: Sequence[str] = ("event_date",)) -> None:
    """Write ``df`` with as few files per partition as its size allows; large ones stay split."""
    write_partitions(df, path, list(by), mode="overwrite")


def cluster(
    df: DataFrame,
    path: str,
    column: str,
    *,
    by: str = "event_date",
    spread: Sequence[str] = ("event_timestamp", "event_id"),
    n_files: int = 1,
    bloom: bool = False,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write ``df`` so that files, row groups and pages hold narrow ranges of ``column``.

    Their minimum and maximum then let a lookup skip nearly all of them. A page has ``page_rows`` rows at most. ``spread`` comes after
    ``column`` in the range key, so that a single hot value is cut into several files. ``bloom`` adds a Bloom filter
    of ``column`` to each row group, for lookups of values that lie within its range and are not there. The column
    is then written without a dictionary, which a column of many values outgrows and which would take the filter's place.
    """
    order = [by, column, *spread]
    ranged = df.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
    writer = ranged.write.mode("overwrite").partitionBy(by).option("parquet.page.row.count.limit", page_rows)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def cluster_table(spark: SparkSession, source_path: str, path: str, column: str, **options) -> None:
    """``cluster`` for a stored table, cut into files of about 32 MB, since a task sorts all rows of its files."""
    n_files = files_for(stored_bytes(spark, source_path), SORTED_BYTES)
    cluster(spark.read.parquet(source_path), path, column, n_files=n_files, **options)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, n_buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` by a hash of ``key``, known to the session's catalog as ``name``, and return it from there.

    Tables with the same number of buckets of the same key are joined on it, and aggregated by it, without a shuffle:
    that is paid once, here. A bucket is one task of those joins, so their number follows from the largest table, at
    about 256 MB a bucket (``files_for``). For keys that no value dominates, such as order ids. Drop the name when done;
    the files stay.
    """
    dealt = df.repartition(n_buckets, key)
    dealt.write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def sample_lookup(df: DataFrame, column: str, by: str = "event_date") -> tuple[str, str]:
    """A value that occurs, and its day: the smallest value and its first day, so always the same."""
    row = df.where(F.col(column).isNotNull()).agg(F.min(F.struct(column, by)).alias("s")).first()["s"]
    return row[column], str(row[by])


def point_lookup(df: DataFrame, column: str, value: str | Column, day: str | Column, by: str = "event_date") -> DataFrame:
    """Rows with ``value`` from a week before ``day`` on: days are pruned, the value goes to parquet."""
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return df.where((F.col(column) == value) & (F.col(by) >= F.date_sub(day, 7)))


@dataclass(frozen=True)
class ScanMetrics:
    """What the scans of a query did: files and bytes left by partition pruning, rows of the row groups they read."""

    files: int
    bytes: int
    rows: int


def _leaves(plan):
    """Leaves of an executed plan, also of the stages that an adaptive one was run in."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from _leaves(plan.executedPlan())
        return
    leaves = plan.collectLeaves()
    for leaf in map(leaves.apply, range(leaves.size())):
        if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            yield from _leaves(leaf.plan())
        else:
            yield leaf


def scan_metrics(df: DataFrame) -> ScanMetrics:
    """Run ``df`` and add up what its executed file scans report. Its rows stay on the executors."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    totals = dict.fromkeys(("numFiles", "filesSize", "numOutputRows"), 0)
    for leaf in _leaves(execution.executedPlan()):
        metrics = leaf.metrics()
        if metrics.contains("numFiles"):
            for name in totals:
                totals[name] += metrics.apply(name).value()
    return ScanMetrics(totals["numFiles"], totals["filesSize"], totals["numOutputRows"])


def lookup_costs(layouts: Mapping[str, DataFrame], column: str, value: str, day: str, by: str = "event_date") -> DataFrame:
    """One row per layout: what ``point_lookup`` of ``value`` reads there. Counts, so always the same."""
    rows = []
    for name, table in layouts.items():
        seen = scan_metrics(point_lookup(table, column, value, day, by))
        rows.append((name, seen.files, seen.bytes, seen.rows))
    spark = next(iter(layouts.values())).sparkSession
    return spark.createDataFrame(rows, "layout STRING, files_read LONG, bytes_in_files LONG, rows_scanned LONG")


def compare_layouts(
    spark: SparkSession, layouts: Mapping[str, str], column: str = "cart_id", n_runs: int = 5
) -> DataFrame:
    """Time the same lookup on several stored layouts.

    The value comes from the first layout. Per layout: average and fastest time of ``n_runs``
    uncached runs, the number of files, and what the scan read (``lookup_costs``).
    """
    first = spark.read.parquet(next(iter(layouts.values())))
    value, day = sample_lookup(first, column)
    rows = []
    for name, path in layouts.items():
        table = spark.read.parquet(path)
        lookup = point_lookup(table, column, value, day)
        seconds = []
        for _ in range(n_runs):
            spark.catalog.clearCache()
            started = time.perf_counter()
            lookup.write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        rows.append((name, sum(seconds) / n_runs, min(seconds), len(table.inputFiles())))
    timed = spark.createDataFrame(rows, "layout STRING, avg_seconds DOUBLE, min_seconds DOUBLE, num_files LONG")
    return timed.join(lookup_costs({n: spark.read.parquet(p) for n, p in layouts.items()}, column, value, day), "layout")
