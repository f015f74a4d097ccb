"""Raw event files to the landing table: incremental, append-only, never failing on a bad line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalloom.model import CLICKSTREAM_COLUMNS, struct_of
from signalloom.sources.rescue import rescued_json
from signalloom.streaming.progress import with_freshness

CLICKSTREAM = struct_of(CLICKSTREAM_COLUMNS)


def with_trigger(writer, every: str | None):
    """``every`` (such as "1 minute") keeps the query running; without it the backlog is drained once."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def read_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New files below ``folder`` as text lines with the file's path and modification time.

    ``max_files`` bounds a micro-batch, so that a backlog is worked off in even steps.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_mtime"),
    )


def landed(lines: DataFrame) -> DataFrame:
    """Typed clickstream rows with lineage. A malformed time becomes null, for the row checks to catch."""
    rows = rescued_json(lines, CLICKSTREAM)
    return rows.withColumns(
        {
            "event_timestamp": F.try_to_timestamp("event_timestamp"),
            "producer_ingested_at": F.try_to_timestamp("_ingested_at"),
            "_bronze_ingested_at": F.current_timestamp(),
        }
    ).drop("_ingested_at")


def start_landing(
    spark: SparkSession,
    folder: str,
    table_path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    max_files: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append every new line to the landing table. The checkpoint remembers the files already read.

    A query with a ``name`` reports its newest event time to a ``ProgressLog``.
    """
    rows = landed(read_lines(spark, folder, max_files))
    if name:
        rows = with_freshness(rows)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return with_trigger(writer, every).start(table_path)
