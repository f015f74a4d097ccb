"""Sessions of a stream that lose no row: late rows go to a table of their own, and mend the sessions they touch."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalloom.operators.sessions import session_summary, sessionize
from signalloom.operators.staging import staged, staging_area
from signalloom.session import hadoop_path
from signalloom.streaming.landing import with_trigger

SPAN = ["started_at", "ended_at", "n_events"]


def joined_spans(spans: DataFrame, key: str, gap_minutes: int) -> DataFrame:
    """(key, started_at, ended_at, n_events) with the spans of a key made one that lie no more than the gap apart.

    A session is the sum of its parts: earliest start, latest end, number of events. So sessions of different batches,
    and single late events, are joined without their events. A key's spans are ordered in one window; that is a row
    for each session of the key, not for each event.
    """
    along = Window.partitionBy(key).orderBy("started_at", "ended_at")
    reach = F.max("ended_at").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("started_at") > reach + F.make_dt_interval(mins=F.lit(gap_minutes))).cast("int"), F.lit(1))
    island = F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0))
    numbered = spans.withColumn("_opens", opens).withColumn("_island", island)
    return (
        numbered.groupBy(key, "_island")
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("n_events").alias("n_events"))
        .drop("_island")
    )


@dataclass(frozen=True)
class SessionsWithLate:
    """A micro-batch step that keeps sessions below ``root``: ``open``, ``closed``, ``late`` and ``clock``, a folder a batch.

    A row is late if it is older than the newest event time of the batches before its own, less ``lateness``: that is
    when a watermark would drop it. It goes to ``late`` whole. A session is closed once nothing that isn't late could
    join it. Each batch is made from the one before it into folders of its own, which a repeated batch writes anew, so
    batches that died or are replayed change nothing. Rows without a key or a time are late too: no session is theirs.
    """

    root: str
    key: str = "session_id"
    gap_minutes: int = 30
    lateness: timedelta = timedelta(hours=2)

    def _path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch={batch_id}"

    def _before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The last batch before this one that was finished; batches without data leave no folder."""
        fs, pattern = hadoop_path(spark, f"{self.root}/clock/batch=*/_SUCCESS")
        done = [int(m.getPath().getParent().getName().split("=")[1]) for m in fs.globStatus(pattern) or []]
        return max((n for n in done if n < batch_id), default=None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, self.key
        last = self._before(spark, batch_id)
        newest = spark.read.parquet(self._path("clock", last)).first()["newest"] if last is not None else None
        lateness = F.make_dt_interval(secs=F.lit(self.lateness.total_seconds()))
        at = F.col("event_timestamp")
        with staging_area(spark, f"sessions-{batch_id}"):
            rows = staged(batch, "batch")
            usable = F.col(key).isNotNull() & at.isNotNull()
            limit = F.lit(newest).cast("timestamp") - lateness
            in_time = usable if newest is None else usable & (at >= limit)
            rows.where(~F.coalesce(in_time, F.lit(False))).write.mode("overwrite").parquet(self._path("late", batch_id))
            fresh = sessionize(rows.where(in_time), key, gap_minutes=self.gap_minutes)
            spans = session_summary(fresh, key).select(key, *SPAN)
            if last is not None:
                spans = spans.unionByName(spark.read.parquet(self._path("open", last)))
            spans = staged(joined_spans(spans, key, self.gap_minutes), "spans")
            now = rows.agg(F.greatest(F.max(at), F.lit(newest).cast("timestamp")).alias("newest")).first()["newest"]
            done = F.lit(False)
            if now is not None:
                done = F.col("ended_at") + F.make_dt_interval(mins=F.lit(self.gap_minutes)) < F.lit(now).cast("timestamp") - lateness
            spans.where(done).write.mode("overwrite").parquet(self._path("closed", batch_id))
            spans.where(~done).write.mode("overwrite").parquet(self._path("open", batch_id))
            # Last of all: with its clock a batch is finished.
            clock = spark.range(1).select(F.lit(now).cast("timestamp").alias("newest"))
            clock.write.mode("overwrite").parquet(self._path("clock", batch_id))

    def _all(self, spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(f"{self.root}/{name}").drop("batch")

    def closed(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "closed")

    def late(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "late")

    def open(self, spark: SparkSession) -> DataFrame:
        """The sessions that may still grow, as of the last finished batch."""
        return spark.read.parquet(self._path("open", self._before(spark, 1 << 62)))

    def repaired(self, spark: SparkSession) -> DataFrame:
        """Closed and open sessions with every late row in the session it belongs to, or in one of its own.

        Only the keys that have late rows are put in order again; the sessions of all others are passed through.
        """
        known = self.closed(spark).unionByName(self.open(spark))
        usable = F.col(self.key).isNotNull() & F.col("event_timestamp").isNotNull()
        late = self.late(spark).where(usable).groupBy(self.key, "event_timestamp").agg(F.count(F.lit(1)).alias("n_events"))
        late = staged(
            late.select(self.key, F.col("event_timestamp").alias("started_at"), F.col("event_timestamp").alias("ended_at"), "n_events"), "late"
        )
        touched = late.select(F.col(self.key).alias("_touched")).distinct()
        same = F.col(self.key) == F.col("_touched")
        mended = joined_spans(known.join(touched, same, "left_semi").unionByName(late), self.key, self.gap_minutes)
        return known.join(touched, same, "left_anti").unionByName(mended)


def start_sessions(stream: DataFrame, step: SessionsWithLate, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()
