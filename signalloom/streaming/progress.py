"""What running streams report of themselves: how fresh their data is, trigger by trigger."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from signalloom.functions.clock import AsOf, instant

TRIGGERS = "dataset STRING, batch_id LONG, triggered_at TIMESTAMP, seconds DOUBLE, n_rows LONG, latest_at TIMESTAMP"
OBSERVED = "freshness"


def with_freshness(stream: DataFrame, at: str = "event_timestamp") -> DataFrame:
    """``stream`` observed on its way through: each trigger then reports its newest event time, also without a watermark."""
    return stream.observe(OBSERVED, F.max(F.col(at)).alias("latest"))


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


class ProgressLog(StreamingQueryListener):
    """Keeps the reports of the named queries of a session: those of the last ``most`` triggers, and totals of all.

    A report comes after its trigger, on a thread of its own; nothing is run there, it is only noted. ``flush`` writes
    what was noted since the last flush, so that the reports of a stream of any age take bounded memory. Rows are
    counted as Spark reports them: those of a ``foreachBatch`` step once for each time that it reads its batch.
    """

    def __init__(self, most: int = 10_000) -> None:
        self._lock = threading.Lock()
        self._noted: deque[tuple] = deque(maxlen=most)
        self._totals: dict[str, tuple[int, datetime | None]] = {}
        self._seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            self._seen[str(event.runId)] = self._seen.get(str(event.runId), 0) + 1

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if not p.name:
            return
        observed = p.observedMetrics.get(OBSERVED)
        latest = [observed["latest"] if observed is not None else None, _time((p.eventTime or {}).get("max"))]
        known = max((self._utc(x) for x in latest if x is not None), default=None)
        seconds = (p.durationMs or {}).get("triggerExecution", 0) / 1000
        with self._lock:
            self._noted.append((p.name, p.batchId, self._utc(_time(p.timestamp)), seconds, p.numInputRows, known))
            rows, before = self._totals.get(p.name, (0, None))
            newest = max((x for x in (before, known) if x is not None), default=None)
            self._totals[p.name] = rows + p.numInputRows, newest

    @staticmethod
    def _utc(x: datetime) -> datetime:
        """Spark hands times over in the machine's zone without naming it, reports in UTC."""
        return x.astimezone()

    def wait_for(self, *queries, seconds: float = 30) -> bool:
        """Until the end of each of these stopped queries has been reported: reports lag behind their queries."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self._lock:
                if all(str(q.runId) in self._seen for q in queries):
                    return True
            time.sleep(0.05)
        return False

    def triggers(self, spark: SparkSession) -> DataFrame:
        """The noted triggers, one row each."""
        with self._lock:
            return spark.createDataFrame(list(self._noted), TRIGGERS)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the triggers noted since the last flush to the table at ``path``; returns how many there were."""
        with self._lock:
            rows = list(self._noted)
        if rows:
            spark.createDataFrame(rows, TRIGGERS).coalesce(1).write.mode("append").parquet(path)
        with self._lock:
            for _ in rows:
                self._noted.popleft()
        return len(rows)

    def freshness(self, spark: SparkSession, sla_minutes: Mapping[str, float], as_of: AsOf = None) -> DataFrame:
        """Per dataset of ``sla_minutes`` the newest time its stream has seen, its age and whether that meets the limit.

        A dataset that no stream has reported yet has no newest time and does not meet its limit.
        """
        with self._lock:
            rows = [(name, *self._totals.get(name, (0, None)), float(limit)) for name, limit in sla_minutes.items()]
        seen = spark.createDataFrame(rows, "dataset STRING, n_rows LONG, latest_at TIMESTAMP, sla_minutes DOUBLE")
        age = (F.unix_timestamp(instant(as_of)) - F.unix_timestamp("latest_at")) / F.lit(60.0)
        met = F.coalesce(F.col("lag_minutes") <= F.col("sla_minutes"), F.lit(False))
        return seen.withColumn("lag_minutes", age).withColumn("within_sla", met)


def lag_per_trigger(triggers: DataFrame) -> DataFrame:
    """``triggers`` with how old the newest event was when its trigger had ended, in seconds; null without events."""
    ended = F.unix_micros("triggered_at") / F.lit(1e6) + F.col("seconds")
    return triggers.withColumn("lag_seconds", ended - F.unix_micros("latest_at") / F.lit(1e6))
