"""One audit row per job run, also for runs that fail."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from signalloom.model import AUDIT_COLUMNS, struct_of
from signalloom.sources.files import Lake, literal_rows, run_id

AUDIT_TABLE = ("gold", "pipeline_audit_log")


@dataclass
class Run:
    """A job run as it is logged. The job fills in its counts while it runs."""

    job_name: str
    layer: str
    target_table: str
    run_id: str
    started_at: datetime
    row_count: int | None = None
    quarantined_count: int = 0
    finished_at: datetime | None = None
    status: str = "failed"


def append_run(spark: SparkSession, lake: Lake, run: Run) -> None:
    entry = literal_rows(spark, [asdict(run)], struct_of(AUDIT_COLUMNS))
    entry.coalesce(1).write.mode("append").parquet(lake.path(*AUDIT_TABLE))


@contextmanager
def audited(spark: SparkSession, lake: Lake, job_name: str, layer: str, table: str):
    """Run a job body and log it when it ends, as ``failed`` when it raises."""
    now = partial(datetime.now, timezone.utc)
    run = Run(job_name, layer, lake.table(layer, table), run_id(spark), started_at=now())
    try:
        yield run
        run.status = "success"
    finally:
        run.finished_at = now()
        append_run(spark, lake, run)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whatever action runs it; read ``observation.get['n_rows']`` after."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def read_audit_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(struct_of(AUDIT_COLUMNS)).parquet(lake.path(*AUDIT_TABLE))
