"""Cutting lineage, and checking a size before broadcasting."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.session import hadoop_path, scratch_path

BROADCAST_BYTES = 64 * 1024 * 1024

_area: ContextVar[str | None] = ContextVar("staging_area", default=None)


@contextmanager
def staging_area(spark: SparkSession, label: str):
    """Tables staged inside the block are deleted at its end, once its results are written.

    Outside of any block they stay until the shared folder is cleaned up.
    """
    folder = scratch_path(spark, label)
    token = _area.set(folder)
    try:
        yield
    finally:
        _area.reset(token)
        fs, path = hadoop_path(spark, folder)
        fs.delete(path, True)


def staging_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label, _area.get())


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For a result that is small next to its inputs and is read more than once: the inputs are
    scanned one time only, and a lost executor costs a re-read instead of a recomputation.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_of(schema: T.StructType) -> Column:
    """Aggregate for the bytes held by columns of ``schema``: a fixed width each, plus texts and array elements."""
    fixed, text = 8 + 16 * len(schema.fields), []
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text.append(F.coalesce(F.sum(F.octet_length(field.name)), F.lit(0)))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, (T.NumericType, T.DatetimeType)):
            text.append(F.coalesce(F.sum(F.greatest(F.size(field.name), F.lit(0)) * 16), F.lit(0)))
        elif not isinstance(field.dataType, T.AtomicType):
            raise TypeError(f"no size rule for {field.name}: {field.dataType.simpleString()}")
    return reduce(add, text, F.count(F.lit(1)) * F.lit(fixed))


def staged_with_size(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``staged``, and the bytes of its data as measured by the write itself (0 without rows)."""
    observation = Observation()
    written = staged(df.observe(observation, size_of(df.schema).alias("size")), label)
    return written, observation.get["size"]


def broadcast_if_small(
    df: DataFrame, size: int | None = None, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint when its measured size is within the limit, else as it is.

    The size is measured here unless the caller has already done so; ``df`` is then read twice, so
    it should be cheap to read. Callers must be correct either way: without the hint Spark shuffles
    both sides, and adaptive execution splits partitions that a hot key makes too large.
    """
    if size is None:
        size = df.agg(size_of(df.schema).alias("size")).first()["size"]
    return F.broadcast(df) if size <= limit_bytes else df
