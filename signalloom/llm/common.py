"""What the operators of this subpackage share: tables, batches of rows in tasks, written intermediate results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], text: str | int = "text", most: int = BATCH_BYTES):
    """Cut record batches so that the texts of each slice hold about ``most`` bytes."""
    for batch in batches:
        column = batch.column(text)
        start, size = 0, 0
        lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths):
            size += 0 if n != n or n is None else int(n)
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text"):
    """Apply ``fn`` to slices of bounded size; it returns a record batch, or None for no rows."""

    def run(batches):
        for part in slices(batches, text):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
