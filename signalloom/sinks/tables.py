"""Writes to parquet tables: append, snapshot, and merges on a key.

Without a table format a merge is a rewrite. It is kept to the partitions it touches, which are first written
whole beside the table. The commit is a note that names them: before it is there the table is as it was, and from
then on readers take the named partitions, wherever they are, and the next merge finishes moving them in. So a driver
may die at any point, and the merge is simply repeated.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.operators.dedupe import latest_per_key
from signalloom.operators.staging import BROADCAST_BYTES, broadcast_if_small, size_of, staged
from signalloom.session import hadoop_path, stored_bytes

BUCKET = "key_bucket_no"
# A merge that finds more files than this per bucket also compacts.
MOST_FILES = 8
# Up to so many buckets a task of 128 MB leaves files of 8 MB or more, which needn't be brought together.
FEW_BUCKETS = 16


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was committed at ``path``; leftovers of an unfinished write do not count."""
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return False
    return any(not child.getPath().getName().startswith(("_", ".")) for child in fs.listStatus(where))


LAYOUT = "_layout.json"


COMMIT = "_commit.json"


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, content: dict) -> None:
    fs, where = hadoop_path(spark, path)
    out = fs.create(where, True)
    out.write(json.dumps(content).encode())
    out.close()


def stored_layout(spark: SparkSession, path: str) -> dict | None:
    """Keys, number of buckets and schema of a merged table, as kept beside its files; None without them."""
    note = _read_json(spark, f"{path}/{COMMIT}")
    return note["layout"] if note else _read_json(spark, f"{path}/{LAYOUT}")


def _bucket_folder(root: str, bucket: int) -> str:
    return f"{root}/{BUCKET}={bucket}"


def _move_in(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``; nothing to do if that was done before."""
    fs, written = hadoop_path(spark, source)
    _, place = hadoop_path(spark, target)
    if fs.exists(written):
        fs.delete(place, True)
        if not fs.rename(written, place):
            raise OSError(f"{source} could not be moved to {target}")


def _finish_commit(spark: SparkSession, path: str) -> None:
    """Move in what a commit names. Every step may be repeated, and the note goes last. For the one writer of a table."""
    note = _read_json(spark, f"{path}/{COMMIT}")
    if note is None:
        return
    for bucket in note["buckets"]:
        _move_in(spark, _bucket_folder(note["written"], bucket), _bucket_folder(path, bucket))
    _write_json(spark, f"{path}/{LAYOUT}", note["layout"])
    fs, where = hadoop_path(spark, f"{path}/{COMMIT}")
    fs.delete(where, False)
    fs.delete(hadoop_path(spark, note["written"])[1], True)


def _commit(spark: SparkSession, path: str, written: str, buckets: Sequence[int], layout: dict) -> None:
    """Make the buckets below ``written`` those of the table: by a note that is there whole or not at all."""
    _write_json(spark, f"{written}{COMMIT}", {"written": written, "buckets": sorted(buckets), "layout": layout})
    fs, draft = hadoop_path(spark, f"{written}{COMMIT}")
    if not fs.rename(draft, hadoop_path(spark, f"{path}/{COMMIT}")[1]):
        raise OSError(f"{path} could not be committed")
    _finish_commit(spark, path)


def _layout(keys: Sequence[str], n_buckets: int, schema: T.StructType) -> dict:
    return {"keys": list(keys), "n_buckets": n_buckets, "schema": json.loads(schema.json())}


def _agreed_schema(stored: T.StructType, source: T.StructType, path: str) -> T.StructType:
    """The stored columns and then the source's new ones; a column that changes its type is an error."""
    types = {f.name: f.dataType for f in stored.fields}
    for f in source.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"{path} stores {f.name} as {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*stored.fields, *(f for f in source.fields if f.name not in types)])


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    return fs.exists(where)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    note = _read_json(spark, f"{path}/{COMMIT}")
    layout = stored_layout(spark, path)
    reader = lambda: spark.read.schema(T.StructType.fromJson(layout["schema"])) if layout else spark.read
    if note is None:
        return reader().parquet(path)
    # A commit that has not moved in all its buckets yet: those are read where they were written.
    waiting = [b for b in note["buckets"] if _exists(spark, _bucket_folder(note["written"], b))]
    moved = reader().parquet(path).where(~F.col(BUCKET).isin(waiting)) if waiting else reader().parquet(path)
    return moved.unionByName(reader().parquet(note["written"]).where(F.col(BUCKET).isin(waiting))) if waiting else moved


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table without its storage columns, in the schema kept beside it if there is one."""
    return _stored(spark, path).drop(BUCKET)


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "append",
    replace_touched: bool = False,
    arrange: bool = True,
) -> None:
    """Write ``df`` below ``path``, one folder per value of ``by``.

    Rows are first brought together by ``by`` with a rebalance: Spark merges small partitions and
    splits a value that holds too many rows over several tasks and files. ``arrange=False`` is for
    rows that already lie together.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in by]) if by and arrange else df
    writer = spread.write.mode("overwrite" if replace_touched else mode)
    if replace_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def key_bucket(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_s_{c}") for c in columns])


def without_keys(target: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key (nulls equal) is not in ``source_keys``; hashes, never nested loops."""
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return target.join(_renamed(source_keys, keys), match, "left_anti")


def _repeats(path: str, keys: Sequence[str]) -> ValueError:
    return ValueError(f"source of the merge into {path} repeats a key ({', '.join(keys)})")


def _most_of(rows: DataFrame, *by: Column) -> int:
    """Rows of the largest group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]


def _create(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], n_buckets: int, is_unique: bool) -> None:
    """Make the table of ``source``, which is computed once: its rows are written in place and their keys checked afterwards.

    Nothing is committed if a key repeats. Rows of few buckets are written by the tasks that have them, in a file for each
    bucket; those of many are brought together first.
    """
    written = f"{path}/_merge-{uuid.uuid4().hex}"
    write_partitions(source, written, [BUCKET], arrange=n_buckets > FEW_BUCKETS)
    commit_new(spark, written, source.schema, path, keys, n_buckets, is_unique)


def starts_in_place(spark: SparkSession, path: str, n_buckets: int) -> bool:
    """Whether the table is still to be made, of so few buckets that its rows are written where they are."""
    _finish_commit(spark, path)
    return n_buckets <= FEW_BUCKETS and not table_exists(spark, path)


def commit_new(
    spark: SparkSession, written: str, schema: T.StructType, path: str, keys: Sequence[str], n_buckets: int, is_unique: bool = False
) -> None:
    """Make the folder ``written`` below ``path``, with one folder a bucket, the table; ``schema`` is what it shows."""
    fs, where = hadoop_path(spark, written)
    folders = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    buckets = [int(name.split("=")[1]) for name in folders if name.startswith(f"{BUCKET}=")]
    stored = spark.read.schema(schema).parquet(written) if buckets else None
    # A hash says whether keys can repeat at all, and only then the keys themselves are shuffled.
    if buckets and not is_unique and _most_of(stored, F.xxhash64(*keys)) > 1 and _most_of(stored, *map(F.col, keys)) > 1:
        fs.delete(where, True)
        raise _repeats(path, keys)
    if buckets:
        _commit(spark, path, written, buckets, _layout(keys, n_buckets, schema))
    else:
        fs.delete(where, True)


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    n_buckets: int = 64,
    newest: str | None = None,
    is_written: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Rows of ``source`` replace those with the same key and are added otherwise. Null keys match.

    The table is split by a hash of the key, so a merge rewrites only the buckets its keys fall
    in. ``n_buckets`` counts when the table is made; number, keys and schema are then kept beside it. New
    columns are added, a column that changes its type is an error. ``source`` must hold a key once, else the result
    would depend on row order: that is an error, unless ``newest`` names a column whose highest
    value wins. ``is_written`` says that ``source`` reads a written table and need not be written
    once more to be read several times. The first merge makes the table: its source is computed and written once.

    When the source's keys are small enough to broadcast, stored rows are not shuffled: they are
    read, filtered and written bucket by bucket. Otherwise stored and new rows are brought together
    by bucket and slice in one shuffle, and the new one of each key is kept.
    """
    if newest is not None:
        ties = [c for c, t in source.dtypes if c != newest and "<" not in t]
        source = latest_per_key(source, keys, newest, ties)
    _finish_commit(spark, path)
    layout = stored_layout(spark, path) if table_exists(spark, path) else None
    if layout is not None:
        if layout["keys"] != list(keys):
            raise ValueError(f"{path} is merged by {', '.join(layout['keys'])}, not by {', '.join(keys)}")
        n_buckets = layout["n_buckets"]
    source = source.withColumn(BUCKET, key_bucket(keys, n_buckets))
    if not table_exists(spark, path):
        _create(spark, source, path, keys, n_buckets, is_unique=newest is not None)
        return
    if not is_written or newest is not None:
        source = staged(source, "upsert-source")
    # One pass tells whether keys repeat, which buckets are met (at most n_buckets numbers) and
    # how large the keys are.
    per_key = source.groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("_rows"))
    facts = per_key.agg(
        F.max("_rows").alias("most"),
        F.collect_set(BUCKET).alias("buckets"),
        size_of(source.select(*keys).schema).alias("size"),
    ).first()
    if facts["most"] is None:
        return
    if facts["most"] > 1:
        raise _repeats(path, keys)
    written = f"{path}/_merge-{uuid.uuid4().hex}"
    schema = _agreed_schema(_stored(spark, path).schema, source.schema, path)
    stored = _stored(spark, path).where(F.col(BUCKET).isin(facts["buckets"]))
    crowded = len(stored.inputFiles()) > MOST_FILES * len(facts["buckets"])
    if facts["size"] <= broadcast_bytes:
        kept = without_keys(stored, F.broadcast(source), keys)
        merged = kept.unionByName(source.hint("rebalance", F.col(BUCKET)), allowMissingColumns=True)
    else:
        # A bucket is cut into slices of about one file, so that no task gets a whole large bucket.
        n_slices = files_for(stored_bytes(spark, path) // n_buckets)
        piece = F.pmod(F.shiftright(F.xxhash64(*keys), 32), F.lit(n_slices)).alias("_slice")
        both = stored.select("*", F.lit(0).alias("_new"), piece).unionByName(
            source.select("*", F.lit(1).alias("_new"), piece), allowMissingColumns=True
        )
        together = both.repartition(BUCKET, "_slice")
        merged = latest_per_key(together, [BUCKET, "_slice", *keys], "_new").drop("_new", "_slice")
        crowded = False
    write_partitions(merged, written, [BUCKET], arrange=crowded)
    _commit(spark, path, written, facts["buckets"], _layout(keys, n_buckets, schema))


def _in_partitions_of(stored: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The stored partitions that ``batch`` meets. Their values, one per partition, are listed in the
    filter, so that all others are pruned before anything is read."""
    met = [r[0] for r in batch.select(column).distinct().collect()]
    hit = F.col(column).isin([v for v in met if v is not None])
    return stored.where(hit | F.col(column).isNull() if None in met else hit)


def insert_new(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: str,
    partition_by: str | None = None,
    copies_share_partition: bool = False,
) -> None:
    """Add the rows of ``source`` whose key is not stored yet; stored rows stay as they are.

    Safe to repeat after a partial write: what was written is recognised by its key (rows without
    a key cannot be, and are always added). The stored keys met again are found by broadcasting the
    batch's keys to a scan of the key column alone; the table is not shuffled for a small batch.
    With ``copies_share_partition`` a stored copy is looked for in its own partition only, so the
    cost of a batch does not grow with the age of the table; keys are then unique per partition.
    """
    if table_exists(spark, path):
        source = staged(source, "insert-source")
        stored = spark.read.parquet(path)
        columns, same = [key], F.col(key) == F.col(f"_s_{key}")
        if copies_share_partition and partition_by:
            stored = _in_partitions_of(stored, source, partition_by)
            columns.append(partition_by)
            same = same & F.col(partition_by).eqNullSafe(F.col(f"_s_{partition_by}"))
        ids = _renamed(source, columns)
        again = stored.select(*columns).join(broadcast_if_small(ids), same, "left_semi")
        source = source.join(_renamed(again, columns), same, "left_anti")
    write_partitions(source, path, [partition_by] if partition_by else [])


def merge_latest(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    newest: str,
    partition_by: str,
    tie_breakers: Sequence[str] = (),
) -> None:
    """Keep the newest row per key over table and batch, also when copies come in different batches.

    ``partition_by`` must follow from the key, so that all copies of a key share a partition; only
    the partitions of the batch are read and rewritten. That is still a rewrite of whole days: for
    hourly or daily batches rather than for a stream of small ones.
    """
    source = staged(source, "merge-source")
    if table_exists(spark, path):
        stored = _in_partitions_of(spark.read.parquet(path), source, partition_by)
        source = stored.unionByName(source, allowMissingColumns=True)
    write_partitions(
        latest_per_key(source, keys, newest, tie_breakers), path, [partition_by], replace_touched=True
    )


# Snapshots: each run writes a new version next to the last one. Spark puts its _SUCCESS marker in
# place once the whole version is written, and readers take the highest marked version, so a
# reader or a failed run never meets half a snapshot.


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, pattern = hadoop_path(spark, f"{path}/v=*/_SUCCESS")
    marks = fs.globStatus(pattern) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)


def write_snapshot(df: DataFrame, path: str) -> str:
    """Replace the table at ``path``, schema included. Returns the path of the new version."""
    done = _versions(df.sparkSession, path)
    version = f"{path}/v={(done[-1] + 1) if done else 0}"
    df.write.mode("overwrite").parquet(version)
    return version


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    done = _versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished snapshot at {path}")
    return spark.read.parquet(f"{path}/v={done[-1]}")


def write_quarantine(quarantined: DataFrame, path: str, batch_id: str | int) -> bool:
    """Keep quarantined rows of one batch with the time; nothing is written without any.

    Each batch has its own folder, which a repeated batch overwrites, or clears if it has no such rows any more.
    """
    if quarantined.isEmpty():
        fs, where = hadoop_path(quarantined.sparkSession, f"{path}/batch_id={batch_id}")
        fs.delete(where, True)
        return False
    stamped = quarantined.withColumn("_quarantined_at", F.current_timestamp())
    stamped.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return True


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, one file per task."""
    df.write.mode("overwrite").csv(path, header=True)


def files_for(total_bytes: int, file_bytes: int = 256 * 1024 * 1024) -> int:
    return max(1, math.ceil(total_bytes / file_bytes))
