"""States as they were recorded: an append-only history of extracts, its validity intervals, and joins as of a time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.clock import AsOf, instant
from signalloom.operators.staging import staged
from signalloom.session import hadoop_path
from signalloom.sinks.tables import table_exists

#: When an extract was taken, and whether the key was still in it.
SEEN, GONE = "_seen_at", "_gone"


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _facts(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return sorted(c for c in df.columns if c not in keys and not c.startswith("_"))


def _marked(extract: DataFrame, at) -> DataFrame:
    return extract.withColumns({SEEN: F.lit(at), GONE: F.lit(False)})


def record_extract(
    spark: SparkSession, extract: DataFrame, path: str, keys: Sequence[str], taken_at: AsOf, *, complete: bool = False
) -> None:
    """Append what ``extract`` tells that the extracts before it did not: new keys and changed facts.

    Every extract has a folder of its own, named by its time and written anew when it is recorded again, and is
    compared with earlier ones only: recording the same extracts again, in any order, leaves the same history.
    The first one is stored whole; later ones cost what changed. One that is new and older than what is stored is an
    error. Columns may come and go; where they are missing they are null. ``complete`` says that a key that is missing was
    deleted, and records that. A key may occur once in an extract. Columns that start with ``_`` are no facts.
    """
    at = spark.range(1).select(instant(taken_at).alias("t")).first()["t"]
    name = f"taken={at:%Y%m%dT%H%M%S%f}"
    facts = _facts(extract, keys)
    if not table_exists(spark, path):
        _marked(extract.select(*keys, *facts), at).write.mode("overwrite").parquet(f"{path}/{name}")
        return
    fs, where = hadoop_path(spark, path)
    taken = [x.getPath().getName() for x in fs.listStatus(where)]
    if name not in taken and name < max(taken):
        raise ValueError(f"{path} already holds later extracts, which were compared with those before them")
    before = read_history(spark, path).where(F.col(SEEN) < F.lit(at))
    kinds = {f.name: f.dataType for df in (extract, before) for f in df.schema.fields}
    facts = sorted({*facts, *_facts(before, keys)})
    now, before = (
        df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])
        for df, columns in ((_marked(extract, at), [*keys, *facts, SEEN, GONE]), (before, [*keys, *facts, SEEN, GONE]))
    )
    # One shuffle and one sort: each row of this extract lies next to its key's last recorded state.
    along = Window.partitionBy(*keys).orderBy(SEEN)
    state = F.struct(GONE, *facts)
    told = before.unionByName(now).withColumn("_before", F.lag(state).over(along)).where(F.col(SEEN) == F.lit(at))
    out = told.where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)).select(*now.columns)
    if complete:
        last = latest_state(before, keys)
        named = extract.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        lost = last.where(~F.col(f"_state.{GONE}")).join(named, _same(keys, "_k_"), "left_anti")
        out = out.unionByName(
            lost.select(*keys, *[F.col(f"_state.{c}").alias(c) for c in facts], F.lit(at).alias(SEEN), F.lit(True).alias(GONE))
        )
    # A folder that is there is among the files that are read, so what replaces it is written beside it first.
    out = staged(out, "changes") if name in taken else out
    out.write.mode("overwrite").parquet(f"{path}/{name}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path).drop("taken")


def latest_state(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last recorded state of each key, as a struct ``_state`` of ``_gone`` and the facts."""
    facts = _facts(history, keys)
    return history.groupBy(*keys).agg(F.max_by(F.struct(GONE, *facts), SEEN).alias("_state"))


def intervals(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per state a key was in: its facts, ``valid_from`` and ``valid_to`` (null: still so).

    A state holds from the extract that first showed it up to, and without, the next that shows another. Repeats of a
    state are one interval, and a deleted key has none after its end. A key's states are ordered in one window: that
    is one row for each change of the key, as extracts that changed nothing are not in the history.
    """
    facts = _facts(history, keys)
    along = Window.partitionBy(*keys).orderBy(SEEN)
    state = F.struct(GONE, *facts)
    first_of_state = history.withColumn("_before", F.lag(state).over(along)).where(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)
    )
    spans = first_of_state.withColumn("valid_to", F.lead(SEEN).over(along))
    return spans.where(~F.col(GONE)).select(*keys, *facts, F.col(SEEN).alias("valid_from"), "valid_to")


def as_of(df: DataFrame, versions: DataFrame, keys: Sequence[str], at: str | Column, how: str = "left") -> DataFrame:
    """``df`` with the facts of ``intervals`` that held at each row's ``at``; nulls (``left``) where there were none.

    An equi-join on the keys with the interval as a further condition; intervals of a key don't overlap, so a row
    meets one at most. Rows with a null key meet nothing.
    """
    at = F.col(at) if isinstance(at, str) else at
    facts = [c for c in versions.columns if c not in keys]
    clash = {*df.columns} & {*facts}
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    named = versions.select(*[F.col(k).alias(f"_v_{k}") for k in keys], *facts)
    same = reduce(and_, [F.col(k) == F.col(f"_v_{k}") for k in keys])
    held = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    return df.join(named, same & held, how).drop(*[f"_v_{k}" for k in keys])


def merged_spans(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, start, end) with overlapping or touching spans of a key made one; a null end is open.

    Equal spans are made one before the window. Meant for spans of whole days, of which a key has few.
    """
    never = F.lit("9999-12-31").cast(T.DateType())
    one = spans.where(F.col(key).isNotNull()).select(key, start, F.coalesce(end, never).alias(end)).distinct()
    along = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col(start) > reach).cast("int"), F.lit(1))
    island = F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0))
    numbered = one.withColumn("_opens", opens).withColumn("_island", island)
    return numbered.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")
