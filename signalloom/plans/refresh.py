"""Batch refresh from raw extracts to signals and KPIs, as plain function order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf
from signalloom.model import EventNames, OrderStates
from signalloom.operators import quality
from signalloom.operators.staging import staged, staging_area, staging_path
from signalloom.operators.standardize import STANDARD_FORMS
from signalloom.plans.cart_recovery import cart_recovery_signal
from signalloom.plans.executive import daily_summary
from signalloom.plans.fulfillment_risk import fulfillment_risk_signal
from signalloom.session import hadoop_path, size_shuffles, stored_bytes
from signalloom.sinks.audit import audited, counted
from signalloom.sinks.tables import (
    BUCKET,
    commit_new,
    key_bucket,
    read_snapshot,
    read_table,
    starts_in_place,
    table_exists,
    upsert,
    write_quarantine,
    write_snapshot,
)
from signalloom.sources.files import EXTRACTS, RUN_ID_SETTING, Extract, Lake, read_extract

RULES: dict[str, Callable[[], list[quality.Rule]]] = {
    "products": quality.product_rules,
    "inventory": quality.inventory_rules,
    "orders": quality.order_rules,
    "order_items": quality.order_item_rules,
}


@dataclass(frozen=True)
class Conforming:
    """How one landing table becomes its conformed table."""

    name: str
    keys: tuple[str, ...]
    standardize: Callable[[DataFrame], DataFrame]
    rules: Callable[[], list[quality.Rule]] = field(default=list)
    #: The conformed table that a key refers to, for the full contract.
    references: dict[str, str] = field(default_factory=dict)


#: A cart is known by the sessions of the conformed clickstream.
REFERENCES = {
    "orders": {"customer_id": "customers", "cart_id": "clickstream_events"},
    "order_items": {"order_id": "orders"},
    "shipments": {"order_id": "orders"},
}


def _depth(name: str) -> int:
    return 1 + max((_depth(other) for other in REFERENCES.get(name, {}).values()), default=-1)


#: In the order of the extracts, but for what others refer to, which goes first.
CONFORMINGS = sorted(
    (
        Conforming(e.name, e.keys, STANDARD_FORMS[e.name], RULES.get(e.name, list), REFERENCES.get(e.name, {}))
        for e in EXTRACTS
    ),
    key=lambda c: _depth(c.name),
)
KEYS = {e.name: tuple(e.keys) for e in EXTRACTS}


def ingest_extract(spark: SparkSession, lake: Lake, folder: str, extract: Extract, n_buckets: int = 64) -> None:
    with audited(spark, lake, f"ingest_{extract.name}", "bronze", extract.name) as counts:
        with staging_area(spark, "ingest"):
            rows, seen = counted(read_extract(spark, folder, extract))
            upsert(spark, rows, lake.path("bronze", extract.name), extract.keys, n_buckets=n_buckets)
        counts.row_count = seen.get["n_rows"]


def content_id(rows: DataFrame) -> str:
    """A name for ``rows`` without their lineage: runs without an id replace only what they put aside alike."""
    facts = [c for c in rows.columns if not c.startswith("_")]
    total = F.sum(F.xxhash64(*facts).cast("decimal(38,0)"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(total, F.lit(0)).alias("sum")).first()
    return f"rows-{found['n']}-{found['sum']}"


def conform_table(
    spark: SparkSession,
    lake: Lake,
    table: Conforming,
    n_buckets: int = 64,
    only_run: str | None = None,
    full_contract: bool = False,
    references: bool = False,
) -> None:
    """Check and merge one table. ``only_run`` limits it to the rows that this run ingested.

    ``references`` also puts aside rows whose keys refer to nothing that is known: orders of unknown customers or of
    carts that no session holds, lines and shipments of unknown orders. Where the table referred to isn't there yet,
    nothing is checked against it. ``full_contract`` does that too, and puts aside orders whose time isn't near that of
    their ingestion; a first load of old orders would fail the latter.
    """
    with audited(spark, lake, f"conform_{table.name}", "silver", table.name) as counts:
        rows = read_table(spark, lake.path("bronze", table.name))
        if only_run is not None:
            rows = rows.where(rows["_batch_run_id"] == only_run)
        with staging_area(spark, "conform"):
            rows, rules = table.standardize(rows), table.rules()
            flags = []
            if full_contract or references:
                for key, other in table.references.items():
                    if not table_exists(spark, lake.path("silver", other)):
                        continue
                    known = read_table(spark, lake.path("silver", other)).select(key)
                    if KEYS.get(other) != (key,):
                        known = staged(known.where(F.col(key).isNotNull()).distinct(), "known-keys")
                    flags.append(f"_orphan_{key}")
                    rows = quality.with_orphan_flag(rows, known, key, table.keys[0], flags[-1])
                    rules.append(quality.Rule(f"orphan_{key}", F.col(flags[-1])))
            if full_contract:
                if table.name == "orders":
                    rules.append(quality.order_clock_rule(F.col("_bronze_ingested_at")))
            path, quarantine = lake.path("silver", table.name), lake.path("silver", f"{table.name}_quarantine")
            tagged = quality.tag(rows, rules).drop(*flags)
            in_place = starts_in_place(spark, path, n_buckets)
            # A table that isn't there yet is made of the checked rows as they are written; its files keep their empty reasons.
            checked = f"{path}/_checked-{uuid.uuid4().hex}" if in_place else staging_path(spark, "checked")
            if in_place:
                tagged = tagged.withColumn(BUCKET, key_bucket(table.keys, n_buckets))
            clean, bad = quality.write_checked(tagged, checked, [BUCKET] if in_place else [])
            aside = bad.drop(BUCKET)
            write_quarantine(aside, quarantine, spark.conf.get(RUN_ID_SETTING, None) or content_id(aside))
            counts.quarantined_count = bad.count()
            if in_place:
                counts.row_count = clean.count()
                commit_new(spark, f"{checked}/{quality.CLEAN_FOLDER}", clean.schema, path, table.keys, n_buckets)
                # Only now: a commit that died is finished from this folder.
                fs, where = hadoop_path(spark, checked)
                fs.delete(where, True)
            else:
                clean, seen = counted(clean)
                upsert(spark, clean, path, table.keys, n_buckets=n_buckets, is_written=True)
                counts.row_count = seen.get["n_rows"]


def publish(spark: SparkSession, lake: Lake, name: str, build: Callable[[], DataFrame]) -> None:
    """Write a signal as a snapshot; its rows are counted by the write itself."""
    with audited(spark, lake, f"publish_{name}", "gold", name) as counts:
        with staging_area(spark, name):
            rows, seen = counted(build())
            write_snapshot(rows, lake.path("gold", name))
        counts.row_count = seen.get["n_rows"]


def refresh(
    spark: SparkSession,
    lake: Lake,
    extracts_folder: str,
    as_of: AsOf = None,
    *,
    extracts: Iterable[Extract] = EXTRACTS,
    names: EventNames = EventNames(),
    states: OrderStates = OrderStates(),
    n_buckets: int = 64,
    method: str = "approx",
    only_new: bool = False,
    full_contract: bool = False,
    references: bool = False,
) -> None:
    """Ingest and conform the extracts, publish both signals, and record the day's KPIs.

    The conformed clickstream is expected to be there: its stream runs on its own. Running the
    refresh again gives the same tables.

    ``only_new`` conforms what this run ingests and not the whole landing tables again; the run then needs an
    id of its own, under which it is also repeated if it dies. ``full_contract`` and ``references`` are those of ``conform_table``.
    """
    only_run = spark.conf.get(RUN_ID_SETTING, None) if only_new else None
    if only_new and only_run is None:
        raise ValueError(f"set {RUN_ID_SETTING} to the id of this run")
    size_shuffles(spark, stored_bytes(spark, extracts_folder))
    for extract in extracts:
        ingest_extract(spark, lake, extracts_folder, extract, n_buckets)
    for table in CONFORMINGS:
        if table_exists(spark, lake.path("bronze", table.name)):
            conform_table(spark, lake, table, n_buckets, only_run, full_contract, references)

    silver_folder = lake.path("silver", "clickstream_events").rsplit("/", 1)[0]
    size_shuffles(spark, stored_bytes(spark, silver_folder))

    def silver(name: str) -> DataFrame:
        return read_table(spark, lake.path("silver", name))

    publish(
        spark,
        lake,
        "cart_recovery_signal",
        lambda: cart_recovery_signal(
            silver("clickstream_events"), silver("orders"), as_of, names=names, states=states,
            percentile_method=method,
        ),
    )
    publish(
        spark,
        lake,
        "fulfillment_risk_signal",
        lambda: fulfillment_risk_signal(
            silver("orders"), silver("shipments"), silver("order_items"), silver("inventory"), as_of,
            states=states,
        ),
    )
    with audited(spark, lake, "record_daily_kpis", "gold", "exec_summary_daily") as counts:
        with staging_area(spark, "kpis"):
            row = daily_summary(
                read_snapshot(spark, lake.path("gold", "cart_recovery_signal")),
                read_snapshot(spark, lake.path("gold", "fulfillment_risk_signal")),
                silver("shipments"),
                silver("clickstream_events"),
                as_of,
                names=names,
                method=method,
            )
            upsert(spark, row, lake.path("gold", "exec_summary_daily"), ["metric_date"], n_buckets=1)
        counts.row_count = 1
