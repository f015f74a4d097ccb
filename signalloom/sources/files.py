"""Batch sources: header CSV extracts, date-partitioned JSON landings, stored tables, literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.model import CLICKSTREAM_COLUMNS, EXTRACT_COLUMNS, EXTRACT_KEYS, struct_of

LAYERS = ("bronze", "silver", "gold")
RUN_ID_SETTING = "spark.signalloom.runId"


@dataclass(frozen=True)
class Extract:
    """One raw table: its name, declared schema, and the key it is merged on."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]


EXTRACTS = [Extract(name, struct_of(ddl), EXTRACT_KEYS[name]) for name, ddl in EXTRACT_COLUMNS.items()]


@dataclass(frozen=True)
class Lake:
    """Names and places of tables: ``<project>_<env>.<layer>.<table>``, stored likewise below ``root``."""

    root: str
    env: str = "dev"
    project: str = "retail"

    def _parts(self, layer: str, name: str) -> list[str]:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}: it must be one of {', '.join(LAYERS)}")
        return [f"{self.project}_{self.env}", layer, name]

    def table(self, layer: str, name: str) -> str:
        return ".".join(self._parts(layer, name))

    def path(self, layer: str, name: str) -> str:
        return "/".join([self.root.rstrip("/"), *self._parts(layer, name)])

    def checkpoint(self, stream: str) -> str:
        return "/".join([self.root.rstrip("/"), "checkpoints", self.env, stream])


def run_id(spark: SparkSession) -> str:
    """Id of the running job as set on the session, ``manual`` when none is."""
    return spark.conf.get(RUN_ID_SETTING, "manual")


def read_extract(spark: SparkSession, folder: str, extract: Extract) -> DataFrame:
    """CSV with a header row under its declared schema, plus lineage.

    No inference, hence no extra pass. A cell that does not parse becomes null and is left to the
    row checks.
    """
    raw = spark.read.schema(extract.schema).csv(f"{folder}/{extract.name}.csv", header=True)
    return raw.withColumns(
        {
            "_bronze_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_batch_run_id": F.lit(run_id(spark)),
        }
    )


def read_extracts(
    spark: SparkSession, folder: str, extracts: Iterable[Extract] = EXTRACTS
) -> dict[str, DataFrame]:
    return {e.name: read_extract(spark, folder, e) for e in extracts}


def read_json_landing(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines below ``dt=YYYY-MM-DD`` folders; ``dt`` is a column and prunes folders."""
    schema = schema or struct_of(CLICKSTREAM_COLUMNS)
    with_day = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(with_day).json(folder)


def literal_rows(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A few rows given in Python. The schema is always stated: a column of nulls has no type."""
    ordered = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
    return spark.createDataFrame(ordered, schema)
