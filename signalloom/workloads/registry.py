"""Registered queries: a Spark callable over a folder of tables, and the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Workload:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


MONEY_SUMS = {
    "recoverable_revenue",
    "delayed_order_revenue_risk",
    "recoverable_revenue_trailing",
    "delayed_order_revenue_risk_trailing",
    "d1",
    "d7",
    "d30",
}

WORKLOADS: dict[str, Workload] = {}


def workload(sql: str | None = None):
    """Register a function under its own name."""

    def add(fn):
        WORKLOADS[fn.__name__] = Workload(fn.__name__, fn, sql)
        return fn

    return add


def presented(df: DataFrame) -> DataFrame:
    """Plain scalar columns that compare exactly across engines.

    Times and dates become text, doubles keep six digits, sums of money two (more would show the
    order of addition), arrays become comma-separated text.
    """

    def plain(field: T.StructField):
        c = F.col(field.name)
        match field.dataType:
            case T.TimestampType() | T.TimestampNTZType():
                return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            case T.DateType():
                return F.date_format(c, "yyyy-MM-dd")
            case T.DoubleType():
                return F.round(c, 2 if field.name in MONEY_SUMS else 6)
            case T.ArrayType():
                return F.array_join(c, ",")
        return c

    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields])


# Formatting snippets for the SQL side.


def sql_time(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def sql_day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"
