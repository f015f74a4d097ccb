"""Declarative row checks: every input row comes out exactly once, clean or quarantined."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.clock import AsOf, days, instant, minutes
from signalloom.model import EventNames, OrderStates
from signalloom.operators.joins import lookup
from signalloom.operators.staging import staging_path

FAIL, WARN = "fail", "warn"
REASONS, WARNINGS = "_dq_fail_reasons", "_dq_warnings"
CLEAN_FOLDER = "_clean=true"


@dataclass(frozen=True)
class Rule:
    """A named check. ``violated`` is true for a bad row; null counts as not violated."""

    name: str
    violated: Column
    severity: str = FAIL

    def __post_init__(self):
        if self.severity not in (FAIL, WARN):
            raise ValueError(f"rule {self.name}: severity must be fail or warn, not {self.severity!r}")


# Predicates. Each is true for a row that breaks the expectation.


def any_null(*columns: str) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def below_zero(column: str) -> Column:
    """Negative; a null is not negative."""
    return F.coalesce(F.col(column) < 0, F.lit(False))


def outside_clock_skew(
    column: str, as_of: AsOf = None, past_days: int = 1, future_minutes: int = 5
) -> Column:
    """Missing, or not within ``[as_of - past_days, as_of + future_minutes]``.

    ``as_of`` may be a column of the row, such as its time of ingestion.
    """
    at, now = F.col(column), instant(as_of)
    return at.isNull() | ~at.between(now - days(past_days), now + minutes(future_minutes))


def required_when(needed: Column, column: str) -> Column:
    return needed & F.col(column).isNull()


def priced_when(needed: Column, column: str) -> Column:
    """A price is needed and is missing or negative."""
    return needed & (any_null(column) | below_zero(column))


# Evaluation.


def tag(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``df`` plus the names of the broken fail rules and of the broken warn rules, one array each."""
    rules = list(rules)

    def broken(severity: str) -> Column:
        names = [
            F.when(F.coalesce(r.violated, F.lit(False)), F.lit(r.name)) for r in rules if r.severity == severity
        ]
        return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")

    return df.withColumns({REASONS: broken(FAIL), WARNINGS: broken(WARN)})


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) == 0).drop(REASONS)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) > 0).drop(WARNINGS)


def split(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Clean rows (with their warnings) and quarantined rows (with their reasons)."""
    tagged = tag(df, rules)
    return clean_rows(tagged), quarantined_rows(tagged)


def split_once(df: DataFrame, rules: Iterable[Rule], label: str) -> tuple[DataFrame, DataFrame]:
    """As ``split``, but the input is read and checked a single time.

    The tagged rows are written to the shared folder in one directory per verdict; each side
    then reads its own directory only.
    """
    return write_checked(tag(df, rules), staging_path(df.sparkSession, label))


def write_checked(tagged: DataFrame, path: str, by: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Write tagged rows below ``path``, clean ones in ``CLEAN_FOLDER``, both by ``by``; the two sides as read from there."""
    checked = tagged.withColumn("_clean", F.size(REASONS) == 0)
    checked.write.partitionBy("_clean", *by).parquet(path)
    stored = tagged.sparkSession.read.schema(checked.schema).parquet(path)
    return (
        stored.where(F.col("_clean")).drop("_clean", REASONS),
        stored.where(~F.col("_clean")).drop("_clean", WARNINGS),
    )


def orphans(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set but not among ``known``, with the reason ``orphan_<key>``."""
    lost = df.where(F.col(key).isNotNull()).join(known.select(key), key, "left_anti")
    return lost.withColumn(REASONS, F.array(F.lit(f"orphan_{key}")))


def with_orphan_flag(df: DataFrame, known: DataFrame, key: str, spread: str, flag: str) -> DataFrame:
    """``df`` with a column that is true where the key is set but not among ``known``, which has each key once.

    Rows without the key are joined on ``spread``, a column of many values.
    """
    found = lookup(df, known.select(key, F.lit(True).alias(flag)), key, spread)
    return found.withColumn(flag, F.col(key).isNotNull() & F.col(flag).isNull())


def referenced(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``known``."""
    return df.join(known.select(key), key, "left_semi")


def rule_counts(tagged: DataFrame) -> DataFrame:
    """Number of rows that broke each rule, with the rule's severity."""
    broken = F.concat(
        F.transform(REASONS, lambda r: F.struct(F.lit(FAIL).alias("severity"), r.alias("rule"))),
        F.transform(WARNINGS, lambda r: F.struct(F.lit(WARN).alias("severity"), r.alias("rule"))),
    )
    return (
        tagged.select(F.explode(broken).alias("b"))
        .groupBy("b.severity", "b.rule")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def pass_rate(tagged: DataFrame) -> DataFrame:
    """One row: rows checked, rows clean, and the share of clean rows (null without rows)."""
    return tagged.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(REASONS) == 0).alias("n_clean")
    ).withColumn("pass_rate", F.try_divide(F.col("n_clean"), F.col("n_rows")))


# Rule sets of the retail tables.


def clickstream_rules(
    as_of: AsOf = None, names: EventNames = EventNames(), past_days: int = 1, future_minutes: int = 5
) -> list[Rule]:
    kind = F.col("event_type")
    return [
        Rule("missing_session_id", any_null("session_id")),
        Rule("missing_cart_id_for_cart_event", required_when(kind.isin(*names.cart), "cart_id")),
        Rule(
            "invalid_event_timestamp",
            outside_clock_skew("event_timestamp", as_of, past_days, future_minutes),
        ),
        Rule("bad_price_at_event", priced_when(kind.isin(*names.priced), "price_at_event")),
    ]


def event_id_rule() -> Rule:
    """For rows that are merged by their id: without one a resent row can't be told from the first."""
    return Rule("missing_event_id", any_null("event_id"))


def order_rules(states: OrderStates = OrderStates()) -> list[Rule]:
    not_cancelled = F.col("status") != states.cancelled
    return [
        Rule("missing_order_total", any_null("order_total_usd")),
        Rule("negative_order_total", below_zero("order_total_usd")),
        Rule("missing_fx_rate", any_null("fx_rate_to_usd")),
        Rule(
            "missing_promised_delivery_date", required_when(not_cancelled, "promised_delivery_date"), WARN
        ),
    ]


def order_clock_rule(as_of: AsOf = None, past_days: int = 1, future_minutes: int = 5) -> Rule:
    """Clock-skew check of the order time; kept apart because a history load would fail it."""
    return Rule(
        "invalid_order_created_at",
        outside_clock_skew("order_created_at", as_of, past_days, future_minutes),
    )


def order_item_rules() -> list[Rule]:
    return [
        Rule("non_positive_qty", any_null("qty") | (F.col("qty") <= 0)),
        Rule("negative_unit_price", any_null("unit_price") | below_zero("unit_price")),
    ]


def product_rules() -> list[Rule]:
    return [Rule("negative_price", any_null("price") | below_zero("price"))]


def inventory_rules() -> list[Rule]:
    return [Rule("negative_on_hand_qty", below_zero("on_hand_qty"))]
