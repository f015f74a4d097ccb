"""Building blocks of the 0-100 scores. All are plain expressions and stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fading(elapsed: Column, scale: float) -> Column:
    """100 at zero elapsed time, falling by a factor of e every ``scale`` units."""
    return F.lit(100.0) * F.exp(-elapsed / F.lit(scale))


def share_of_cap(amount: Column, cap: Column) -> Column:
    """``amount`` as a percentage of ``cap``, never above 100."""
    return F.lit(100.0) * F.least(F.try_divide(amount, cap), F.lit(1.0))


def deadline_pressure(days_left: Column, days_needed: Column) -> Column:
    """100 once the deadline is reached, 0 while at least ``days_needed`` remain.

    ``try_divide`` yields null for zero or missing ``days_needed``; ``least`` skips nulls, so
    such a row scores 0 instead of failing under ANSI mode.
    """
    share = F.try_divide(F.greatest(days_left, F.lit(0)), days_needed)
    return F.lit(100.0) * (F.lit(1.0) - F.least(share, F.lit(1.0)))


def either(flag: Column, if_true: float, if_false: float) -> Column:
    return F.when(flag, F.lit(if_true)).otherwise(F.lit(if_false))


def blend(weights: dict[str, float]) -> Column:
    """Weighted sum of score columns, added in the order given."""
    total = None
    for column, weight in weights.items():
        term = F.lit(weight) * F.col(column)
        total = term if total is None else total + term
    return total


def net_of(added: Column, removed: Column, floor: float | int = 0.0) -> Column:
    return F.greatest(added - removed, F.lit(floor))
