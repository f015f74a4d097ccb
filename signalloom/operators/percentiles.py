"""Percentiles: the approximate sketch, and exact ones that never gather a column in one task.

Spark's exact ``percentile`` and ``percentile_disc`` keep one count per distinct value of a
group in a single aggregation buffer, which for a whole-table percentile is one task holding
every distinct value. Here a sketch first brackets the wanted rank (its error is bounded by
``1 / accuracy`` of the rows), and only the values inside the bracket, grouped by value, are looked at
further. A bracket that still holds too many values for one task is cut by splitters and narrowed to the
pieces that hold the rank, until it fits. All passes aggregate before they shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from signalloom.operators.staging import broadcast_if_small, staged, staged_with_size

ACCURACY = 10_000
#: Distinct values of a group that one task puts in order, and pieces that a larger bracket is cut into.
BRACKET_VALUES, PIECES = 1_000_000, 64


def percentile(
    df: DataFrame,
    value: str,
    p: float,
    *,
    by: Sequence[str] = (),
    method: str = "approx",
    name: str = "q",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group (one row in all without ``by``) with the ``p`` percentile of ``value``.

    * ``approx``: a value of the column whose rank is off by at most ``rows / accuracy``.
    * ``discrete``: exact, the smallest value that at least a share ``p`` of the rows do not exceed.
    * ``continuous``: exact, interpolated between the two neighbouring values.

    Null values are ignored; without any value the result is null. The exact methods read ``df``
    three times: pass a written table. ``by`` is for few groups (days, carriers): their brackets
    are written and joined back, as a broadcast when their measured size allows it. Null
    is a group like any other.
    """
    values = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    if method == "approx":
        return values.groupBy(*by).agg(F.percentile_approx("_v", p, accuracy).alias(name))
    if method not in ("discrete", "continuous"):
        raise ValueError(f"unknown percentile method: {method}")

    margin = 4.0 / accuracy
    sketch = values.groupBy(*by).agg(
        F.percentile_approx("_v", [max(p - margin, 0.0), min(p + margin, 1.0)], accuracy).alias("_e"),
        F.count("_v").alias("_n"),
    )
    edges = sketch.select(*by, "_n", F.col("_e")[0].alias("_lo"), F.col("_e")[1].alias("_hi"))

    # One value further out on each side, so that the bracket also holds the neighbours.
    widened = _beside(values, edges, by, ("_n", "_lo", "_hi")).groupBy(*by).agg(
        F.first("_n").alias("_n"),
        F.coalesce(F.max(F.when(F.col("_v") < F.col("_lo"), F.col("_v"))), F.first("_lo")).alias("_from"),
        F.coalesce(F.min(F.when(F.col("_v") > F.col("_hi"), F.col("_v"))), F.first("_hi")).alias("_to"),
    )
    counted = _beside(values, widened, by, ("_n", "_from", "_to"))
    in_bracket = F.col("_v").between(F.col("_from"), F.col("_to"))
    # Values below the bracket fold into a single row per group that carries only their number.
    weights = (
        counted.where(F.col("_v") <= F.col("_to"))
        .groupBy(*by, F.when(in_bracket, F.col("_v")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_w"), F.first("_n").alias("_n"))
    )
    n = F.col("_n")
    position = (n - F.lit(1)) * F.lit(p)
    below = F.floor(position)
    if method == "discrete":
        lower = upper = F.greatest(F.ceil(n * F.lit(p)), F.lit(1))
    else:
        lower, upper = below + 1, F.ceil(position) + 1
    ranked = _narrowed(weights, by, lower, upper).withColumn("_upto", _running(by, F.col("_v").asc_nulls_first()))
    if method == "discrete":
        return ranked.groupBy(*by).agg(_at_rank(lower).alias(name))
    ends = ranked.groupBy(*by).agg(
        _at_rank(lower).alias("_a"),
        _at_rank(upper).alias("_b"),
        F.first(position - below).alias("_f"),
    )
    return ends.select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias(name))


def _running(by: Sequence[str], order: Column) -> Column:
    """Sum of ``_w`` up to each row, within the group."""
    along = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order)
    return F.sum("_w").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _narrowed(weights: DataFrame, by: Sequence[str], lower: Column, upper: Column) -> DataFrame:
    """``weights`` (by, _v, _w, _n) written, with no more than ``BRACKET_VALUES`` values in a group.

    Each round takes splitters out of a group's values, adds up the rows of the pieces between them, and keeps the
    pieces that hold the ranks ``lower`` to ``upper``; what lies below them joins the row without a value. A round
    leaves about one piece in ``PIECES``, whatever the distribution and the type of the values.
    """
    keys = [*by, "_v", "_w", "_n"]
    while True:
        size = Observation()
        weights = staged(weights.select(*keys).observe(size, F.count("_v").alias("values")), "bracket")
        if size.get["values"] <= BRACKET_VALUES:
            return weights
        per_group = weights.groupBy(*by).agg(F.count("_v").alias("_values"))
        if per_group.agg(F.max("_values").alias("m")).first()["m"] <= BRACKET_VALUES:
            return weights
        points = [i / PIECES for i in range(1, PIECES)]
        splitters = weights.where("_v IS NOT NULL").groupBy(*by).agg(F.percentile_approx("_v", points, ACCURACY).alias("_e"))
        piece = F.when(F.col("_v").isNotNull(), F.size(F.filter("_e", lambda e: e < F.col("_v")))).otherwise(-1)
        pieces = (
            _beside(weights, splitters, by, ("_e",), kept=("_v", "_w", "_n"))
            .groupBy(*by, piece.alias("_piece"))
            .agg(F.sum("_w").alias("_w"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.first("_n").alias("_n"))
            .withColumn("_upto", _running(by, F.col("_piece")))
        )
        holding = pieces.where((F.col("_piece") >= 0) & (F.col("_upto") >= lower) & (F.col("_upto") - F.col("_w") < upper))
        bounds = holding.groupBy(*by).agg(F.min("_low").alias("_from"), F.max("_high").alias("_to"))
        inside = F.col("_v").between(F.col("_from"), F.col("_to"))
        weights = (
            _beside(weights, bounds, by, ("_from", "_to"), kept=("_v", "_w", "_n"))
            .where(F.col("_v").isNull() | (F.col("_v") <= F.col("_to")))
            .groupBy(*by, F.when(inside, F.col("_v")).alias("_v"))
            .agg(F.sum("_w").alias("_w"), F.first("_n").alias("_n"))
        )


def _beside(
    values: DataFrame, per_group: DataFrame, by: Sequence[str], columns: Sequence[str], kept: Sequence[str] = ("_v",)
) -> DataFrame:
    """``values`` with the columns of their group's row."""
    if by:
        named = per_group.select(*[F.col(g).alias(f"_g_{g}") for g in by], *columns)
        same_group = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in by])
        joined = values.join(broadcast_if_small(*staged_with_size(named, "brackets")), same_group)
        return joined.select(*by, *kept, *columns)
    one_row = per_group.select(F.struct(*columns).alias("_s")).scalar()
    return values.withColumn("_s", one_row).select(*kept, *[F.col(f"_s.{c}").alias(c) for c in columns])


def _at_rank(rank: Column) -> Column:
    """Smallest bracket value whose cumulative weight reaches ``rank``.

    Reaching the rank below the bracket would mean that the sketch broke its error bound; that
    is reported rather than answered wrongly.
    """
    reached = F.col("_upto") >= rank
    inside = F.min(F.when(reached, F.col("_v")))
    missed = F.bool_or(reached & F.col("_v").isNull()) | (inside.isNull() & (F.count(F.lit(1)) > 0))
    return F.when(missed, F.raise_error(F.lit("percentile bracket misses the wanted rank"))).otherwise(inside)
