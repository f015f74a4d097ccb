"""Bands, traffic lights and display labels of the report layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds (inclusive) and names of the score bands.
CART_BANDS = [(80, "🔴 Act now"), (60, "🟠 Today"), (40, "🟡 Monitor"), (None, "⚪ Low")]
ORDER_BANDS = [(80, "🔴 Escalate"), (60, "🟠 Watch"), (40, "🟡 Monitor"), (None, "⚪ Low")]
# On-time rate at or above which the light shows.
RATE_LIGHTS = [(0.95, "green"), (0.90, "amber"), (None, "red")]


def banded(score: Column, bands: list[tuple[float | None, str]]) -> Column:
    """Name of the highest band whose lower bound ``score`` reaches; a null score is in none but the last."""
    *bounded, (_, lowest) = bands
    out = None
    for bound, name in bounded:
        hit = score >= F.lit(bound)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(lowest)


def traffic_light(rate: Column) -> Column:
    """Light for a rate; no light when there is no rate."""
    return F.when(rate.isNotNull(), banded(rate, RATE_LIGHTS))


def percent_label(rate: Column, digits: int = 1) -> Column:
    """The rate in percent, rounded by its exact binary value as C's printf does; no label when there is no rate.

    ``format_string`` rounds the shortest decimal that stands for the number, and so rounds up what lies just below a half.
    """
    form = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", rate * F.lit(100.0), F.lit(form)), F.lit("%"))
