"""Normal forms of the text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code(column: str) -> Column:
    """Identifier that producers send in any case and with stray blanks."""
    return F.upper(F.trim(column))


def tidy(column: str) -> Column:
    """Case-sensitive identifier with stray blanks removed."""
    return F.trim(column)


def label(column: str) -> Column:
    """Free-case category label."""
    return F.lower(F.trim(column))
