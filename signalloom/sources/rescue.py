"""JSON lines that never fail: what does not fit the schema is kept beside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
WHOLE_LINE = "_line"


def rescued_json(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The fields of ``schema`` parsed from the JSON in ``value``, other columns kept.

    ``_rescued_data`` maps to their text the fields that are unknown or whose value does not
    parse as the declared type (the field itself is then null). A line that is no JSON object is
    rescued whole under ``_line``. The column is null when there is nothing to rescue. Each line
    is parsed once; fields are then cast out of the parsed map.
    """
    parsed = F.from_json(value, "map<string,string>")
    others = [c for c in lines.columns if c != value]
    with_map = lines.select(*others, F.col(value).alias("_text"), parsed.alias("_fields"))

    def typed(field: T.StructField) -> Column:
        return F.col("_fields")[field.name].try_cast(field.dataType)

    known = [f.name for f in schema.fields]
    checked = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]

    def unfit(key: Column, text: Column) -> Column:
        out = ~key.isin(known)
        for f in checked:
            out = out | ((key == f.name) & text.isNotNull() & text.try_cast(f.dataType).isNull())
        return out

    left_over = F.map_filter("_fields", unfit)
    rescued = F.when(
        F.col("_fields").isNull() & F.col("_text").isNotNull(), F.create_map(F.lit(WHOLE_LINE), F.col("_text"))
    ).when(F.size(left_over) > 0, left_over)
    return with_map.select(
        *others, *[typed(f).alias(f.name) for f in schema.fields], rescued.alias(RESCUED)
    )
