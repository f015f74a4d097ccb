"""Fields that a schema doesn't know: which there are, of what type, and their promotion to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that a field can be promoted to as they are; any other mix becomes text.
SCALARS = ("BOOLEAN", "BIGINT", "DOUBLE", "STRING", "DATE", "TIMESTAMP")


def _path(name: str) -> str:
    """Where a variant holds the field. Paths know no escapes, so a name with quotes of both kinds has none."""
    quote = next((q for q in "'\"" if q not in name), None)
    if quote is None:
        raise ValueError(f"no path to a field named {name}")
    return f"$[{quote}{name}{quote}]"


def _fields(lines: DataFrame, value: str) -> DataFrame:
    """(key, value) of the top-level fields of each JSON object, the value a variant; other lines have none."""
    parsed = lines.select(F.try_parse_json(F.col(value)).alias("_variant"))
    objects = parsed.where(F.schema_of_variant("_variant").startswith("OBJECT"))
    return objects.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("_variant").outer())).select("key", "value")


def unknown_fields(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """One row per field that the JSON in ``value`` has and ``schema`` has not: field, type, n_rows, n_nulls.

    ``type`` is the narrowest that holds all values (of numbers, decimals are as narrow as their digits allow), VARIANT
    where they have nothing in common and VOID where all are null. Each line is parsed once, and what is shuffled is a
    type and two counts per field and task, not the values.
    """
    known = [f.name for f in schema.fields]
    return (
        _fields(lines, value)
        .where(~F.col("key").isin(known))
        .groupBy(F.col("key").alias("field"))
        .agg(
            F.schema_of_variant_agg("value").alias("type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.is_variant_null("value")).alias("n_nulls"),
        )
    )


def promotable(report: DataFrame, least_rows: int = 1, most: int = 200) -> dict[str, str]:
    """Fields worth a column and their types: those with a value in ``least_rows`` rows, most frequent first.

    Objects, arrays and mixed types are kept as text, decimals become doubles, names
    with quotes of both kinds are passed over. At most ``most`` fields are named.
    """
    filled = F.col("n_rows") - F.col("n_nulls")
    has_path = ~(F.col("field").contains("'") & F.col("field").contains('"'))
    rows = report.where((filled >= least_rows) & has_path).orderBy(filled.desc(), "field").limit(most).collect()
    plain = lambda t: "DOUBLE" if t.startswith("DECIMAL") else t if t in SCALARS else "STRING"
    return {r["field"]: plain(r["type"]) for r in rows}


def promoted(lines: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """``lines`` with a column for each of ``fields``; null where a line lacks it or holds a value of another kind."""
    variant = F.try_parse_json(F.col(value))
    rows = lines.withColumn("_variant", variant)
    return rows.withColumns({n: F.try_variant_get("_variant", _path(n), t.lower()) for n, t in fields.items()}).drop("_variant")
