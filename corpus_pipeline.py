"""A training corpus from raw documents, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.llm import decontaminate, mixing, near_copies, pii, toxicity
from signalloom.llm.common import table
from signalloom.operators.staging import staged

SURROGATE_KEY = "corpus-pipeline"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; words are learned from the labelled ones among ``docs``."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return near_copies.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the new text."""
    kind = docs.schema["n_chars"].dataType
    changed = pii.pseudonymised(docs, SURROGATE_KEY)
    length = F.when(F.col("n_replaced") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many words of each document it takes, and from which slot on."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("source_mixing", mix_sources),
]

#: The stages learn a model, hash with XXH64 and draw keyed surrogates, none of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
