"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalloom.llm import (
    conversations,
    decontaminate,
    fingerprints,
    html_text,
    mixing,
    pii,
    quality,
    ranked_search,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from signalloom.llm.common import table
from signalloom.workloads.registry import Workload

QUERIES: dict[str, Workload] = {}
#: Surrogates depend on a key; a deployment brings its own.
SURROGATE_KEY = "registered-query"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = Workload(fn.__name__, fn, sql)
        return fn

    return add


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    q AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
    holder AS (
      SELECT payload_bytes, payload_digest, max(page_id) AS holder FROM q WHERE payload_bytes >= 1000 GROUP BY ALL
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id < holder THEN holder END AS refers_to
    FROM q LEFT JOIN holder USING (payload_bytes, payload_digest)
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query()
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query()
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query()
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.pseudonymised(documents, SURROGATE_KEY).select("doc_id", "text", "n_replaced")


@query()
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH words AS (
      SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents
    ),
    docs AS (SELECT row, doc_id, len(terms) AS n, terms FROM words WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM docs),
    tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY ALL),
    asked AS (
      SELECT DISTINCT item, item_id, term FROM (
        SELECT row_number() OVER () AS item, item_id,
          unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
      )
    ),
    weights AS (
      SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, big_n
    ),
    scored AS (
      SELECT item, item_id, row, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
      FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (row), totals
      GROUP BY item, item_id, row, doc_id
    ),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
    """
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digest(table(spark, sf_dir, "conversations"))


@query()
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))
