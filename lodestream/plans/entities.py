"""Queries on sensitive-value entities; the oracle writes the patterns out by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators import entities


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pii_pattern_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entities.pattern_entities(_documents(spark, sf_dir), "doc_id", "text")
    return entities.merge_entities(found, "doc_id")


def pii_doc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.entity_summary(_documents(spark, sf_dir), "doc_id", "text")


def pii_label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    both = _documents(spark, sf_dir).select("text").union(pages.select("html")).withColumn("id", F.lit(0))
    found = entities.pattern_entities(both, "id", "text")
    return found.groupBy("label", "level").agg(F.count("*").alias("n_hits"))


QUERIES = {"pii_pattern_entities": pii_pattern_entities, "pii_doc_summary": pii_doc_summary, "pii_label_histogram": pii_label_histogram}

#: label, level, pattern, confidence, in the order in which redaction applies them.
ORACLE_RULES = (
    ("ID_EMAIL", "L2", r"[\w.+-]+@[\w-]+\.[\w.-]+", 0.95),
    ("ID_PHONE", "L2", r"\b(?:\+?[0-9]{1,3}[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b", 0.85),
    ("GOV_SSN_FULL", "L4", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.95),
    ("HEALTH_INSURANCE_ID", "L2", r"(?i)\b(?:uhc|bcbs|aetna|cigna|kaiser|humana)[\s-]?\w*[\s-]?[0-9][0-9-]{5,}\b", 0.85),
    ("FIN_CARD_FULL", "L4", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", 0.8),
    ("NET_IP", "L1", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", 0.7),
    ("SEC_PASSWORD", "L4", r"(?:password|passwd|pwd|token|secret|api_key)\s*[=:]\s*\S{4,}", 0.9),
)


def hits_sql(table: str, key: str, text: str) -> str:
    """DuckDB: all hits of all rules, as rows with their starts."""
    return " UNION ALL ".join(
        f"SELECT {key}, '{label}' AS label, '{level}' AS level, hits[i] AS hit, list_sum(list_transform(parts[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i-1], lambda x: length(x))), 0) AS start, {confidence}::DOUBLE AS confidence"
        f" FROM (SELECT {key}, parts, hits, unnest(generate_series(1, len(hits))) AS i FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS hits, regexp_split_to_array({text}, '{pattern}') AS parts FROM {table}))"
        for label, level, pattern, confidence in ORACLE_RULES
    )


_RANK = "CASE level WHEN 'L1' THEN 1 WHEN 'L2' THEN 2 WHEN 'L3' THEN 3 WHEN 'L4' THEN 4 ELSE 0 END"
_MERGED = f"SELECT doc_id, lower(trim(hit)) AS value, label, count(*) AS n_hits, max(level) AS level, max(confidence) AS confidence, min(start)::INT AS start FROM ({hits_sql('documents', 'doc_id', 'text')}) GROUP BY ALL"
ORACLE_SQL = {
    "pii_pattern_entities": _MERGED,
    "pii_doc_summary": f"""
        SELECT d.doc_id, coalesce(n, 0) AS n_entities, coalesce(m, 0)::INT AS max_level, coalesce(l3, false) AS has_l3, coalesce(l4, false) AS has_l4, coalesce(l, '') AS labels
        FROM documents d LEFT JOIN (
          SELECT doc_id, count(*) AS n, max({_RANK}) AS m, bool_or(level = 'L3') AS l3, bool_or(level = 'L4') AS l4, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM ({_MERGED}) GROUP BY doc_id
        ) e USING (doc_id)""",
    "pii_label_histogram": f"SELECT label, level, count(*) AS n_hits FROM ({hits_sql('(SELECT 0 AS z, text FROM documents UNION ALL SELECT 0, html FROM pages)', 'z', 'text')}) GROUP BY ALL",
}
