"""Registered queries of the reference's own operators, by name, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestream.plans import decisions, detection, entities, event_streams, quality_gates, records, redaction, relations, reviews, rewriting, streams, structure, text_rules, training_pairs, turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (entities, streams, decisions, structure, text_rules, event_streams, detection, quality_gates, training_pairs, relations, redaction, turns, rewriting, reviews, records):
    if twice := QUERIES.keys() & _module.QUERIES.keys():
        raise ValueError(f"registered twice: {sorted(twice)}")
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
