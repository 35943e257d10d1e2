"""Sensitive-value entities found in texts, and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions.patterns import level_rank, pattern_hits


def pattern_entities(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per pattern hit: id, label, level, hit, start (in characters, from 0), confidence.  Null texts have none."""
    return df.select(F.col(id_col), F.inline(pattern_hits(F.coalesce(F.col(text_col), F.lit("")))))


def merge_entities(entities: DataFrame, id_col: str) -> DataFrame:
    """Entities that agree in (lower-cased, trimmed) text and label become one: count, highest level and confidence, first place."""
    key = F.lower(F.trim("hit")).alias("value")
    return entities.groupBy(id_col, key, "label").agg(
        F.count("*").alias("n_hits"),
        F.max_by("level", level_rank(F.col("level"))).alias("level"),
        F.max("confidence").alias("confidence"),
        F.min("start").alias("start"),
    )


def merge_engines(entities: DataFrame, by: list[str]) -> DataFrame:
    """Detections of several engines merged by text and label: engines united and sorted, highest level and confidence, first text."""
    merged = entities.groupBy(*by, F.lower(F.trim("text")).alias("value"), "label").agg(
        F.array_join(F.array_sort(F.collect_set("engine")), ",").alias("engines"),
        F.max("level").alias("level"),
        F.max("confidence").alias("confidence"),
        F.min_by("text", F.struct("place", "text")).alias("text"),
    )
    return merged


def entity_summary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row of ``df`` with its number of entities, highest level (0 if none), flags and sorted labels; no shuffle."""
    hits = df.select(id_col, pattern_hits(F.coalesce(F.col(text_col), F.lit(""))).alias("_hits"))
    merged = F.array_distinct(F.transform("_hits", lambda h: F.struct(F.lower(F.trim(h["hit"])), h["label"])))
    ranks = F.transform("_hits", lambda h: level_rank(h["level"]))
    return hits.select(
        id_col,
        F.size(merged).cast("long").alias("n_entities"),
        F.coalesce(F.array_max(ranks), F.lit(0)).alias("max_level"),
        F.exists("_hits", lambda h: h["level"] == "L3").alias("has_l3"),
        F.exists("_hits", lambda h: h["level"] == "L4").alias("has_l4"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["label"]))), ",").alias("labels"),
    )
