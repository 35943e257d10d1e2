"""Structural checks of event streams, their merge into a verdict, and redaction of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.patterns import NEEDS, RULES
from lodestream.operators.ordered_state import so_far


def issues(df: DataFrame, keep: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row (``keep``, code) for each rule that a row breaks, from one pass over the rows."""
    codes = F.array_compact(F.array(*[F.when(broken, F.lit(code)) for code, broken in rules.items()]))
    return df.select(*keep, codes.alias("_codes")).select(*keep, F.explode("_codes").alias("code"))


def is_later_copy(key: list[str], order: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) > 1


def repeats(value: Column, wanted: str, by: list[str], order: list[str]) -> Column:
    """Whether this row and the one before it both have the wanted value."""
    return (value == wanted) & (F.lag(value).over(Window.partitionBy(*by).orderBy(*order)) == wanted)


def none_before(row: Column, wanted: Column, by: list[str], order: list[str]) -> Column:
    """Whether ``row`` holds though no row so far was ``wanted`` (a result without its call)."""
    return row & (F.coalesce(F.max(wanted.cast("int")).over(so_far(by, order)), F.lit(0)) == 0)


def verdicts(found: DataFrame, severities: dict[str, str], by: list[str]) -> DataFrame:
    """The verdict of each group with issues: FAIL with a score of at most 2 after a critical or major one, else MINOR_ISSUES and 4."""
    pairs = [F.lit(x) for item in severities.items() for x in item]
    grave = F.bool_or(F.coalesce(F.create_map(*pairs)[F.col("code")], F.lit("minor")).isin("critical", "major"))
    merged = found.groupBy(*by).agg(F.count("*").alias("n_issues"), F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"), grave.alias("_grave"))
    return merged.select(*by, "n_issues", "codes", F.when(F.col("_grave"), "FAIL").otherwise("MINOR_ISSUES").alias("verdict"), F.when(F.col("_grave"), 2).otherwise(4).alias("score"))


def redact(text: Column) -> Column:
    """The text with every pattern hit replaced by its label, rule after rule; null stays null."""
    for label, _, pattern, _ in RULES:
        text = F.when(NEEDS[label](text), F.regexp_replace(text, pattern, f"[{label}]")).otherwise(text)
    return text
