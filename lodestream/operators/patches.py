"""Edits of recorded streams, given as a table of patches and applied by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def apply_patches(rows: DataFrame, patches: DataFrame, by: list[str], line: str, role: str = "role", text: str = "text") -> DataFrame:
    """The rows (``by``, line, role, text) after all patches, numbered anew from 0.

    A patch has ``by``, ``seq`` (its place among a stream's patches), ``line``,
    ``op``, ``role`` and ``text``.  Ops: ``remove_event``; ``replace_text`` (the
    highest seq wins, a removal wins over it, a null text changes nothing); and
    ``insert_before`` (several in the order of seq, also before a removed line).
    Lines are those of the input, so patches need no order among lines and
    streams of any length are edited by joins.  Patches of lines that do not
    exist, and other ops, do nothing.  ``line`` must be unique within a stream.
    """
    key = [*by, line]
    p = patches.select(*by, F.col("line").alias(line), "seq", "op", F.col("role").alias("_role"), F.col("text").alias("_text"))
    replaces = (F.col("op") == "replace_text") & F.col("_text").isNotNull()
    edits = p.filter("op IN ('remove_event', 'replace_text')").groupBy(*key).agg(
        F.bool_or(F.col("op") == "remove_event").alias("_removed"),
        F.max_by(F.when(replaces, F.col("_text")), F.when(replaces, F.col("seq"))).alias("_new"),
    )
    edited = rows.select(*key, F.col(role).alias("role"), F.col(text).alias("text")).join(edits, key, "left")
    kept = edited.filter(~F.coalesce("_removed", F.lit(False))).select(*key, F.lit(1).alias("_slot"), F.lit(0).cast("long").alias("_seq"), "role", F.coalesce("_new", "text").alias("text"))
    inserts = p.filter("op = 'insert_before'").join(rows.select(*key), key, "left_semi")
    added = inserts.select(*key, F.lit(0).alias("_slot"), F.col("seq").cast("long").alias("_seq"), F.col("_role").alias("role"), F.col("_text").alias("text"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy(line, "_slot", "_seq"))
    return kept.union(added).select(*by, (n - 1).cast("long").alias("line"), "role", "text")


def consent_pair(lines: DataFrame, by: list[str], line: str, ask: str, answer: str) -> DataFrame:
    """Patches that put a question and its consent before each of the lines."""
    pair = F.array(*[F.struct(F.lit(i).cast("long").alias("seq"), F.lit(r).alias("role"), F.lit(t).alias("text")) for i, r, t in ((1, "assistant", ask), (2, "user", answer))])
    return lines.select(*by, F.col(line).alias("line"), F.lit("insert_before").alias("op"), F.inline(pair))
