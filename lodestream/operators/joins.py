"""Joins that a plain equality does not express, bounded by bucketing or by a checked dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, left_id: str, right_id: str, tolerance_s: int, tie_s: int) -> DataFrame:
    """For each left row the right row of its key that is nearest in time, within the tolerance.

    Times within ``tie_s`` of the best are ties, won by the smallest right id.
    Right rows are dealt to buckets as wide as the tolerance and each left row
    looks into three, so the join stays an equality join for hot keys too.
    """
    bucket = lambda t: F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / tolerance_s)
    near = F.explode(F.array(*[bucket(left_time) + d for d in (-1, 0, 1)])).alias("_bucket")
    l = left.select(F.col(key), F.col(left_id), F.col(left_time), near)  # noqa: E741
    r = right.select(F.col(key), F.col(right_id), F.col(right_time), bucket(right_time).alias("_bucket"))
    micros = lambda t: F.unix_micros(F.col(t).cast("timestamp"))
    joined = l.join(r, [key, "_bucket"]).withColumn("gap_us", F.abs(micros(left_time) - micros(right_time))).filter(F.col("gap_us") <= tolerance_s * 1_000_000)
    best = F.min("gap_us").over(Window.partitionBy(left_id))
    ties = joined.withColumn("_best", best).filter(F.col("gap_us") <= F.col("_best") + tie_s * 1_000_000)
    return ties.groupBy(left_id).agg(F.min_by(F.struct(F.col(right_id), F.col("gap_us")), F.col(right_id)).alias("m")).select(left_id, F.col(f"m.{right_id}").alias(right_id), "m.gap_us")


def names_in_texts(texts: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """Which of a bounded list of names stand in each text (lower case, as substrings), with their first place.

    The list becomes an array literal that each row scans, so no pair of a text
    and a name that is not in it is ever a row.
    """
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    hits = F.array(*[F.struct(F.lit(n.lower()).alias("name"), F.instr(low, n.lower()).cast("long").alias("first_at")) for n in names])
    return texts.select(F.col(id_col), F.inline(F.filter(hits, lambda h: h["first_at"] > 0)))


def names_by_grams(texts: DataFrame, id_col: str, text_col: str, names: DataFrame) -> DataFrame:
    """The same for a table of any number of names (column name): id, name, first_at.

    Texts and names meet on the first three characters of a name (all of a
    shorter one), and the name is looked for only where these stand.  Names are
    lower-cased and taken once; empty ones are in no text.
    """
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    known = names.select(F.lower("name").alias("name")).filter("name <> ''").distinct().withColumn("_gram", F.substring("name", 1, 3))
    grams = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("_low") - (n - 1), F.lit(1))), lambda i: F.substring(F.col("_low"), i, F.lit(n)))
    sizes = [r["n"] for r in known.select(F.length("_gram").alias("n")).distinct().collect()]  # at most 1, 2 and 3
    if not sizes:
        sizes = [3]
    cut = texts.select(F.col(id_col), low.alias("_low"))
    index = cut.select(id_col, F.xxhash64("_low").alias("_text"), F.explode(F.array_distinct(F.concat(*[grams(n) for n in sizes]))).alias("_gram"))
    met = index.join(known, "_gram").select(id_col, "_text", "name").distinct()
    held = cut.select(F.col(id_col).alias("_id"), F.xxhash64("_low").alias("_key"), "_low").distinct()
    looked = met.join(held, met[id_col].eqNullSafe(held["_id"]) & (met["_text"] == held["_key"])).withColumn("first_at", F.instr(F.col("_low"), F.col("name")).cast("long"))
    return looked.filter("first_at > 0").select(id_col, "name", "first_at")


def keyword_overlap(texts: DataFrame, id_col: str, text_col: str, keywords: Column) -> DataFrame:
    """Share of a row's keywords that its text contains."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    hit = F.size(F.filter(keywords, lambda k: F.contains(low, k)))
    return texts.select(F.col(id_col), (hit / F.greatest(F.size(keywords), F.lit(1))).alias("overlap"))
