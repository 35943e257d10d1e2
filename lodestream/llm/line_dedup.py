"""Cross-site line deduplication, in DataFrame functions only.

Lines are told apart by a 96-bit hash.  HyperLogLog sketches of the sites that
a line stands on merge by aggregation (map-side first, so a line that is in a
third of all documents is a few sketches when it is shuffled).  Lines whose
estimate is near the threshold get an exact distinct count.  Lines on
``min_sites`` sites or more are boilerplate and are removed from all documents
but the one with the smallest id, so that nothing vanishes from the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import beside, cut_lineage, row_key, text_of


def _lines(df: DataFrame) -> DataFrame:
    """One row per line that has a word: row key, id, position, site and the line's hash (of the trimmed line)."""
    lines = F.split(F.col("text"), "\n")
    flat = df.select("doc_id", "_key", "site", F.posexplode(lines).alias("pos", "line"))
    line = F.regexp_replace(F.col("line"), r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return flat.withColumn("line", line).filter(F.col("line") != "").select("doc_id", "_key", "site", "pos", F.xxhash64("line").alias("h"), F.crc32(F.col("line").cast("binary")).alias("c"))


def boilerplate_hits(lines: DataFrame, min_sites: int, margin: float, lg_k: int, broadcast_lines: int) -> DataFrame:
    """The rows of ``lines`` that stand on at least ``min_sites`` sites, with ``first_doc``, the smallest doc_id that has the line.

    Sketches leave the lines whose estimate reaches the threshold less
    ``margin``; the places where these stand are written once, and both the
    exact counts of near-threshold lines and the result are read from them.
    """
    site = F.xxhash64(F.coalesce(F.col("site"), F.lit("<null>")))
    sketched = lines.groupBy("h", "c").agg(F.hll_sketch_agg(site, lg_k).alias("sketch"), F.min("doc_id").alias("first_doc"))
    spread = sketched.select("h", "c", "first_doc", F.hll_sketch_estimate("sketch").alias("estimate"))
    spread = cut_lineage(spread.filter(F.col("estimate") >= min_sites * (1 - margin)))
    places = cut_lineage(lines.join(beside(spread, broadcast_lines), ["h", "c"]).select("h", "c", "doc_id", "_key", "pos", "first_doc", "estimate", site.alias("s")))
    sure = F.col("estimate") > min_sites * (1 + margin)
    exact = places.filter(~sure).select("h", "c", "s").distinct().groupBy("h", "c").agg(F.count("*").alias("n_sites")).filter(F.col("n_sites") >= min_sites)
    near = places.filter(~sure).join(exact.select("h", "c"), ["h", "c"], "left_semi")
    return places.filter(sure).unionByName(near)


def remove_boilerplate(
    df: DataFrame,
    min_sites: int = 10,
    margin: float = 0.25,
    lg_k: int = 12,
    broadcast_lines: int = 200_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """All rows and columns of ``df``, with ``text_col`` cleaned, plus ``n_lines`` and ``n_removed``.

    Columns of ``df`` with one of these two names (in any case) give way to them.

    ``margin`` is many times the sketches' error at ``lg_k``, so the result is
    that of exact counts.  White space around a line and blank lines don't
    count; blank lines stay.  A null text stays null with no lines; a null
    site is a site of its own, and a null id is no document's smallest, so all
    its copies of a line go if another row has it.  Repeated rows are cleaned
    alike.  An empty table gives no rows.  Up to ``broadcast_lines`` lines
    (counted first) are broadcast to find where they stand; more are joined
    by a shuffle of line hashes.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_col).alias("doc_id"), F.col(site_col).cast("string").alias("site"), text_of(text_col).alias("text"), row_key(id_col, text_col).alias("_key"))
    hits = boilerplate_hits(_lines(rows.drop("_row")), min_sites, margin, lg_k, broadcast_lines).filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    removed = hits.groupBy(F.col("doc_id").alias("_hit"), F.col("_key").alias("_hit_key")).agg(F.collect_set("pos").alias("gone"))
    n_lines = F.size(F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0))
    joined = rows.join(removed, rows["doc_id"].eqNullSafe(removed["_hit"]) & (rows["_key"] == removed["_hit_key"]), "left")
    cleaned = F.when(F.col("gone").isNull(), F.col("_row")[text_col]).otherwise(_without(F.split(F.col("text"), "\n"), F.col("gone")))
    kept = [F.col("_row")[c].alias(c) if c != text_col else cleaned.alias(c) for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    return joined.select(*kept, n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def _without(lines: Column, gone: Column) -> Column:
    """The lines at other positions than ``gone``, joined again; linear in the lines."""
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.transform(F.array(lines), lambda held: F.array_join(F.transform(left, lambda i: held[i]), "\n"))[0]
