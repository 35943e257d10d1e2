"""The registered queries of the training-data operators; each derives its digest columns from its operator's rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import bpe, graph_index, html_extract, langid, line_dedup, media, packing, periodic_runs, pii, quality, simhash, suffix_dedup, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_corpus(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode_corpus(encoded, ranks).select(
        "doc_id",
        "n_tokens",
        _sha256(F.col("ids_text")).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )



def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.fingerprint_media(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        "payload_sha256",
        "tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        _sha256(F.col("media")).alias("media_sha256"),
        F.concat_ws(":", F.size("hashes"), F.hex(F.xxhash64("times", "hashes"))).alias("feature"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(_table(spark, sf_dir, "documents")).drop("host_rate")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = langid.predict(documents, langid.train(documents))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _joined(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    counted = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(counted, pii.BASE_KINDS), _sha256(_joined("base")).alias("base_sha256"), _joined("spans").alias("spans"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", _sha256(F.col("kept")).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", _sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.plant_tails(_table(spark, sf_dir, "documents")))
    # longest first, then smallest start, then smallest period
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        _sha256(F.array_join(lines, "")).alias("runs_sha256"),
        _sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(_table(spark, sf_dir, "embeddings"))


def op13_graph_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_index.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_html": op2_html,
    "op3_media": op3_media,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_pii": op8_pii,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_graph_index": op13_graph_index,
}

#: Words and lines, as in the operators: DuckDB's patterns have the same classes.
_OP5 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), g AS (
  SELECT doc_id, generate_subscripts(words, 1) AS p, words FROM d WHERE len(words) >= 3
), windows AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS w FROM g WHERE p <= len(words) - 2
), doubled AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM doubled WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, source, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM b GROUP BY source
), prior AS (
  SELECT avg(f / n) AS m, coalesce(var_pop(f / n), 0) AS v FROM hosts
), verdicts AS (
  SELECT source, (f + m * s) / (n + s) > 0.8 AS rejected
  FROM (SELECT hosts.*, m, CASE WHEN v > 0 THEN greatest(1, m * (1 - m) / v - 1) ELSE 1 END AS s FROM hosts, prior)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM b JOIN verdicts ON b.source IS NOT DISTINCT FROM verdicts.source
"""

_OP10 = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p
  FROM documents
), t AS (
  SELECT *, regexp_replace(line, '\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g') AS k FROM l
), spread AS (
  SELECT k, min(doc_id) AS first_doc FROM t WHERE k <> '' GROUP BY k HAVING count(DISTINCT coalesce(source, '<null>')) >= 10
), marked AS (
  SELECT t.*, spread.k IS NOT NULL AND doc_id <> first_doc AS gone FROM t LEFT JOIN spread ON t.k = spread.k
)
SELECT doc_id, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE_SQL: dict[str, str] = {"op5_quality": _OP5, "op10_line_dedup": _OP10}
