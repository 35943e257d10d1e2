"""Queries on structural checks, semi joins, redaction, times and the streaming latch."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators import entities, patches, structure
from lodestream.plans.entities import ORACLE_RULES, hits_sql
from lodestream.plans.standin import CALLS_SQL, calls
from lodestream.plans.stream import STREAM_SQL, stream
from lodestream.streaming import latch

#: Severity by code; codes that are not here are minor (a convention for the stand-in).
SEVERITY = {"orphan_tool_result": "critical", "duplicate_event_id": "major"}
_BY, _ORDER = ["submission"], ["pos"]


def structural_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    rules = {
        "duplicate_event_id": structure.is_later_copy(["submission", "props"], _ORDER),
        "consecutive_assistant_messages": structure.repeats(kind, "click", _BY, _ORDER),
        "orphan_tool_result": structure.none_before(kind == "purchase", kind == "view", _BY, _ORDER),
        "empty_assistant_message": F.col("value") < 1,
    }
    return structure.issues(calls(spark, sf_dir), ["submission", "pos"], rules)


def gate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.verdicts(structural_issues(spark, sf_dir), SEVERITY, ["submission"])


def orphan_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    return c.filter("event_type = 'error'").join(c.filter("event_type = 'signup'").select("submission", "props"), ["submission", "props"], "left_anti").select("event_id", "submission")


def passing_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return docs.join(labels.filter("quality = 1 AND toxic = 0"), "doc_id", "left_semi").select("doc_id", "lang")


def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", structure.redact(F.col("text")).alias("redacted"))


def streaming_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latch of ``latch_state`` as a stateful stream; its tables go to the shared checkpoint folder."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="stream-")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A stream takes a single file only through a glob.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{sf_dir}/event[s].parquet")
    path = f"{base}/latch-{uuid.uuid4().hex}"
    step = latch.latch_into(path, "user_id", ["ts", "event_id"], "error", "signup", "event_id", "event_type")
    found = latch.run_once(stream.select("event_id", "user_id", "ts", "event_type"), path, step, "event_id long, pending long, late boolean")
    return found.select("event_id", "pending")


def patched_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consent pairs before long answers; short turns removed; user turns that hold a number replaced."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    size, none = F.length("text"), F.lit(None).cast("string")
    edit = lambda match, op, text: turns.filter(match).select("conv_id", F.col("turn").alias("line"), F.lit(op).alias("op"), F.lit(1).cast("long").alias("seq"), none.alias("role"), text.alias("text"))
    edits = patches.consent_pair(turns.filter((F.col("role") == "assistant") & (size > 400)), ["conv_id"], "turn", "May I go on?", "Yes.")
    edits = edits.unionByName(edit(size < 60, "remove_event", none)).unionByName(edit((F.col("role") == "user") & F.col("text").rlike("[0-9]"), "replace_text", F.lit("[REDACTED]")))
    return patches.apply_patches(turns, edits, ["conv_id"], "turn")


def entity_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values found in a user turn that a later assistant turn of the conversation repeats, with the first such turn."""
    return _reuse(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def value_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the stand-in streams."""
    return _reuse(stream(spark, sf_dir).select(F.col("submission").alias("conv_id"), F.col("pos").alias("turn"), "role", "text"))


def _reuse(turns: DataFrame) -> DataFrame:
    found = entities.pattern_entities(turns.select(F.struct("conv_id", "turn", "role").alias("at"), "text"), "at", "text").select("at.*", "label", F.lower(F.trim("hit")).alias("value"))
    said = found.groupBy("conv_id", "label", "value").agg(F.min(F.when(F.col("role") == "user", F.col("turn"))).alias("said_at"), F.array_sort(F.collect_set(F.when(F.col("role") == "assistant", F.col("turn")))).alias("_answers"))
    later = F.get(F.filter("_answers", lambda t: t > F.col("said_at")), F.lit(0))
    return said.select("conv_id", "label", "value", "said_at", later.alias("repeated_at")).filter("repeated_at IS NOT NULL")


QUERIES = {f.__name__: f for f in (structural_issues, gate_verdicts, orphan_results, passing_semi, redact_documents, streaming_latch, patched_conversations, entity_reuse, value_reuse)}

_RUN = "OVER (PARTITION BY submission ORDER BY pos ROWS UNBOUNDED PRECEDING)"
_FLAGS = f"""(SELECT submission, pos, event_type, value, row_number() OVER (PARTITION BY submission, props ORDER BY pos) AS copy, lag(event_type) OVER (PARTITION BY submission ORDER BY pos) AS before,
  coalesce(max((event_type = 'view')::INT) {_RUN}, 0) AS viewed FROM {CALLS_SQL})"""
_ISSUES = f"""SELECT submission, pos, 'duplicate_event_id' AS code FROM {_FLAGS} WHERE copy > 1
  UNION ALL SELECT submission, pos, 'consecutive_assistant_messages' FROM {_FLAGS} WHERE event_type = 'click' AND before = 'click'
  UNION ALL SELECT submission, pos, 'orphan_tool_result' FROM {_FLAGS} WHERE event_type = 'purchase' AND viewed = 0
  UNION ALL SELECT submission, pos, 'empty_assistant_message' FROM {_FLAGS} WHERE value < 1"""
_GRAVE = "bool_or(code IN ('orphan_tool_result', 'duplicate_event_id'))"
_redacted = "text"
for _label, _, _pattern, _ in ORACLE_RULES:
    _redacted = f"regexp_replace({_redacted}, '{_pattern}', '[{_label}]', 'g')"

ORACLE_SQL = {
    "structural_issues": _ISSUES,
    "gate_verdicts": f"SELECT submission, count(*) AS n_issues, string_agg(DISTINCT code, ',' ORDER BY code) AS codes, CASE WHEN {_GRAVE} THEN 'FAIL' ELSE 'MINOR_ISSUES' END AS verdict, (CASE WHEN {_GRAVE} THEN 2 ELSE 4 END)::INT AS score FROM ({_ISSUES}) GROUP BY submission",
    "orphan_results": f"SELECT event_id, submission FROM {CALLS_SQL} a WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM {CALLS_SQL} b WHERE b.event_type = 'signup' AND b.submission = a.submission AND b.props = a.props)",
    "passing_semi": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)",
    "redact_documents": f"SELECT doc_id, {_redacted} AS redacted FROM documents",
    "streaming_latch": f"SELECT event_id, coalesce(last_value(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 0 END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0)::BIGINT AS pending FROM events",
    "patched_conversations": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, slot) - 1 AS line, role, text FROM (
        SELECT conv_id, turn, 3 AS slot, role, CASE WHEN role = 'user' AND regexp_matches(text, '[0-9]') THEN '[REDACTED]' ELSE text END AS text FROM conversations WHERE NOT coalesce(length(text) < 60, false)
        UNION ALL SELECT conv_id, turn, 1, 'assistant', 'May I go on?' FROM conversations WHERE role = 'assistant' AND length(text) > 400
        UNION ALL SELECT conv_id, turn, 2, 'user', 'Yes.' FROM conversations WHERE role = 'assistant' AND length(text) > 400)""",
    "entity_reuse": f"""WITH found AS (SELECT f.*, lower(trim(hit)) AS value FROM ({hits_sql("(SELECT {'c': conv_id, 't': turn, 'r': role} AS spot, text FROM conversations)", "spot", "text")}) f),
        said AS (SELECT spot.c AS conv_id, label, value, min(spot.t) AS said_at FROM found WHERE spot.r = 'user' GROUP BY ALL)
        SELECT s.conv_id, s.label, s.value, said_at, min(f.spot.t) AS repeated_at FROM said s JOIN found f ON f.spot.c = s.conv_id AND f.label = s.label AND f.value = s.value AND f.spot.r = 'assistant' AND f.spot.t > said_at GROUP BY ALL""",
}
ORACLE_SQL["value_reuse"] = ORACLE_SQL["entity_reuse"].replace("FROM conversations)", f"FROM (SELECT submission AS conv_id, pos AS turn, role, text FROM {STREAM_SQL}))")
