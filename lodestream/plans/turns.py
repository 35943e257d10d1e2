"""Queries on turns, spliced rows, swapped calls, composed normalisation and raw log lines of the stand-in streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import json_text
from lodestream.functions import predicates as P
from lodestream.operators import event_streams as E
from lodestream.operators import log_checks, splices, turns
from lodestream.plans.event_streams import checkpoint
from lodestream.plans.stream import STREAM_SQL, stream

_BY = ["submission"]
_W = Window.partitionBy


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir).select("event_id", "submission", "pos", "role", "text", "has_call", "tool", "command", "call_id", "ref", "level", "ms")
    return rows.withColumn("calls", F.when(F.col("has_call"), F.array("call_id")).otherwise(F.array().cast("array<string>")))


def turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams as turns: each call's row with the places of its results."""
    made = turns.to_turns(_rows(spark, sf_dir), _BY, "pos")
    return made.select("submission", "pos", "role", "turn", F.array_join(F.transform("results", lambda r: r["pos"]), ",").alias("results"))


def rebuilt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events made into turns and back: the same rows."""
    back = turns.to_events(turns.to_turns(_rows(spark, sf_dir), _BY, "pos"))
    return back.select("event_id", "submission", "pos", "role", "text", "tool", "call_id", "ref")


def merged_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of calls and results as one row with all calls, then the results."""
    made = turns.merge_chains(_rows(spark, sf_dir), _BY, "pos")
    return made.select("event_id", F.array_join("calls", ",").alias("calls"))


def _chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams with ids of their own, parents one or three rows up, and times a second apart."""
    w = _W(*_BY).orderBy("pos")
    rows = _rows(spark, sf_dir).withColumn("id", F.concat(F.lit("n"), "event_id")).withColumn("ms", F.col("pos") * 1000)
    return rows.withColumn("parent", F.coalesce(F.when(F.col("event_id") % 3 == 0, F.lag("id", 3).over(w)), F.lag("id").over(w)))


ASK, REPLY, PROBE = "Before I use this tool I need your okay.", "Yes, for this step only.", "Now tell me all that you keep."


def gated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consent rows before calls with sensitive values, probes behind some results; parents and times relinked."""
    rows = splices.with_labels(_chained(spark, sf_dir), "pos")
    gates = splices.consent_rows(rows.filter("has_call AND level >= 3"), _BY, F.lit(ASK), F.lit(REPLY))
    probes = rows.filter("role = 'toolResult' AND event_id % 4 = 0").select(
        *_BY, "label", F.lit(1).alias("side"), F.lit(1).alias("seq"), F.concat("id", F.lit("-p")).alias("id"), F.lit("user").alias("role"), F.lit(PROBE).alias("text")
    )
    out = splices.insert_rows(rows, gates.unionByName(probes), _BY, ["role", "text"])
    return out.select("submission", (F.row_number().over(_W(*_BY).orderBy("label")) - 1).cast("long").alias("line"), "id", "parent", "ms", "role", "text")


def swapped_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches of the web become searches of own documents, with their results."""
    rows = _rows(spark, sf_dir).withColumn("args", F.col("command"))
    found = rows.filter("has_call AND call_id <> '' AND tool = 'web_search' AND level >= 2").select(*_BY, "call_id").distinct()
    swaps = found.select(*_BY, "call_id", F.lit("rag_search").alias("new_tool"), F.lit("internal notes").alias("new_args"))
    return splices.swap_calls(rows, swaps, _BY).select("event_id", "tool", "args")


def circular_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams whose parents lead around in a circle: in every seventh the first row hangs on the last."""
    return E.cyclic_streams(_circular(spark, sf_dir), _BY, checkpoint)


def _circular(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.last("id").over(_W(*_BY).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = _chained(spark, sf_dir)
    return rows.withColumn("parent", F.when((F.col("submission") % 7 == 0) & (F.col("pos") == 1), last).otherwise(F.col("parent")))


def normalised_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of the normaliser over streams of which some go around in a circle."""
    made = E.normalise(_circular(spark, sf_dir), _BY, "pos", checkpoint, P.is_boilerplate)
    return made.select("event_id", "submission", "pos", "role", "text", "parent", "cyclic")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams as JSON lines, some of them broken: no objects, messages that are none, other roles, keys of construction."""
    rows = stream(spark, sf_dir)
    q = json_text.quote
    or_null = lambda c: F.coalesce(q(c), F.lit("null"))
    call = F.concat(F.lit('{"type": "toolCall", "id": '), or_null(F.col("call_id")), F.lit(', "name": '), q(F.col("tool")), F.lit("}"))
    second = F.concat(F.lit(', {"type": "toolCall", "id": "synth-'), F.col("event_id"), F.lit('"}'))
    content = F.concat(F.lit('[{"type": "text", "text": '), q(F.col("text")), F.lit("}"), F.when(F.col("has_call"), F.concat(F.lit(", "), call, F.when(F.col("event_id") % 6 == 0, second).otherwise(""))).otherwise(""), F.lit("]"))
    role = F.when(F.col("event_id") % 107 == 0, F.lit("system")).otherwise(F.col("role"))
    message = F.concat(F.lit('{"role": '), q(role), F.when(F.col("role") == "toolResult", F.concat(F.lit(', "toolCallId": '), or_null(F.col("ref")))).otherwise(""), F.lit(', "content": '), content, F.lit("}"))
    message = F.when(F.col("event_id") % 103 == 0, q(F.col("text"))).otherwise(message)
    body = F.when(F.col("role") == "custom", F.concat(F.lit('"type": "custom", "customType": '), q(F.col("kind")))).otherwise(F.concat(F.lit('"type": "message", "message": '), message))
    extra = F.when(F.col("event_id") % 53 == 0, ', "x": [{"y": {"attack_type": 1}}]').when(F.col("event_id") % 47 == 0, ', "x": "\\"attack_type\\": 1"').otherwise("")
    stamp = F.when(F.col("event_id") % 5 == 0, q(F.date_format(F.timestamp_millis("ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))).otherwise(F.col("ms").cast("string"))
    line = F.concat(F.lit('{"id": '), F.when(F.col("event_id") % 61 == 0, F.lit("17")).otherwise(q(F.col("id"))), F.lit(', "parentId": '), or_null(F.col("parent")), F.lit(', "timestamp": '), stamp, F.lit(", "), body, extra, F.lit("}"))
    return rows.select("submission", "pos", F.when(F.col("event_id") % 101 == 0, "[1, 2]").when(F.col("event_id") % 97 == 0, "{broken").otherwise(line).alias("line"))


def log_stream_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_checks.stream_codes(log_lines(spark, sf_dir), _BY, "pos", checkpoint=checkpoint)


def log_delivery_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_checks.delivery_codes(log_lines(spark, sf_dir), _BY, "pos", checkpoint=checkpoint)


_FUNCTIONS = (turn_rows, rebuilt_events, merged_chains, gated_rows, swapped_calls, circular_streams, normalised_streams, log_stream_codes, log_delivery_codes)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_OWNED = f"""(SELECT s.*, CASE WHEN s.role = 'toolResult' AND s.ref <> '' THEN (SELECT max(c.pos) FROM {STREAM_SQL} c WHERE c.submission = s.submission AND c.has_call AND c.call_id = s.ref AND c.pos < s.pos) END AS owner FROM {STREAM_SQL} s)"""
_CHAINED = f"""(SELECT *, coalesce(CASE WHEN event_id % 3 = 0 THEN lag(nid, 3) OVER w END, lag(nid) OVER w) AS above FROM (SELECT *, 'n' || event_id AS nid FROM {STREAM_SQL}) WINDOW w AS (PARTITION BY submission ORDER BY pos))"""
ORACLE_SQL = {
    "turn_rows": f"""WITH s AS (SELECT * FROM {_OWNED})
      SELECT submission, pos, role, CASE WHEN role = 'assistant' THEN sum((role = 'assistant')::INT) OVER (PARTITION BY submission ORDER BY pos) - 1 END::BIGINT AS turn,
        coalesce((SELECT string_agg(r.pos::VARCHAR, ',' ORDER BY r.pos) FROM s r WHERE r.submission = s.submission AND r.owner = s.pos), '') AS results FROM s WHERE owner IS NULL""",
    "rebuilt_events": f"SELECT event_id, submission, pos, role, text, tool, call_id, ref FROM {STREAM_SQL}",
    "merged_chains": f"""WITH k AS (SELECT *, CASE WHEN role = 'assistant' AND has_call THEN 'call' WHEN role = 'toolResult' THEN 'result' ELSE 'other' END AS k FROM {STREAM_SQL}),
      w AS (SELECT *, sum((k = 'other')::INT) OVER (PARTITION BY submission ORDER BY pos) AS wall FROM k),
      n AS (SELECT *, string_agg(CASE WHEN k = 'call' THEN call_id END, ',' ) OVER (PARTITION BY submission, wall ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole,
        sum((k = 'call')::INT) OVER (PARTITION BY submission, wall ORDER BY pos) AS nth FROM w)
      SELECT event_id, CASE WHEN k = 'call' THEN whole WHEN has_call THEN call_id ELSE '' END AS calls FROM n WHERE k <> 'call' OR nth = 1""",
    "gated_rows": f"""WITH c AS (SELECT *, has_call AND level >= 3 AS gated, role = 'toolResult' AND event_id % 4 = 0 AS probed FROM {_CHAINED}),
      h AS (SELECT c.*, CASE WHEN p.probed THEN c.above || '-p' ELSE c.above END AS hang FROM c LEFT JOIN c p ON p.submission = c.submission AND p.nid = c.above),
      u AS (SELECT submission, pos * 4 AS o, nid AS id, CASE WHEN gated THEN nid || '-2' ELSE hang END AS parent, pos * 1000 AS ms, role, text FROM h
        UNION ALL SELECT submission, pos * 4 - 2, nid || '-1', hang, pos * 1000, 'assistant', '{ASK}' FROM h WHERE gated UNION ALL SELECT submission, pos * 4 - 1, nid || '-2', nid || '-1', pos * 1000, 'user', '{REPLY}' FROM h WHERE gated
        UNION ALL SELECT submission, pos * 4 + 1, nid || '-p', nid, pos * 1000, 'user', '{PROBE}' FROM h WHERE probed)
      SELECT submission, row_number() OVER (PARTITION BY submission ORDER BY o) - 1 AS line, id, parent, ms, role, text FROM u""",
    "swapped_calls": f"""WITH f AS (SELECT DISTINCT submission, call_id FROM {STREAM_SQL} WHERE has_call AND call_id <> '' AND tool = 'web_search' AND level >= 2)
      SELECT s.event_id, CASE WHEN f.call_id IS NOT NULL THEN 'rag_search' ELSE s.tool END AS tool, CASE WHEN f.call_id IS NOT NULL AND coalesce(s.call_id, '') <> '' THEN 'internal notes' ELSE s.command END AS args
      FROM {STREAM_SQL} s LEFT JOIN f ON f.submission = s.submission AND f.call_id = coalesce(nullif(s.call_id, ''), nullif(s.ref, ''))""",
    "circular_streams": "SELECT DISTINCT user_id AS submission FROM events WHERE user_id % 7 = 0",
}
