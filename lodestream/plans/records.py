"""Queries on what is delivered with the stand-in streams: scenarios, facts on rows, opening rows, record heads, joined tasks, needless scrubs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.operators import records
from lodestream.plans.stream import ENTITIES_SQL, REFUSAL, STREAM_SQL, entities, sql_text, stream
from lodestream.plans.text_rules import _any, _in

_BY = ["submission"]
SCRUB = "I found health details in plaintext USER.md and take them out."
_GUIDE = REFUSAL.split(".")[0].lower()


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By stream what its persona holds; in this stand-in only values up to level submission % 5."""
    people = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("submission")).distinct()
    held = entities(spark, sf_dir).filter("level <= submission % 5")
    found = held.groupBy("submission").agg(F.max("level").alias("max_level"), F.bool_or(F.col("level") == 3).alias("has_l3"), F.bool_or(F.col("level") == 4).alias("has_l4"), F.array_sort(F.collect_set("label")).alias("labels"))
    return people.join(found, "submission", "left").fillna({"max_level": 0, "has_l3": False, "has_l4": False})


def turn_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each assistant row's scenario; every second task names one of its own."""
    rows = stream(spark, sf_dir).filter("role = 'assistant'").join(_people(spark, sf_dir), _BY)
    tools = F.when(F.col("has_call"), F.array("tool"))
    given = F.when(F.col("submission") % 2 == 0, "G").otherwise("")
    return rows.select("event_id", records.turn_scenario(tools, F.col("max_level"), F.col("has_l3"), F.col("has_l4"), given).alias("scenario"))


def marker_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.marker_scenarios(stream(spark, sf_dir), _BY, "text", _GUIDE)


def decorated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped user texts (some have an older stamp), stop reasons, details of results."""
    rows = stream(spark, sf_dir).withColumn("is_error", F.col("event_id") % 7 == 0)
    rows = rows.withColumn("text", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("[Mon 2020-01-06 00:00 UTC]  "), "text")).otherwise(F.col("text")))
    return records.decorate(rows).select("event_id", "text", "stop_reason", "details")


def opening_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows before each stream's first one; every third stream's folder is unknown."""
    first = stream(spark, sf_dir).groupBy("submission").agg(F.min("ms").alias("ms"))
    first = first.withColumns({"cwd": F.when(F.col("submission") % 3 > 0, F.concat(F.lit("/w/"), "submission")), "provider": F.lit("own"), "model": F.lit("m1")})
    return records.opening_rows(first, "submission")


def record_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = stream(spark, sf_dir).filter("has_call AND event_id % 3 = 0 AND submission % 4 > 0").groupBy("submission").agg(F.array_sort(F.collect_set("tool")).alias("tools"))
    marks = marker_scenarios(spark, sf_dir).select("submission", F.filter(F.split("scenarios", ","), lambda x: x != "").alias("scenarios"))
    whole = _people(spark, sf_dir).join(used, _BY, "left").join(marks, _BY, "left")
    labels = F.when(F.col("submission") % 6 == 1, F.array(F.lit("EMP_ID"))).otherwise(F.col("labels"))
    whole = whole.withColumns(
        {
            "labels": labels, "task_id": F.concat(F.lit("T-"), "submission"), "name": F.when(F.col("submission") % 2 == 1, F.concat(F.lit("Person "), "submission")),
            "verdict": F.when(F.col("submission") % 3 == 0, "FAIL").when(F.col("submission") % 3 == 1, "PASS"),
        }
    )
    heads = records.record_heads(whole, "submission")
    return heads.withColumn("task_types", F.array_join(F.transform("task_types", lambda p: F.array_join(p, "/")), ";"))


def assembled_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams with their tasks and personas; customers stand in for both, some of them unknown."""
    people = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("submission")).distinct()
    prefix = F.when(F.col("submission") % 10 == 0, "X-").when(F.col("submission") % 2 == 0, "P-").otherwise("T-")
    parsed = people.withColumn("task_id", F.concat(prefix, "submission", F.lit("-"), F.col("submission") % 7))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey").cast("string")
    tasks = customers.filter("c_custkey % 4 <> 0").select(F.concat(F.lit("T-"), key, F.lit("-"), F.col("c_custkey") % 7).alias("task_id"), F.col("c_mktsegment").alias("segment"))
    personas = customers.filter("c_custkey % 9 <> 0").select(F.concat(F.lit("P-"), key).alias("persona_id"), F.col("c_name").alias("name"))
    return records.assemble(parsed, tasks, personas).select("submission", "task_id", "persona_id", "segment", "name", "error")


def kept_scrubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows without needless scrubs; every third calling row is made a scrub, and results that speak of health are what is to be scrubbed."""
    rows = stream(spark, sf_dir)
    scrub = (F.col("role") == "assistant") & F.col("has_call") & (F.col("event_id") % 3 == 0)
    rows = rows.withColumns({"text": F.when(scrub, F.lit(SCRUB)).otherwise(F.col("text")), "tool": F.when(scrub, "write").otherwise(F.col("tool")), "path": F.when(scrub, "/w/USER.md").otherwise(F.col("path"))})
    is_scrub = (F.col("role") == "assistant") & F.col("has_call") & (F.col("tool") == "write") & F.lower("path").endswith("user.md") & P.any_of(F.col("text"), (T.SCRUB_MARK,))
    dirty = (F.col("role") == "toolResult") & (P.any_of(F.col("text"), T.HEALTH_CONTEXT) | (F.col("event_id") % 2 == 0))
    return records.drop_needless_scrubs(rows, _BY, "pos", is_scrub, dirty).select("event_id", "role", "text", "path")


_FUNCTIONS = (turn_scenarios, marker_scenarios, decorated_rows, opening_rows, record_heads, assembled_streams, kept_scrubs)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_PEOPLE_SQL = f"""(SELECT submission, coalesce(max(level), 0)::INT AS max_level, coalesce(bool_or(level = 3), false) AS has_l3, coalesce(bool_or(level = 4), false) AS has_l4
  FROM (SELECT DISTINCT user_id AS submission FROM events) LEFT JOIN (SELECT submission, level FROM {ENTITIES_SQL} WHERE level <= submission % 5) USING (submission) GROUP BY submission)"""
_MARKS_SQL = f"""(SELECT submission, concat_ws(',', CASE WHEN bool_or(shares) THEN 'C' END, CASE WHEN bool_or(refused) THEN 'D' END) AS scenarios, sum(shares::INT + refused::INT)::BIGINT AS points
  FROM (SELECT submission, contains(lower(text), {sql_text(_GUIDE)}) AS refused, {_any('text', T.SHARING_MARKS)} OR contains(lower(text), 'mednow') AND contains(lower(text), 'share') AS shares FROM {STREAM_SQL}) GROUP BY submission)"""
_STAMPED = r"regexp_replace(CASE WHEN event_id % 5 = 0 THEN '[Mon 2020-01-06 00:00 UTC]  ' || text ELSE text END, '^\[(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) \d{4}-\d{2}-\d{2} \d{2}:\d{2} UTC\]\s*', '')"
_OLD = "CASE WHEN event_id % 5 = 0 THEN '[Mon 2020-01-06 00:00 UTC]  ' || text ELSE text END"
_DIGEST = lambda kind: f"sha256(submission || ':{kind}')[1:8]"
_MODEL = """'{"provider":"own","modelId":"m1"}'"""
ORACLE_SQL = {
    "turn_scenarios": f"""SELECT event_id, CASE WHEN (has_l3 OR has_l4) AND keeps THEN 'D' WHEN (has_l3 OR has_l4) AND outside THEN 'C' WHEN has_l3 AND cloud THEN 'B' WHEN outside AND max_level = 2 THEN 'C' WHEN has_l3 AND nearby THEN 'A'
      WHEN has_l4 THEN 'L' WHEN has_l3 THEN 'A' WHEN max_level = 2 THEN 'F' WHEN submission % 2 = 0 THEN 'G' ELSE 'A' END AS scenario FROM (
      SELECT event_id, submission, has_call AND {_in('tool', T.SCENARIO_KEEPERS)} AS keeps, has_call AND {_in('tool', T.SCENARIO_OUTSIDE)} AS outside, has_call AND {_in('tool', T.SCENARIO_LOCAL)} AS nearby,
        has_call AND starts_with(tool, 'enterprise-') AS cloud FROM {STREAM_SQL} WHERE role = 'assistant') JOIN {_PEOPLE_SQL} p USING (submission)""",
    "marker_scenarios": f"SELECT * FROM {_MARKS_SQL}",
    "decorated_rows": f"""SELECT event_id, CASE WHEN role = 'user' THEN strftime(make_timestamp(ms * 1000), '[%a %Y-%m-%d %H:%M UTC] ') || {_STAMPED} ELSE {_OLD} END AS text,
      CASE WHEN role = 'assistant' THEN CASE WHEN has_call THEN 'toolUse' ELSE 'stop' END END AS stop_reason,
      CASE WHEN role = 'toolResult' AND tool = 'exec' THEN to_json(struct_pack(status := 'completed', exitCode := (event_id % 7 = 0)::INT, aggregated := substr({_OLD}, 1, 500)))::VARCHAR END AS details FROM {STREAM_SQL}""",
    "opening_rows": f"""SELECT submission, v.pos, v.type, CASE v.pos WHEN -4 THEN submission::VARCHAR WHEN -3 THEN {_DIGEST('model_change')} WHEN -2 THEN {_DIGEST('thinking_level_change')} ELSE {_DIGEST('custom')} END AS id,
      CASE v.pos WHEN -2 THEN {_DIGEST('model_change')} WHEN -1 THEN {_DIGEST('thinking_level_change')} END AS parent, ms + v.later AS ms,
      CASE v.pos WHEN -4 THEN CASE WHEN submission % 3 > 0 THEN '{{"version":3,"cwd":"/w/' || submission || '"}}' ELSE '{{"version":3}}' END WHEN -2 THEN '{{"thinkingLevel":"off"}}' ELSE {_MODEL} END AS data, true AS is_synthetic
      FROM (SELECT submission, min(ms) AS ms FROM {STREAM_SQL} GROUP BY submission), (VALUES (-4, 'session', 0), (-3, 'model_change', 2), (-2, 'thinking_level_change', 4), (-1, 'custom', 6)) v (pos, type, later)""",
    "record_heads": f"""SELECT submission, CASE WHEN has_l3 THEN 'Health/Sensitive/Privacy-gated' WHEN submission % 6 = 1 THEN 'Professional/Data handling' ELSE 'General/Multi-turn' END
        || CASE WHEN tools IS NULL THEN '' ELSE ';Standard multi-turn/Claw native tool use' END AS task_types,
      CASE WHEN submission % 2 = 1 THEN 'Person ' || submission ELSE 'User' END || ' — T-' || submission || '. PII levels: L' || max_level || '. Scenarios: ' || replace(scenarios, ',', ', ') || '. Tools: '
        || coalesce(array_to_string(list_slice(tools, 1, 5), ', '), '') || '.' AS task_description, CASE WHEN submission % 3 = 1 THEN 'success' ELSE 'failed' END AS completion
      FROM {_PEOPLE_SQL} p JOIN {_MARKS_SQL} m USING (submission) LEFT JOIN (SELECT submission, list_sort(list(DISTINCT tool)) AS tools FROM {STREAM_SQL} WHERE has_call AND event_id % 3 = 0 AND submission % 4 > 0 GROUP BY submission) u USING (submission)""",
    "assembled_streams": """SELECT submission, task_id, CASE WHEN submission % 10 <> 0 THEN 'P-' || submission END AS persona_id, t.c_mktsegment AS segment, p.c_name AS name,
      CASE WHEN submission % 10 = 0 THEN 'odd task id' WHEN p.c_custkey IS NULL THEN 'no persona' WHEN t.c_custkey IS NULL THEN 'no task' END AS error
      FROM (SELECT DISTINCT user_id AS submission, CASE WHEN user_id % 10 = 0 THEN 'X-' WHEN user_id % 2 = 0 THEN 'P-' ELSE 'T-' END || user_id || '-' || user_id % 7 AS task_id FROM events)
      LEFT JOIN customer t ON t.c_custkey = submission AND t.c_custkey % 4 <> 0 AND submission % 10 <> 0 LEFT JOIN customer p ON p.c_custkey = submission AND p.c_custkey % 9 <> 0 AND submission % 10 <> 0""",
    "kept_scrubs": f"""WITH s AS (SELECT *, role = 'assistant' AND has_call AND event_id % 3 = 0 AND call_id <> '' AS scrub, role = 'assistant' AND has_call AND event_id % 3 = 0 AS made FROM {STREAM_SQL}
        ),
      t AS (SELECT *, NOT scrub AND role = 'toolResult' AND ref <> '' AND EXISTS (SELECT 1 FROM s c WHERE c.submission = s.submission AND c.scrub AND c.call_id = s.ref AND c.pos < s.pos) AS answer FROM s),
      a AS (SELECT *, last_value(CASE WHEN NOT scrub AND NOT coalesce(answer, false) THEN pos END IGNORE NULLS) OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM t),
      k AS (SELECT a.*, a.scrub AND NOT (coalesce(d.role = 'toolResult' AND ({_any('d.text', T.HEALTH_CONTEXT)} OR d.event_id % 2 = 0), false)
          AND a.pos = (SELECT min(f.pos) FROM a f WHERE f.submission = a.submission AND f.scrub AND f.anchor = a.anchor)) AS goes FROM a LEFT JOIN a d ON d.submission = a.submission AND d.pos = a.anchor)
      SELECT event_id, role, CASE WHEN made THEN {sql_text(SCRUB)} ELSE text END AS text, CASE WHEN made THEN '/w/USER.md' ELSE path END AS path FROM k
      WHERE NOT goes AND NOT (role = 'toolResult' AND coalesce(ref, '') <> '' AND EXISTS (SELECT 1 FROM k c WHERE c.submission = k.submission AND c.goes AND c.call_id = k.ref AND c.pos < k.pos))""",
}
