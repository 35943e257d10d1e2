"""Queries on edits, preference pairs, substitutions and scalars over the stand-in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import values as V
from lodestream.operators import edits, preferences, substitution
from lodestream.plans.event_streams import checkpoint
from lodestream.plans.stream import REFUSAL, STREAM_SQL, dealt, sql_text, stream
from lodestream.plans.text_rules import TIER_SQL, _any

_BY = ["submission"]
_POINT = ["submission", "pos"]
#: Templates of the stand-in: tool group, failure mode, severity.
MODES = (
    ("exec", "memory_violation", "critical"), ("exec", "over_refusal", "minor"), ("exec", "hallucination", "minor"), ("exec", "wrong_tool_tier_up", "major"), ("exec", "missing_consent", "major"),
    ("exec", "ambient_pii_leak", "critical"), ("exec", "wrong_param_higher", "major"), ("exec", "memory_violation", "major"), ("exec", "over_refusal", "minor"), ("exec", "unlisted", "major"),
    ("write", "missing_elicitation", "critical"), ("write", "over_refusal", "minor"), ("exec_rm", "memory_violation", "critical"),
)
#: Capabilities of the stand-in: capability, skill, tool, tier, fields.
CATALOG = (
    ("web.find", "search", "web_search", 3, "name,id,state"), ("web.find", "archive", "rag_search", 1, "name,id"), ("web.find", "page", "web_fetch", 3, "id"),
    ("mail.send", "post", "browser", 3, "id"), ("mail.send", "enterprise-mail", "enterprise-mail", 2, "id,name,state"), ("notes.write", "wiki", "enterprise-vault", 2, "id"), ("notes.write", "obsidian", "write", 1, "id"),
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.col("has_call")
    return stream(spark, sf_dir).select(
        "submission", "pos", "role", F.coalesce("text", F.lit("")).alias("text"), F.col("call_id"), F.when(call, F.col("tool")).alias("tool"), F.when(call, F.col("command")).alias("arguments"),
        F.when(F.col("role") == "toolResult", F.col("ref")).alias("ref"), F.when(F.col("role") == "toolResult", F.lit(False)).alias("is_error"), "event_id",
    )


def _patch(rows: DataFrame, when: str, op: str, **fields: Column) -> DataFrame:
    kinds = {"text": "string", "drop_calls": "boolean", "call_id": "string", "tool": "string", "arguments": "string", "is_error": "boolean", "ask": "string", "answer": "string"}
    more = [fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]
    return rows.filter(when).select("submission", F.col("pos").alias("seq"), F.lit(op).alias("op"), F.col("pos").alias("line"), *more)


def edited_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations that leave the lines where they are, one for each fifth row."""
    rows = _events(spark, sf_dir)
    p = _patch(rows, "event_id % 5 = 0", "replace_assistant_text", text=F.lit("edited"), drop_calls=F.col("event_id") % 2 == 0)
    p = p.unionByName(_patch(rows, "event_id % 5 = 1", "remove_tool_call", call_id=F.col("call_id")))
    p = p.unionByName(_patch(rows, "event_id % 5 = 2", "replace_tool_call_arguments", call_id=F.col("call_id"), arguments=F.when(F.col("event_id") % 3 == 0, F.lit(f"x {T.REDACTION_TOKEN}")).otherwise(F.lit("new args"))))
    p = p.unionByName(_patch(rows, "event_id % 5 = 3", "replace_tool_call", call_id=F.col("call_id"), tool=F.lit("set"), arguments=F.lit("k v")))
    p = p.unionByName(_patch(rows, "event_id % 5 = 4", "replace_tool_result_text", text=F.lit("told"), is_error=F.when(F.col("event_id") % 2 == 0, F.lit(True))))
    return edits.apply_edits(rows.drop("event_id"), p, _BY, "pos", REFUSAL)


def shifted_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removals and inserts, whose lines are those of the stream as edited so far."""
    rows = _events(spark, sf_dir)
    p = _patch(rows, "event_id % 4 = 0", "remove_event").unionByName(_patch(rows, "event_id % 4 = 1", "insert_consent_pair_before", ask=F.lit("May I?"), answer=F.lit("Yes.")))
    p = p.unionByName(_patch(rows, "event_id % 4 = 2", "replace_assistant_text", text=F.concat(F.lit("seq "), F.col("pos"))))
    return edits.apply_edits(rows.drop("event_id"), p, _BY, "pos", REFUSAL).select("submission", "line", "role", "text")


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir)
    rows = preferences.recent_messages(rows, _BY, "pos", "context")
    return rows.filter("has_call").withColumn("tier", P.tier_of(F.col("tool"))).withColumn("acted", F.col("declared"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = sorted({m[0] for m in MODES} - {"exec_rm"})
    found = preferences.decision_points(_calls(spark, sf_dir), _BY, "pos").filter("rank <= 10")
    topic = V.first_label(F.array_join("context", " "), T.TOPICS, "general task assistance")
    return found.withColumn("key", preferences.template_key(F.col("tool"), F.col("command"), known)).withColumn("topic", topic).withColumn("example", F.lit("X")).withColumn("chosen", F.col("text"))


def decision_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("submission", "pos", "branch", "criticality", "rank", "key", "topic", F.array_join("context", "|").alias("context"))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame([(k, i, m, s, f"{m} on {{topic}} with {{example}}") for i, (k, m, s) in enumerate(MODES)], "key string, number int, mode string, severity string, response string")
    return preferences.rejected_alternatives(_points(spark, sf_dir).select(*_POINT, "key", "topic", "example", "chosen", F.array_join("context", "|").alias("prompt")), templates, _POINT, "key")


def rejected_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    violates = ~F.col("mode").isin("over_refusal", "hallucination")
    return _rejected(spark, sf_dir).select(*_POINT, "place", "mode", "severity", "response", "reward", preferences.heuristic_reward(F.col("mode"), F.col("severity"), violates).alias("heuristic"))


def single_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _rejected(spark, sf_dir)
    points = rejected.select(*_POINT, "prompt", "chosen").distinct()
    return preferences.single_pairs(preferences.pairs(points, rejected, _POINT), _POINT, "prompt", "chosen")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.turn_pairs(_rejected(spark, sf_dir), _POINT)


def pair_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.report(_rejected(spark, sf_dir), _BY)


def failure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(spark, sf_dir).groupBy("mode", "severity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mode", "severity")


def _catalog(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(CATALOG), "capability string, skill string, tool string, tier int, fields string")
    return rows.withColumn("fields", F.split("fields", ","))


def consumed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of JSON results that any later text of the stream takes up."""
    rows = stream(spark, sf_dir).select("submission", "pos", "text")
    found = substitution.consumed_fields(rows, rows, _BY, "pos", checkpoint)
    return found.select("submission", "pos", F.array_join("consumed", ",").alias("consumed"))


def _event_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of six fields by event: plain values, a list, a phrase, and values that say nothing."""
    events = dealt(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id")
    number = F.get_json_object("props", "$.k")
    made = F.format_string(
        '{"k": %s, "kind": "%s", "pair": ["x", "%s-%s"], "phrase": "seen %s (%s)", "flag": true, "inner": {"k": %s}, "one": 1}', number, "event_type", number, "user_id", number, "event_type", number
    )
    told = F.concat_ws(" ", F.lit("then"), number.cast("long") + F.when(F.col("event_id") % 3 == 0, 0).otherwise(1), F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("seen "), number, F.lit(" ("), F.col("event_type"), F.lit(")"))), F.when(F.col("event_id") % 5 == 0, F.concat(number, F.lit("-"), "user_id")))
    return events.select(F.col("user_id").alias("submission"), F.col("event_id").alias("pos"), made.alias("text"), told.alias("told"))


def recurring_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of results made of ``events`` that later texts of the same user take up: numbers, list items and phrases."""
    rows = _event_results(spark, sf_dir)
    found = substitution.consumed_fields(rows, rows.select("submission", "pos", F.col("told").alias("text")), _BY, "pos", checkpoint)
    return found.select("submission", "pos", F.array_join("consumed", ",").alias("consumed"))


def _substitutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumed = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("id"))).when(F.col("event_id") % 3 == 1, F.array(F.lit("id"), F.lit("state")))
    arguments = F.create_map(F.lit("to"), F.when(F.col("event_id") % 2 == 0, F.lit("a@corp.com,b@x.org")).otherwise(F.lit("a@corp.com")), F.lit("parent"), F.when(F.col("event_id") % 5 == 0, F.lit("root")).otherwise(F.lit("")))
    return _calls(spark, sf_dir).select("event_id", "tool", "tier", consumed.alias("consumed"), arguments.alias("arguments"))


def lower_tier_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substitution.alternatives(_substitutable(spark, sf_dir), _catalog(spark), ["event_id"])


def drop_in_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substitution.drop_ins(lower_tier_tools(spark, sf_dir), ["event_id"])


def skill_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands and their types stand for skills and capabilities."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return substitution.reverse_index(parts.select(F.col("p_brand").alias("skill"), F.col("p_type").alias("capability")))


def parsed_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with alternatives made of ``events``: in a fence, between words, broken."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    item = F.format_string('[{"failure_mode": "%s", "severity": "major", "assistant_response": "to %s"%s}, 5, {}]', F.when(F.col("event_id") % 3 == 0, "over_refusal").otherwise("over_disclosure"), "user_id", F.when(F.col("event_id") % 2 == 0, ', "privacy_violation_rule": "r1"').otherwise(""))
    reply = F.when(F.col("event_id") % 7 == 0, "no list").when(F.col("event_id") % 5 == 0, F.concat(F.lit("Here: "), item, F.lit(" Done."))).when(F.col("event_id") % 4 == 0, F.concat(F.lit("```json\n"), item, F.lit("\n```"))).otherwise(item)
    return e.select("event_id", F.posexplode(preferences.parse_alternatives(reply)).alias("place", "a")).select("event_id", "place", "a.*")


def adversarial_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternatives that comply with an attempt, for every sixth user row."""
    points = stream(spark, sf_dir).filter("role = 'user' AND event_id % 6 = 0").select("submission", "pos", F.lit("X").alias("example"), F.substring("text", 1, 9).alias("topic"))
    bank = spark.createDataFrame([(i, f"comply_{i % 3}", ("critical", "major")[i % 2], f"fine, {i}: {{topic}} {{example}}") for i in range(5)], "number int, mode string, severity string, response string")
    return preferences.adversarial_alternatives(points, bank, _POINT).drop("example", "topic")


def remapped_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys renamed for the substitute, and construction keys dropped."""
    given = F.create_map(F.lit("path"), F.col("path"), F.lit("command"), F.col("command"), F.lit("is_synthetic"), F.lit("true"))
    names = F.create_map(F.lit("path"), F.lit("file"), F.lit("query"), F.lit("q"))
    done = V.without_keys(V.remap_keys(given, names), ("is_synthetic", "_synthetic", "is_adversarial", "attack_type"))
    return stream(spark, sf_dir).filter("has_call").select("event_id", F.array_join(F.array_sort(F.map_keys(done)), ",").alias("keys"), done["file"].alias("file"))


def time_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    said = F.when(n % 4 == 0, F.col("ms").cast("string")).when(n % 4 == 1, V.iso_of(F.col("ms"))).when(n % 4 == 2, F.regexp_replace(V.iso_of(F.col("ms")), r"\.\d+Z$", "")).otherwise(F.lit("soon"))
    name = F.concat(F.lit("x/sess-"), F.when(n % 2 == 0, F.col("ms") * 1000).otherwise(F.col("ms")), F.lit("-T-012-03.jsonl"))
    return stream(spark, sf_dir).select("event_id", V.epoch_ms(said).alias("epoch"), V.iso_of(F.col("ms")).alias("iso"), V.shift_iso(V.iso_of(F.col("ms")), -900).alias("shifted"), V.reference_ms(F.when(n % 5 == 0, F.lit("other.jsonl")).otherwise(name)).alias("reference"))


def score_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    reply = (
        F.when(n % 5 == 0, F.concat(F.lit('{"score": '), (n % 30 / 20).cast("string"), F.lit("}")))
        .when(n % 5 == 1, F.concat(F.lit('```json\n{"score": '), (n % 30 / 40).cast("string"), F.lit("}\n```")))
        .when(n % 5 == 2, F.concat(F.lit('so "score" is: 0.'), (n % 9).cast("string"), F.lit(" I think")))
        .otherwise(F.lit("none"))
    )
    digits = F.concat(F.lit("453914880343646"), (n % 10).cast("string"))
    return stream(spark, sf_dir).select(
        "event_id", V.parse_score(reply).alias("score"), V.luhn_valid(digits).alias("luhn"), V.uniform(n, F.lit(0.1), F.lit(0.3)).alias("drawn"),
        V.capped((n % 7).cast("double"), n % 2 == 0, 2.0, 4.0, 5.0).alias("capped"), F.coalesce(V.json_in_reply(reply), F.lit("")).alias("json"), F.array_join(V.denied_labels(F.col("text")), ",").alias("denied"),
    )


def write_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    edit = lambda old, new: F.struct(old.cast("string").alias("oldText"), new.cast("string").alias("newText"))
    pairs = F.when(n % 3 == 0, F.array(edit(F.lit("a"), F.col("text")), edit(F.lit(None), F.lit("b")))).when(n % 3 == 1, F.array(edit(F.lit("a"), F.lit("c")), edit(F.lit("d"), F.lit("e"))))
    content = F.when(n % 4 == 0, F.col("text"))
    return stream(spark, sf_dir).filter("has_call").select("event_id", V.write_payload(content, pairs, F.col("command")).alias("payload"), P.valid_edits(pairs, F.col("path")).alias("valid"), F.coalesce(F.size(V.valid_edits_only(pairs)), F.lit(0)).cast("long").alias("n_valid"))


_FUNCTIONS = (
    edited_calls, shifted_edits, decision_points, rejected_alternatives, single_pairs, turn_pairs, pair_report, failure_histogram, consumed_fields, recurring_values, lower_tier_tools, drop_in_tools, skill_index, parsed_alternatives, adversarial_pairs, remapped_arguments, time_scalars,
    score_scalars, write_payloads,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_REFUSED = _any("text", T.REFUSAL_MARKS)
_BRANCH = f"CASE WHEN level > CASE tier WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END THEN CASE WHEN {_REFUSED} THEN 'R_correct' ELSE 'A_wrong' END ELSE CASE WHEN {_REFUSED} THEN 'R_wrong' ELSE 'A_correct' END END"
_WORD = "CASE " + " ".join(f"WHEN {_any('spoken', words)} THEN {sql_text(name)}" for words, name in T.TOPICS) + " ELSE 'general task assistance' END"
_POINTS = f"""(SELECT *, CASE WHEN tool = 'exec' AND contains(command, 'rm ') THEN 'exec_rm' WHEN tool IN ('exec', 'write') THEN tool ELSE 'exec' END AS key, {_WORD} AS topic FROM (
  SELECT *, row_number() OVER (PARTITION BY submission ORDER BY criticality DESC, pos) AS rank, array_to_string(context, ' ') AS spoken FROM (
    SELECT *, least(1.0, round(0.15 * level + CASE branch WHEN 'R_correct' THEN 0.3 WHEN 'A_wrong' THEN 0.3 WHEN 'R_wrong' THEN 0.2 ELSE 0.0 END + CASE tier WHEN 3 THEN 0.15 WHEN 2 THEN 0.10 ELSE 0.05 END + CASE WHEN declared THEN 0.1 ELSE 0.0 END, 6))::DOUBLE AS criticality FROM (
      SELECT *, {_BRANCH} AS branch FROM (SELECT *, {TIER_SQL} AS tier, list_filter(list(CASE WHEN role = 'user' THEN left(text, 300) END) OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL)[-2:] AS context FROM {STREAM_SQL}) WHERE has_call)) WHERE criticality >= 0.3) WHERE rank <= 10)"""
_TEMPLATES = "(VALUES " + ", ".join(f"('{k}', {i}, '{m}', '{s}')" for i, (k, m, s) in enumerate(MODES)) + ") t (key, number, mode, severity)"
_RANGE = "CASE mode || '|' || severity " + " ".join(f"WHEN '{m}|{s}' THEN [{lo}::DOUBLE, {hi}::DOUBLE]" for (m, s), (lo, hi) in T.REWARD_RANGES.items()) + " ELSE [0.3::DOUBLE, 0.5::DOUBLE] END"
_HEURISTIC = "CASE mode || '|' || severity " + " ".join(f"WHEN '{m}|{s or ''}' THEN {r}" for (m, s), r in T.REWARDS.items()) + " ELSE CASE severity WHEN 'critical' THEN 0.1 WHEN 'major' THEN 0.25 ELSE 0.4 END END"
_REJECTED = f"""(SELECT *, round_even(r[1] + (r[2] - r[1]) * (('0x' || left(md5(submission || ':' || pos || ':' || place), 8))::BIGINT / 4294967296), 3) AS reward, mode || ' on ' || topic || ' with X' AS response, ({_HEURISTIC})::DOUBLE AS heuristic FROM (
  SELECT *, {_RANGE} AS r FROM (
    SELECT p.submission, p.pos, p.topic, p.context, p.text, g.place::INT AS place, t.mode, t.severity FROM {_POINTS} p
    JOIN (SELECT submission, pos, count(*) AS n FROM {_POINTS} JOIN {_TEMPLATES} USING (key) GROUP BY ALL) c USING (submission, pos), generate_series(0, 8) g (place)
    JOIN (SELECT q.submission, q.pos, t.*, row_number() OVER (PARTITION BY q.submission, q.pos ORDER BY md5(q.submission || ':' || q.pos || ':' || t.number)) - 1 AS k FROM {_POINTS} q JOIN {_TEMPLATES} USING (key)) t
      ON t.submission = p.submission AND t.pos = p.pos AND t.k = g.place % c.n)))"""
_CATALOG = "(VALUES " + ", ".join(f"('{c}', '{s}', '{t}', {n}, {f.split(',')})" for c, s, t, n, f in CATALOG) + ") c (capability, skill, tool, tier, fields)"
_SUBST = f"""(WITH calls AS (SELECT event_id, tool, {TIER_SQL} AS tier, CASE event_id % 3 WHEN 0 THEN ['id'] WHEN 1 THEN ['id', 'state'] END AS consumed FROM {STREAM_SQL} WHERE has_call
  ), hit AS (SELECT * FROM (SELECT k.*, c.capability, c.tier AS own_tier, c.fields AS own_fields, row_number() OVER (PARTITION BY event_id ORDER BY (c.tier <> k.tier)::INT, c.capability) AS pick FROM calls k JOIN {_CATALOG} USING (tool)) WHERE pick = 1
  ), alt AS (SELECT h.event_id, h.capability, c.tool AS alt_tool, c.tier AS alt_tier, c.skill, list_sort(list_filter(coalesce(h.consumed, h.own_fields), lambda x: NOT list_contains(c.fields, x))) AS missing FROM hit h JOIN {_CATALOG} ON c.capability = h.capability AND c.tier < h.own_tier)
  SELECT event_id, capability, alt_tool, alt_tier, CASE WHEN len(missing) > 0 THEN 'breaks-downstream' WHEN capability = 'notes.write' AND skill = 'obsidian' AND event_id % 5 = 0 THEN 'out-of-scope'
      WHEN capability = 'mail.send' AND skill = 'enterprise-mail' AND event_id % 2 = 0 THEN 'out-of-scope' ELSE 'drop-in' END AS verdict, array_to_string(missing, ',') AS missing, row_number() OVER (PARTITION BY event_id ORDER BY alt_tier, alt_tool) AS place FROM alt)"""
_EDITED = f"""(SELECT submission, pos, role, event_id, coalesce(text, '') AS text, call_id, CASE WHEN has_call THEN tool END AS tool, CASE WHEN has_call THEN command END AS arguments, CASE WHEN role = 'toolResult' THEN ref END AS ref, has_call AND role = 'assistant' AS is_call,
   has_call AND (event_id % 10 = 0 OR event_id % 5 = 1) AND call_id IS NOT NULL AS drops FROM {STREAM_SQL})"""
_ISO = "strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"
_SCORE = "CASE event_id % 5 WHEN 0 THEN least(1.0, event_id % 30 / 20) WHEN 1 THEN event_id % 30 / 40 WHEN 2 THEN ('0.' || event_id % 9)::DOUBLE ELSE 0.5 END"
_JSON_NUMBER = lambda d: f"regexp_replace((event_id % 30 / {d})::DECIMAL(9, 6)::VARCHAR, '\\.?0+$', '')"
_DENIED = "list_concat(" + ", ".join(f"CASE WHEN contains(lower(text), '{w}') THEN {list(labels)} ELSE [] END" for w, labels in T.DENIED_FIELDS.items()) + ")"
ORACLE_SQL = {
    "edited_calls": f"""WITH e AS (SELECT * FROM {_EDITED}), gone AS (SELECT DISTINCT submission, call_id FROM e WHERE drops)
      SELECT submission, row_number() OVER (PARTITION BY submission ORDER BY pos) AS line, role,
        CASE WHEN role = 'assistant' AND event_id % 5 = 0 THEN 'edited' WHEN role = 'toolResult' AND event_id % 5 = 4 THEN 'told' WHEN is_call AND event_id % 5 = 1 AND call_id IS NOT NULL AND text = '' THEN {sql_text(REFUSAL)} ELSE text END AS text,
        CASE WHEN NOT drops OR drops IS NULL THEN call_id END AS call_id,
        CASE WHEN drops THEN NULL WHEN is_call AND event_id % 5 = 3 THEN 'set' ELSE tool END AS tool,
        CASE WHEN drops THEN NULL WHEN is_call AND event_id % 5 = 3 THEN 'k v' WHEN is_call AND event_id % 5 = 2 AND event_id % 3 <> 0 THEN 'new args' ELSE arguments END AS arguments,
        ref, CASE WHEN role = 'toolResult' THEN event_id % 5 = 4 AND event_id % 2 = 0 END AS is_error
      FROM e WHERE NOT (role = 'toolResult' AND ref IS NOT NULL AND (submission, ref) IN (SELECT (submission, call_id) FROM gone))""",
    "decision_points": f"SELECT submission, pos, branch, criticality, rank, key, topic, array_to_string(context, '|') AS context FROM {_POINTS}",
    "rejected_alternatives": f"SELECT submission, pos, place, mode, severity, response, reward, heuristic FROM {_REJECTED}",
    "single_pairs": f"SELECT submission, pos, array_to_string(context, '|') AS prompt, text AS chosen, response AS rejected, reward, place FROM {_REJECTED}",
    "turn_pairs": f"SELECT submission, pos, arg_min(mode, (reward, place)) AS worst_mode, min(reward) AS worst_reward, round_even(avg(reward), 6) AS mean_reward, count(*) AS n FROM {_REJECTED} GROUP BY submission, pos",
    "pair_report": f"""SELECT submission, count(*) AS n, round_even(avg(reward), 6) AS mean_reward, count(*) FILTER (mode NOT IN ('over_refusal', 'hallucination')) AS n_violations, round_even(count(*) FILTER (mode = 'over_refusal') / count(*), 6) AS refusal_share,
      count(*) FILTER (mode = 'over_refusal') / count(*) >= 0.2 AS refusals_suffice FROM {_REJECTED} GROUP BY submission""",
    "failure_histogram": f"SELECT mode, severity, count(*) AS n FROM {_REJECTED} GROUP BY ALL",
    "consumed_fields": rf"""SELECT submission, pos, array_to_string(list_sort(list_filter(['name', 'id', 'state'], lambda k: CASE k WHEN 'name' THEN regexp_matches(later, '(^|[^A-Za-z0-9_])report([^A-Za-z0-9_]|$)') WHEN 'id' THEN regexp_matches(later, '(^|[^A-Za-z0-9_])77([^A-Za-z0-9_]|$)') ELSE false END)), ',') AS consumed FROM (
      SELECT *, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS later FROM {STREAM_SQL}) WHERE starts_with(text, '{{')""",
    "recurring_values": rf"""WITH r AS (SELECT user_id AS submission, event_id AS pos, event_type AS kind, props ->> '$.k' AS k FROM events
    ), t AS (SELECT submission, pos, ' then ' || (k::BIGINT + CASE WHEN pos % 3 = 0 THEN 0 ELSE 1 END) || CASE WHEN pos % 7 = 0 THEN ' seen ' || k || ' (' || kind || ')' ELSE '' END || CASE WHEN pos % 5 = 0 THEN ' ' || k || '-' || submission ELSE '' END || ' ' AS told FROM r
    ), f AS (SELECT submission, pos, 'k' AS field, k AS value FROM r WHERE length(k) > 1 UNION ALL SELECT submission, pos, 'kind', kind FROM r WHERE kind <> 'error'
      UNION ALL SELECT submission, pos, 'pair', k || '-' || submission FROM r UNION ALL SELECT submission, pos, 'phrase', 'seen ' || k || ' (' || kind || ')' FROM r
    ), used AS (SELECT DISTINCT f.submission, f.pos, field FROM f JOIN t ON t.submission = f.submission AND t.pos > f.pos AND regexp_matches(told, '[^A-Za-z0-9_]' || regexp_escape(value) || '[^A-Za-z0-9_]'))
    SELECT r.submission, r.pos, coalesce(string_agg(field, ',' ORDER BY field), '') AS consumed FROM r LEFT JOIN used USING (submission, pos) GROUP BY r.submission, r.pos""",
    "lower_tier_tools": f"SELECT * FROM {_SUBST}",
    "drop_in_tools": f"SELECT event_id, arg_min(alt_tool, place) AS alt_tool, arg_min(alt_tier, place) AS alt_tier, arg_min(capability, place) AS capability FROM {_SUBST} WHERE verdict = 'drop-in' GROUP BY event_id",
    "skill_index": "SELECT p_brand AS skill, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS capabilities FROM part GROUP BY p_brand",
    "parsed_alternatives": """SELECT event_id, 0 AS place, CASE WHEN event_id % 3 = 0 THEN 'over_refusal' ELSE 'over_disclosure' END AS mode, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'major' END AS severity, CASE WHEN event_id % 2 = 0 THEN 'r1' END AS rule, 'to ' || user_id AS response,
        event_id % 2 = 0 AND event_id % 3 <> 0 AS violates FROM events WHERE event_id % 7 <> 0 UNION ALL SELECT event_id, 1, 'hallucination', NULL, NULL, '', false FROM events WHERE event_id % 7 <> 0""",
    "adversarial_pairs": f"""WITH p AS (SELECT submission, pos, left(text, 9) AS topic FROM {STREAM_SQL} WHERE role = 'user' AND event_id % 6 = 0),
      t AS (SELECT p.*, i AS number, row_number() OVER (PARTITION BY submission, pos ORDER BY md5(submission || ':' || pos || ':' || i)) - 1 AS k FROM p, generate_series(0, 4) g (i))
      SELECT submission, pos, place::INT AS place, 'comply_' || number % 3 AS mode, CASE WHEN number % 2 = 0 THEN 'critical' ELSE 'major' END AS severity, 'fine, ' || number || ': ' || topic || ' X' AS response,
        round_even(0.01::DOUBLE + (0.08::DOUBLE - 0.01::DOUBLE) * (('0x' || left(md5(submission || ':' || pos || ':' || place), 8))::BIGINT / 4294967296), 3) AS reward, true AS violates, 'adversarial' AS perturbation FROM t JOIN generate_series(0, 8) h (place) ON k = place % 5""",
    "remapped_arguments": f"SELECT event_id, 'command,file' AS keys, path AS file FROM {STREAM_SQL} WHERE has_call",
    "time_scalars": f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN ms WHEN 1 THEN ms WHEN 2 THEN ms // 1000 * 1000 ELSE 0 END AS epoch, {_ISO} AS iso, {_ISO.replace('ms *', '(ms - 900) *')} AS shifted, CASE WHEN event_id % 5 <> 0 THEN ms END AS reference FROM {STREAM_SQL}""",
    "score_scalars": f"""SELECT event_id, ({_SCORE})::DOUBLE AS score, event_id % 10 = 7 AS luhn, round_even(0.1::DOUBLE + (0.3::DOUBLE - 0.1::DOUBLE) * (('0x' || left(md5(event_id::VARCHAR), 8))::BIGINT / 4294967296), 3) AS drawn,
      least(event_id % 7, CASE WHEN event_id % 2 = 0 THEN 2.0 ELSE 4.0 END)::DOUBLE AS capped, CASE event_id % 5 WHEN 0 THEN '{{"score":' || {_JSON_NUMBER(20)} || '}}' WHEN 1 THEN '{{"score":' || {_JSON_NUMBER(40)} || '}}' ELSE '' END AS json,
      array_to_string(list_sort(list_distinct({_DENIED})), ',') AS denied FROM {STREAM_SQL}""",
    "write_payloads": f"""SELECT event_id, coalesce(CASE WHEN event_id % 4 = 0 THEN nullif(text, '') END, CASE event_id % 3 WHEN 0 THEN text || ' b' WHEN 1 THEN 'c e' END, command) AS payload, event_id % 3 = 1 AND trim(path) <> '' AS valid, CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n_valid FROM {STREAM_SQL} WHERE has_call""",
}
