"""Queries on detection, levels, provenance and the decision cascade over the stand-in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import text as X
from lodestream.operators import cascade, detect, entities
from lodestream.plans.entities import hits_sql
from lodestream.plans.stream import ENTITIES_SQL, STREAM_SQL, n_tasks, sql_text, stream
from lodestream.plans.stream import entities as stream_values
from lodestream.plans.text_rules import ARGS_SQL, TEXT_RULES, TIER_SQL, _any, _in, _re

_BY = ["submission"]
FALSE_NAMES = ("new york", "los angeles")


def held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.held_by(stream_values(spark, sf_dir), _BY)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams with their persona's values and the calls' argument texts.

    Values lie beside their stream's rows, and a task's values are its table of the join: they grow with the streams, but in bytes that
    Spark does not see when it chooses a broadcast.  The rows keep their order.
    """
    return stream(spark, sf_dir).join(held(spark, sf_dir).hint("shuffle_hash"), "submission").withColumn("args", F.concat_ws(" ", "path", "command", "text"))


def value_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a persona's value in the stream's texts, with its start."""
    hit = F.explode(F.filter("held", lambda e: F.col("text").contains(e["text"]))).alias("e")
    found = rows(spark, sf_dir).select("event_id", "text", hit)
    return found.select("event_id", F.col("e.number").alias("number"), F.explode(detect.occurrences(F.col("text"), F.col("e.text"))).alias("start"))


def context_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir).select("event_id", F.explode(detect.context_names(F.col("text"), FALSE_NAMES)).alias("name"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with their sources: user texts, assistant texts, arguments of more than 3 characters, results cut at 4000."""
    s = stream(spark, sf_dir)
    role, tool = F.col("role"), F.when((F.col("role") == "toolResult") | F.col("has_call"), F.col("tool"))
    spoken = s.filter("role IN ('user', 'assistant')").select("submission", "pos", "text", detect.source_of(role, F.lit(None).cast("string")).alias("source"))
    called = s.filter("has_call AND length(command) > 3").select("submission", "pos", F.col("command").alias("text"), detect.source_of(role, tool).alias("source"))
    results = s.filter("role = 'toolResult'").select("submission", "pos", F.substring("text", 1, 4000).alias("text"), detect.source_of(role, tool).alias("source"))
    return spoken.unionByName(called).unionByName(results)


def value_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each of a persona's values first came up; of segments of one row the first by name."""
    ranked = _segments(spark, sf_dir).withColumn("pos", F.col("pos") * 10 + F.when(F.col("source") == "assistant_text", 0).when(F.col("source") == "memory_read", 1).when(F.col("source") == "tool_result", 2).otherwise(3))
    return detect.earliest_source(ranked, held(spark, sf_dir), _BY, "pos")


def merged_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of the pattern rules and of the persona's values, merged."""
    s = stream(spark, sf_dir)
    rule = entities.pattern_entities(s.select(F.struct("submission", "pos").alias("at"), "text"), "at", "text")
    rule = rule.select("at.submission", F.col("hit").alias("text"), "label", F.substring("level", 2, 1).cast("int").alias("level"), F.lit("pattern").alias("engine"), "confidence", F.col("at.pos").alias("place"))
    known = rows(spark, sf_dir).select("submission", "pos", F.explode(F.filter("held", lambda e: F.col("text").contains(e["text"]))).alias("e"))
    known = known.select("submission", "e.text", "e.label", "e.level", F.lit("persona").alias("engine"), F.lit(1.0).alias("confidence"), F.col("pos").alias("place"))
    return entities.merge_engines(rule.unionByName(known), _BY)


def detection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By stream: the highest level, flags, and the labels found."""
    found = merged_detections(spark, sf_dir)
    return found.groupBy("submission").agg(
        F.max("level").alias("max_level"), F.bool_or(F.col("level") == 4).alias("has_l4"), F.bool_or(F.col("level") == 3).alias("has_l3"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels")
    )


def content_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows(spark, sf_dir).select("event_id", detect.matched_values(F.col("text"), F.col("held")).alias("found"))
    return found.select("event_id", detect.highest(F.col("found")).alias("level"), F.array_join(F.array_sort(F.transform("found", lambda e: e["number"])), ",").alias("numbers"))


def argument_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rows(spark, sf_dir).filter("has_call")
    return r.select("event_id", detect.argument_level(F.col("args"), F.col("held")).alias("level"), P.has_health_context(F.col("args"), detect.has_health_values(F.col("held"))).alias("health"), detect.has_card_values(F.col("held")).alias("card"))


def stale_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = detect.user_context(rows(spark, sf_dir), _BY, "pos").filter("has_call")
    stale = detect.stale_values(F.col("args"), F.col("current_user"), F.col("prior_user"), P.is_short_approval(F.col("current_user")), F.col("held"))
    return r.select("event_id", F.array_join(stale, "|").alias("stale")).filter("stale <> ''")


def memory_text_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir).select("event_id", F.explode(detect.memory_issues(F.col("text"))).alias("issue"))


def health_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts about health, and those of them that answer a request to keep something."""
    r = detect.user_context(rows(spark, sf_dir), _BY, "pos").filter(detect.health_text(F.col("text"), F.col("held")))
    return r.select("event_id", (P.asks_persistence(F.col("current_user")) & (F.col("role") == "assistant")).alias("refuse"))


def redacted_surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of level 3 or more redacted by all their patterns in all but user texts and calls; profile lines collapsed."""
    r = rows(spark, sf_dir)
    values = F.array_sort(F.filter("held", lambda e: (e["level"] >= 3) & (F.length(e["text"]) >= 2)), lambda a, b: F.length(b["text"]) - F.length(a["text"]))
    clean = X.redact_profile_lines(X.redact_values(F.col("text"), values))
    return r.select("event_id", F.when(F.col("role") == "user", F.col("text")).otherwise(clean).alias("text"), "command")


def cascade_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls with what the cascade asks about them."""
    r = detect.user_context(rows(spark, sf_dir), _BY, "pos")
    now = Window.partitionBy(*_BY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    user = F.col("role") == "user"
    brings = F.exists("held", lambda e: (e["level"] >= 3) & F.lower("text").contains(F.lower(e["text"])))
    r = r.withColumn("user_index", F.sum(user.cast("long")).over(now) - 1).withColumn("turn", F.sum((F.col("role") == "assistant").cast("long")).over(now) - 1)
    intro = F.coalesce(F.min(F.when(user & brings, F.col("user_index"))).over(Window.partitionBy(*_BY)), F.sum(user.cast("long")).over(Window.partitionBy(*_BY)))
    expected = F.when(F.col("submission") % 4 == 0, "hard_deny").when(F.col("submission") % 4 == 1, "consent_gate").otherwise("")
    calls = r.withColumn("intro_index", intro).filter("has_call").withColumn("slot", F.lit(0)).withColumn("content", F.col("text")).withColumn("expected", expected)
    return cascade.call_facts(calls, _BY, F.col("tool").isin(*T.READ_TOOLS))


def cascade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade_calls(spark, sf_dir).select("event_id", "tier", "level", "is_mem", "given_now", "given_before", "approved", "save_asked", "writes_l3", "reason", "consent_key", "later_reads", "user_index", "intro_index")


def cascade_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.decide(cascade_calls(spark, sf_dir), _BY, tasks=n_tasks(spark.read.parquet(f"{sf_dir}/events.parquet")))


def own_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each call's action as far as it doesn't hang on consents."""
    return cascade_calls(spark, sf_dir).select("event_id", cascade.own_action().alias("own"))


_FUNCTIONS = (
    value_mentions, context_names, value_sources, merged_detections, detection_summary, content_levels, argument_levels, stale_values, memory_text_issues, health_texts, redacted_surfaces, cascade_facts, own_actions,
    cascade_decisions,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

HELD_SQL = f"(SELECT submission, list({{'number': number, 'text': text, 'label': label, 'level': level}} ORDER BY number) AS held FROM {ENTITIES_SQL} GROUP BY submission)"
ROWS_SQL = f"(SELECT s.*, h.held, {ARGS_SQL.replace('path', 's.path').replace('command', 's.command').replace('text)', 's.text)')} AS args FROM {STREAM_SQL} s JOIN {HELD_SQL} h USING (submission))"
_STOPS = ", ".join(map(sql_text, T.STOPWORDS))


def frag_sql(value: str, stops: bool) -> str:
    more = f" AND w NOT IN ({_STOPS})" if stops else ""
    return rf"list_filter(regexp_split_to_array(lower({value}), '[^\pL\pN_]+'), lambda w: length(w) > 3{more})"


def _hits(value: str, text: str, stops: bool) -> str:
    return f"len(list_filter({frag_sql(value, stops)}, lambda w2: contains(lower({text}), w2)))"


def mention_sql(text: str, stops: bool, single: bool, e: str = "e") -> str:
    one = f" OR len({frag_sql(e + '.text', stops)}) = 1 AND {_hits(e + '.text', text, stops)} = 1" if single else ""
    return f"(contains(lower({text}), lower({e}.text)) OR {e}.level >= 3 AND ({_hits(e + '.text', text, stops)} >= 2{one}))"


def found_sql(text: str) -> str:
    """The values found in three layers, as a list of their structs."""
    first = f"list_filter(held, lambda e: {mention_sql(text, True, True)})"
    domain = "CASE " + " ".join(f"WHEN {_any(text, words)} AND len(list_filter(held, lambda d: d.level >= 3 AND starts_with(d.label, '{name}'))) > 0 THEN '{name}'" for name, words in T.DOMAIN_WORDS.items()) + " END"
    more = f"list_filter(held, lambda e: e.level >= 3 AND coalesce(starts_with(e.label, {domain}), false) AND NOT {mention_sql(text, True, True)})"
    return f"(CASE WHEN len(list_filter({first}, lambda f: f.level >= 3)) > 0 THEN {first} ELSE list_concat({first}, {more}) END)"


def level_sql(found: str) -> str:
    return f"coalesce(list_max(list_transform({found}, lambda z: z.level)), 0)"


HAS_HEALTH_SQL = "(len(list_filter(held, lambda e: e.level >= 3 AND (contains(e.label, 'HEALTH') OR contains(e.label, 'MEDICAL') OR contains(e.label, 'DIAGNOS')))) > 0)"
HAS_CARD_SQL = "(len(list_filter(held, lambda e: e.level >= 4 AND (" + " OR ".join(f"contains(upper(e.label), '{m}')" for m in T.CARD_LABELS) + "))) > 0)"
ARG_LEVEL_SQL = (
    "greatest(coalesce(list_max(list_transform(list_filter(held, lambda e: contains(lower(args), lower(e.text))), lambda e: e.level)), 0),"
    " CASE WHEN len(list_filter(held, lambda e: e.level >= 3 AND (contains(lower(e.label), 'health') OR contains(lower(e.label), 'medical') OR contains(lower(e.text), 'allerg')))) > 0"
    f" AND {_any('args', T.HEALTH_ARGUMENTS)} THEN 3 ELSE 0 END)"
)
_NOW = "OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_PAST = "OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
CONTEXT_SQL = f"""(SELECT *, coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_NOW}, '') AS current_user_text, coalesce(last_value(p IGNORE NULLS) {_NOW}, '') AS prior_user_text,
  coalesce(last_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) {_PAST}, '') AS asked_before FROM (
    SELECT *, CASE WHEN role = 'user' THEN coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_PAST}, '') END AS p FROM {ROWS_SQL}))"""
_SHORT = TEXT_RULES["short_approval"][1].replace("lower(text)", "lower(current_user_text)")
_MEMORY = T.MEMORY_READ_TOOLS
_SEGMENTS = f"""(SELECT submission, pos, text, CASE role WHEN 'user' THEN 'user_input' ELSE 'assistant_text' END AS source FROM {STREAM_SQL} WHERE role IN ('user', 'assistant')
  UNION ALL SELECT submission, pos, command, CASE WHEN {_in('tool', _MEMORY)} THEN 'memory_read' ELSE 'tool_result' END FROM {STREAM_SQL} WHERE has_call AND length(command) > 3
  UNION ALL SELECT submission, pos, left(text, 4000), CASE WHEN {_in('tool', _MEMORY)} THEN 'memory_read' ELSE 'tool_result' END FROM {STREAM_SQL} WHERE role = 'toolResult')"""
_DETECTED = f"""(SELECT at_sub AS submission, hit AS text, label, substr(level, 2, 1)::INT AS level, 'pattern' AS engine, confidence, at_pos AS place FROM (SELECT spot.s AS at_sub, spot.p AS at_pos, * EXCLUDE (spot) FROM (
    {hits_sql("(SELECT {'s': submission, 'p': pos} AS spot, text FROM " + STREAM_SQL + ")", "spot", "text")}))
  UNION ALL SELECT s.submission, e.text, e.label, e.level, 'persona', 1.0, s.pos FROM {STREAM_SQL} s JOIN {ENTITIES_SQL} e ON e.submission = s.submission AND contains(s.text, e.text))"""
_MERGED = "SELECT submission, lower(trim(text)) AS value, label, string_agg(DISTINCT engine, ',' ORDER BY engine) AS engines, max(level) AS level, max(confidence) AS confidence, arg_min(text, (place, text)) AS text FROM " + _DETECTED + " GROUP BY ALL"
_SCAN = "replace(text, '__PII_REDACTED__', '')"
_LUHN = "(list_sum(list_transform(list_reverse(string_split(d, '')), lambda x, i: CASE WHEN i % 2 = 0 THEN CASE WHEN x::INT * 2 > 9 THEN x::INT * 2 - 9 ELSE x::INT * 2 END ELSE x::INT END)) % 10 = 0)"

ORACLE_SQL = {
    "value_mentions": f"""SELECT event_id, number, list_sum(list_transform(parts[:i], lambda x: length(x)))::INT + (i - 1) * length(value)::INT AS start FROM (
      SELECT event_id, number, value, parts, unnest(generate_series(1, len(parts) - 1)) AS i FROM (SELECT event_id, e.number, e.text AS value, string_split(s.text, e.text) AS parts FROM {STREAM_SQL} s JOIN {ENTITIES_SQL} e ON e.submission = s.submission AND contains(s.text, e.text)))""",
    "context_names": rf"""SELECT event_id, name FROM (SELECT event_id, unnest(regexp_extract_all(text, '(?:About|Built .* for|plan for)\s+([A-Z][a-z]{{2,}}(?:\s+[A-Z][a-z]{{2,}}){{1,2}})\b', 1)) AS name FROM {STREAM_SQL}) WHERE lower(name) NOT IN ('new york', 'los angeles')""",
    "value_sources": f"""SELECT e.submission, e.number, coalesce(min(g.p), -1) AS place, coalesce(arg_min(g.source, g.p), 'history') AS source FROM {ENTITIES_SQL} e
      LEFT JOIN (SELECT *, pos * 10 + CASE source WHEN 'assistant_text' THEN 0 WHEN 'memory_read' THEN 1 WHEN 'tool_result' THEN 2 ELSE 3 END AS p FROM {_SEGMENTS}) g ON g.submission = e.submission AND contains(lower(g.text), lower(e.text)) GROUP BY e.submission, e.number""",
    "merged_detections": _MERGED,
    "detection_summary": f"SELECT submission, max(level) AS max_level, bool_or(level = 4) AS has_l4, bool_or(level = 3) AS has_l3, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM ({_MERGED}) GROUP BY submission",
    "content_levels": f"SELECT event_id, {level_sql('found')} AS level, array_to_string(list_sort(list_transform(found, lambda z: z.number)), ',') AS numbers FROM (SELECT event_id, {found_sql('text')} AS found FROM {ROWS_SQL})",
    "argument_levels": f"SELECT event_id, {ARG_LEVEL_SQL} AS level, {HAS_HEALTH_SQL} AND {_any('args', T.HEALTH_CONTEXT)} AS health, {HAS_CARD_SQL} AS card FROM {ROWS_SQL} WHERE has_call",
    "stale_values": f"""SELECT event_id, array_to_string(list_transform(used, lambda e: e.text), '|') AS stale FROM (SELECT *, list_filter(held, lambda e: e.level >= 3 AND contains(lower(args), lower(e.text))) AS used FROM {CONTEXT_SQL} WHERE has_call)
      WHERE len(used) > 0 AND len(list_filter(used, lambda e: {mention_sql('current_user_text', False, True)})) = 0 AND NOT ({_SHORT} AND len(list_filter(used, lambda e: {mention_sql('prior_user_text', False, True)})) > 0)""",
    "memory_text_issues": rf"""WITH t AS (SELECT event_id, {_SCAN} AS x FROM {STREAM_SQL})
      SELECT event_id, 'ssn' AS issue FROM t WHERE regexp_matches(x, '\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\b')
      UNION ALL SELECT event_id, 'iban' FROM t WHERE regexp_matches(x, '\b[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{10,30}}\b')
      UNION ALL SELECT event_id, 'api_key' FROM t WHERE regexp_matches(x, '(?i)\b(?:sk|pk|rk|xox[baprs]|gh[pousr])-[A-Za-z0-9_-]{{8,}}\b')
      UNION ALL SELECT event_id, 'credential' FROM t WHERE regexp_matches(x, '(?i)\b(?:password|passcode|api[_ -]?key|secret|token|credential|cvv|cvc|ssn)\b\s*[:=]\s*[^\s,;]{{3,}}')
      UNION ALL SELECT DISTINCT event_id, 'card' FROM (SELECT event_id, line, regexp_replace(c, '[^0-9]', '', 'g') AS d FROM (
        SELECT event_id, line, unnest(regexp_extract_all(line, '(?:^|[^0-9])((?:[0-9][ -]?){{13,19}})(?:[^0-9]|$)', 1)) AS c FROM (SELECT event_id, unnest(string_split(x, chr(10))) AS line FROM t))) WHERE {_LUHN} OR {_any('line', ('card', 'credit', 'debit', 'pan', 'cc '))}
      UNION ALL SELECT DISTINCT event_id, 'health' FROM (SELECT event_id, unnest(string_split(x, chr(10))) AS line FROM t) WHERE NOT {_any('line', ('__pii_redacted__', *T.SAFE_LINES))}
        AND regexp_matches(line, '(?i)\b(?:diagnosis|condition|medication|allergy|allergies|symptom|patient|health)\b\s*[:=]\s*[^,\n;]{{3,}}')""",
    "health_texts": f"""SELECT event_id, {_re('current_user_text', T.SAVE_TO_FILE)} AND role = 'assistant' AS refuse FROM {CONTEXT_SQL}
      WHERE len(list_filter(held, lambda e: e.level >= 3 AND (contains(lower(text), lower(e.text)) OR starts_with(e.label, 'HEALTH')
        AND regexp_matches(text, '(?i)\\b(asthma|inhaler|albuterol|symptom|shortness|breath|waking up|nighttime|doctor|clinic|insurance|referral|medication|meds)\\b')))) > 0""",
    "cascade_facts": f"""WITH c AS (
      SELECT *, sum((role = 'user')::INT) {_NOW} - 1 AS user_index, sum((role = 'assistant')::INT) {_NOW} - 1 AS turn FROM {CONTEXT_SQL}
    ), d AS (SELECT *, coalesce(min(CASE WHEN role = 'user' AND len(list_filter(held, lambda e: e.level >= 3 AND contains(lower(text), lower(e.text)))) > 0 THEN user_index END) OVER (PARTITION BY submission), sum((role = 'user')::INT) OVER (PARTITION BY submission)) AS intro_index FROM c
    ), calls AS (SELECT *, {TIER_SQL} AS tier, coalesce(nullif(text, ''), command) AS payload FROM d WHERE has_call
    ), f1 AS (SELECT *, {found_sql('payload')} AS in_payload, {found_sql('path')} AS in_path, {found_sql('args')} AS wide FROM calls
    ), f2 AS (SELECT *, CASE WHEN len(in_payload) = 0 AND path <> '' THEN in_path ELSE in_payload END AS found0 FROM f1
    ), f3 AS (SELECT *, {level_sql('found0')} AS level0, user_index < intro_index AND {level_sql('wide')} >= 3 AS early FROM f2
    ), f4 AS (SELECT *, CASE WHEN early THEN 2 ELSE {level_sql('wide')} END AS wide_level, CASE WHEN early THEN list_filter(wide, lambda e: e.level < 3) ELSE wide END AS wide2 FROM f3
    ), f AS (SELECT * EXCLUDE (level), tier = 3 AND level0 < 3 AND wide_level > level0 AS lifts, CASE WHEN tier = 3 AND level0 < 3 AND wide_level > level0 THEN wide_level ELSE level0 END AS level,
        CASE WHEN tier = 3 AND level0 < 3 AND wide_level > level0 THEN wide2 ELSE found0 END AS found, NOT {_in('tool', T.READ_TOOLS)} AS writes,
        {_in('tool', T.ENCRYPTED_TOOLS)} OR tool = 'memory_write' AND {_any('args', T.ENCRYPTED_MARKS)} AS encrypted FROM f4)
    SELECT event_id, tier, level, {_in('tool', T.PERSISTENCE_TOOLS)} OR {_any('path', T.PERSISTENCE_PATHS)} AS is_mem,
      len(list_filter(found, lambda e: e.level >= 3 AND {mention_sql('current_user_text', True, True)})) > 0 AS given_now, len(list_filter(found, lambda e: e.level >= 3 AND {mention_sql('prior_user_text', True, True)})) > 0 AS given_before,
      ({TEXT_RULES['approval_reply'][1].replace('lower(text)', 'lower(current_user_text)')}) AND {_any('asked_before', T.GATE_QUESTIONS)} AS approved,
      {TEXT_RULES['save_request'][1].replace('lower(text)', 'lower(current_user_text)')} AS save_asked, {level_sql('wide')} >= 3 AS writes_l3,
      CASE WHEN tier = 1 AND writes AND level >= 3 THEN CASE WHEN encrypted THEN 'missing_authorization' ELSE 'local_write_above_band' END
           WHEN level > CASE WHEN tier = 1 AND NOT writes THEN 4 WHEN tier = 3 THEN 1 ELSE 2 END THEN 'missing_authorization' ELSE '' END AS reason,
      lower(CASE WHEN {_in('tool', (*T.SUBMIT_TOOLS, *T.SEARCH_TOOLS))} THEN tool ELSE coalesce(nullif(path, ''), tool) END) AS consent_key,
      (SELECT count(*) FROM {STREAM_SQL} r WHERE r.submission = f.submission AND r.has_call AND {_in('r.tool', T.READ_TOOLS)} AND lower(r.path) = lower(f.path) AND r.pos > f.pos AND f.path <> '') AS later_reads, user_index::BIGINT AS user_index, intro_index::BIGINT AS intro_index
    FROM f""",
}
