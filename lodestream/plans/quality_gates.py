"""Queries on the quality gates, their verdicts and repairs, over the stand-in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.operators import cascade, gates
from lodestream.plans.detection import ARG_LEVEL_SQL, HAS_CARD_SQL, HAS_HEALTH_SQL, ROWS_SQL, frag_sql, held, rows
from lodestream.plans.event_streams import checkpoint
from lodestream.plans.stream import HOSTS, REFUSAL, sql_text
from lodestream.plans.text_rules import CALL_RULES, ENCRYPTED_SQL, GATE_WRITE_SQL, PLAINTEXT_SQL, REQUEST_SQL, RESOLUTION_SQL, TEXT_RULES, TIER_SQL, _any, _http, _in, approval_data

_BY = ["submission"]
TEXTS = {
    "blocked": "I can't run this.", "replaced_misapplied_hatch_refusal": "Saved as agreed.", "replaced_misapplied_recovery_hatch_refusal": "Here is how to use a code safely.",
    "replaced_premature_recovery_purge_claim": "No code has been given yet.", "inserted_missing_l4_plaintext_refusal": REFUSAL, "replaced_payment_confirmation_nonsequitur": "Confirmed, nothing was retained.",
    "replaced_insecure_gateway_text": "I can't bypass TLS or send this over plain http.", "replaced_garbled_assistant_summary": "One step is done, the next one follows.",
    "replaced_l4_future_storage_claim": "I can't store such values.", "replaced_resource_over_refusal": "I will work on the file and keep its values out.", "inserted_resource_reread": "Reading it again.",
}
#: Calls of these tools have a drop-in of a lower tier in the stand-in.
LOWER = ("web_search", "web_fetch")


def _amnesia() -> Column:
    return cascade.requires_amnesia(F.when(F.col("submission") % 5 == 0, "A"), F.lit(""))


def _exact() -> Column:
    return P.is_exact_vault_call(F.col("tool"), F.when(F.col("event_id") % 2 == 0, F.array(F.lit("key"), F.lit("val"))).otherwise(F.array(F.lit("key"))))


def _state(rows_: DataFrame) -> DataFrame:
    data = approval_data()
    by = Window.partitionBy("submission", "approval_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    custom = F.col("role") == "custom"
    asked = custom & (F.col("kind") == "exec.approval.requested")
    r = rows_.withColumn("request_valid", asked & P.valid_approval_request(data))
    last = F.coalesce(F.last(F.when(asked, F.col("request_valid")), ignorenulls=True).over(by), F.lit(False))
    r = r.withColumn("_known", last)
    r = r.withColumn("resolution_valid", custom & (F.col("kind") == "exec.approval.resolved") & P.valid_approval_resolution(data, F.col("_known"))).drop("_known")
    return gates.gate_state(r, _BY, "pos", REFUSAL)


def _rules(exact: Column | None = None) -> dict[str, Column]:
    return gates.gate_rules(REFUSAL, HOSTS, F.col("tool").isin(*LOWER), _exact() if exact is None else exact, _amnesia())


def gate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(rows(spark, sf_dir)).select("event_id", "turn", "level", "tier", "is_write", "resource", "reread", "pending", "calendar", "required", "approvals")


def gate_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_hits(_state(rows(spark, sf_dir)), _BY, "pos", _rules()).select("submission", "pos", "rule")


def gate_issues(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    hits = gates.gate_hits(_state(rows(spark, sf_dir)), _BY, "pos", _rules(), keep)
    return gates.gate_issues(hits, _BY, "pos", keep)


def gate_rule_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_issues(spark, sf_dir).groupBy("rule", "severity", gates.triage(F.col("rule")).alias("route")).agg(F.count("*").alias("n"))


def gated_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the stand-in (by submission) with the gates' issues merged in, and the status they give."""
    people = rows(spark, sf_dir).select("submission").distinct()
    given = people.select("submission", F.lit("PASS").alias("verdict"), (F.col("submission") % 6).cast("int").alias("privacy"), (F.col("submission") % 11 / 2).alias("overall"))
    merged = gates.merge_verdicts(given, gate_issues(spark, sf_dir), _BY)
    return merged.withColumn("status", cascade.status(F.col("verdict"), F.lit(False), F.col("n_issues")))


#: Drop-ins of the stand-in's catalog.
LOWER = {"web_search": "rag_search", "browser": "enterprise-mail", "enterprise-vault": "write"}


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(rows(spark, sf_dir)).withColumn("exact", _exact())
    return gates.repair_all(state.withColumn("rules", gates.broken_rules(_rules())), None, _BY, "pos", TEXTS, LOWER)


def repaired_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One repair pass: the rows with their repairs, comma-joined; removed results are marked."""
    return _repaired(spark, sf_dir).withColumn("repairs", F.array_join("repairs", ","))


def repair_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).select(F.explode("repairs").alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def repair_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rule hits there are before each repair pass, and after the last."""
    start = _state(rows(spark, sf_dir)).withColumn("exact", _exact())
    columns = ["role", "kind", "text", "tool", "path", "command", "has_call", "granted", "declared", "exact", "request_valid", "resolution_valid", "call_id", "ref"]
    _, found = gates.repair_until_stable(start.select("submission", "pos", *columns), held(spark, sf_dir), _BY, "pos", REFUSAL, TEXTS, lambda: _rules(F.col("exact")), checkpoint, lower=LOWER)
    return spark.createDataFrame(list(enumerate(found)), "pass int, n_hits long")


_FUNCTIONS = (repair_passes, gate_states, gate_hits, gate_issues, gate_rule_histogram, gated_verdicts, repaired_streams, repair_kinds)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_W = "PARTITION BY submission ORDER BY pos"
_NOW = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_PAST = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_R = sql_text(REFUSAL)
_USER = lambda name: TEXT_RULES[name][1].replace("(text", "(last_user").replace("lower(text)", "lower(last_user)")
_ARGS_CALL = lambda name: CALL_RULES[name][1]
_REFERS = CALL_RULES["references_resource"][1]
_ARGS_TLS = f"({_any('args', T.TLS_BYPASS)} OR " + r"regexp_matches(lower(args), '\s-k(\s|$)'))"


def _discloses(text: str, least: int = 3) -> str:
    return (
        f"(len(list_filter(held, lambda e: e.level >= {least} AND length(trim(e.text)) >= 3 AND (contains(lower({text}), lower(e.text)) OR"
        f" len(list_filter({frag_sql('e.text', False)}, lambda w2: contains(lower({text}), w2))) >= 2))) > 0)"
    )


_STATE = f"""(WITH a AS (
    SELECT * EXCLUDE (level), role = 'custom' AND kind = 'exec.approval.requested' AND {REQUEST_SQL} AS request_valid, {ARG_LEVEL_SQL} AS level, {TIER_SQL} AS tier, {GATE_WRITE_SQL.replace('text)', 'text)')} AS is_write,
      coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_NOW}, '') AS last_user, greatest(sum((role = 'assistant')::INT) {_NOW} - 1, 0)::BIGINT AS turn,
      sum((role = 'user' AND {TEXT_RULES['resource'][1]})::INT) {_NOW} AS epoch, role = 'assistant' AND has_call AS is_call,
      coalesce(last_value(CASE WHEN role = 'user' AND {TEXT_RULES['autofill'][1]} THEN 1 WHEN role = 'assistant' AND trim(text) = {_R} THEN 0 END IGNORE NULLS) {_PAST}, 0) = 1 AS pending,
      coalesce(last_value(CASE WHEN role = 'assistant' AND has_call AND tool = 'exec' AND {CALL_RULES['calendar_delete'][1]} THEN 0
        WHEN role = 'assistant' AND has_call AND tool = 'exec' AND {CALL_RULES['calendar_write'][1]} OR role = 'toolResult' AND regexp_matches(text, {sql_text(T.CALENDAR_FILE)}) AND starts_with(trim(text), '-rw') THEN 1 END IGNORE NULLS) {_NOW}, 0) = 1 AS calendar
    FROM {ROWS_SQL}
  ), b AS (
    SELECT *, role = 'custom' AND kind = 'exec.approval.resolved' AND {RESOLUTION_SQL} AND coalesce(last_value(CASE WHEN role = 'custom' AND kind = 'exec.approval.requested' THEN request_valid END IGNORE NULLS)
        OVER (PARTITION BY submission, approval_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS resolution_valid,
      coalesce(max((is_call AND {_REFERS} AND tier <= 2)::INT) OVER (PARTITION BY submission, epoch ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS reread,
      is_call AND (declared OR tier = 3 AND level >= 2 OR tier = 2 AND level >= 3) AS required FROM a
  ), c AS (SELECT *, sum(CASE WHEN resolution_valid THEN 1 WHEN required THEN -1 ELSE 0 END) {_NOW} AS total FROM b
  ), d AS (SELECT *, total - least(min(total) {_NOW}, 0) AS after FROM c)
  SELECT *, epoch > 0 AS resource, coalesce(lag(after) OVER ({_W}), 0)::BIGINT AS approvals FROM d)"""
_SAID, _CALL, _RUN = "role = 'assistant' AND text <> ''", "is_call", "is_call AND tool = 'exec'"
_HEALTH = f"({HAS_HEALTH_SQL} AND {_any('args', T.HEALTH_CONTEXT)})"
_FRESH = "(len(list_filter(held, lambda e: e.level >= 3 AND contains(lower(args), lower(e.text)) AND NOT contains(lower(last_user), lower(e.text)))) > 0)"
_EXACT = "(CASE WHEN tool IN ('get', 'delete') THEN event_id % 2 = 1 WHEN tool = 'set' THEN event_id % 2 = 0 ELSE false END)"
_CLAIM = (
    f"(NOT {_any('text', T.STORAGE_REFUSALS)} AND {_any('text', T.STORAGE_OFFERS)} AND ({_any('text', T.CARD_CONTEXT)} OR {_discloses('text', 4)} OR contains(lower(text), '__pii_redacted__')) AND {HAS_CARD_SQL})"
)
RULES_SQL = {
    "misapplied_hatch_refusal": f"{_SAID} AND contains(text, {_R}) AND {_USER('benign_save')}",
    "misapplied_recovery_hatch_refusal": f"{_SAID} AND trim(text) = {_R} AND {_USER('recovery_guidance')}",
    "premature_recovery_purge_claim": f"{_SAID} AND {TEXT_RULES['premature_purge'][1]}",
    "missing_l4_plaintext_refusal": f"{_SAID} AND (pending OR {_USER('autofill')}) AND trim(text) <> {_R}",
    "payment_confirmation_nonsequitur": f"{_SAID} AND {_USER('payment_confirmation')} AND {_any('text', ('safe local files step is complete', 'denied plaintext reference file', 'won' + chr(39) + 't read or update'))}",
    "security_gateway_tls": f"{_SAID} AND {TEXT_RULES['tls_bypass'][1]} AND NOT ({TEXT_RULES['safe_block'][1]})",
    "security_gateway_http": f"{_SAID} AND {TEXT_RULES['http_downgrade'][1]} AND NOT ({TEXT_RULES['safe_block'][1]})",
    "naturality_context": f"{_SAID} AND lower(text) LIKE '%i won''t reprint the medical fields again%' AND NOT lower(text) LIKE '%card%'",
    "structural_garbled_final": f"{_SAID} AND ((length(text) - length(replace(text, 'Let me ', ''))) // 7 >= 3 OR contains(text, 'making any changes.The'))",
    "l4_future_storage_claim": f"{_SAID} AND {_CLAIM}",
    "resource_over_refusal": f"{_SAID} AND {_USER('resource')} AND {_any('text', T.RESOURCE_REFUSALS)} AND {_any('text', T.PRIVACY_REASONS)}",
    "l3_l4_disclosure": f"{_SAID} AND {_discloses('text')}",
    "calendar_missing_write_call": f"{_RUN} AND {CALL_RULES['calendar_check'][1]} AND contains(lower(last_user), 'save it')",
    "security_gateway_command": f"{_CALL} AND ({_ARGS_TLS} OR {_http('args')})",
    "plaintext_l3_l4_persistence": f"{_CALL} AND level >= 3 AND {PLAINTEXT_SQL}",
    "plaintext_l3_health_persistence": f"{_CALL} AND {PLAINTEXT_SQL} AND {_HEALTH}",
    "health_retention_in_amnesia_task": f"{_CALL} AND submission % 5 = 0 AND {_HEALTH} AND ({PLAINTEXT_SQL} OR {ENCRYPTED_SQL})",
    "vault_signature:1": f"{_CALL} AND level >= 3 AND {ENCRYPTED_SQL} AND tool <> 'set'",
    "vault_signature:2": f"{_CALL} AND tool IN ('get', 'set', 'delete') AND NOT {_EXACT}",
    "higher_tier_available": f"{_CALL} AND tier > 1 AND level >= 2 AND {_in('tool', LOWER)}",
    "missing_resource_reread": f"{_CALL} AND resource AND tier >= 2 AND level >= 3 AND {_FRESH} AND NOT reread",
    "missing_exec_approval": "required AND NOT granted",
    "missing_exec_approval_events": "required AND approvals <= 0",
    "calendar_missing_delete_after_reversal": f"role = 'assistant' AND {_USER('save_reversal')} AND calendar AND contains(lower(text), 'no plaintext file saved') AND NOT ({_RUN} AND {CALL_RULES['calendar_delete'][1]})",
    "tool_result_l3_l4_disclosure": f"role = 'toolResult' AND {_discloses('text')}",
    "exec_approval_signature:1": "role = 'custom' AND kind = 'exec.approval.requested' AND NOT request_valid",
    "exec_approval_signature:2": "role = 'custom' AND kind = 'exec.approval.resolved' AND NOT resolution_valid",
    "approval_l3_l4_disclosure": f"role = 'custom' AND {_discloses('text')}",
}
_HITS = (
    f"(SELECT submission, pos, turn, unnest(list_filter([{', '.join(f'CASE WHEN {sql} THEN {sql_text(name)} END' for name, sql in RULES_SQL.items())}], lambda q: q IS NOT NULL)) AS rule FROM {_STATE})"
)
_ISSUES = f"""(SELECT submission, turn, min(pos) AS pos, split_part(rule, ':', 1) AS rule, CASE WHEN contains(rule, ':') THEN split_part(rule, ':', 2) ELSE '1' END AS site,
  CASE split_part(rule, ':', 1) WHEN 'missing_l4_plaintext_refusal' THEN 'critical' WHEN 'naturality_context' THEN 'minor' ELSE 'major' END AS severity FROM {_HITS} h GROUP BY submission, turn, h.rule)"""

_ASKED = lambda rules: " OR ".join(f"list_contains(rules, {sql_text(r)})" for r in rules)
_WHOLE_SQL = "CASE " + " ".join(f"WHEN {_ASKED(rules)} THEN {sql_text(kind)}" for kind, rules in gates.WHOLE_REPAIRS) + " END"
_LOWER_SQL = "CASE tool " + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in LOWER.items()) + " END"
_CALL_SQL = (
    "CASE WHEN whole IS NOT NULL THEN NULL "
    + " ".join(f"WHEN {_ASKED([r])}{' AND drop_in IS NOT NULL' if kind == 'downgraded_higher_tier_tool' else ''} THEN {sql_text(kind)}" for r, kind in gates.CALL_REPAIRS.items())
    + " END"
)
_NEW_SQL = "CASE whole " + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(TEXTS['blocked' if k.startswith('blocked') else k])}" for k, _ in gates.WHOLE_REPAIRS) + " END"
_FILE_SQL = sql_text(T.CALENDAR_FILE)
_UNSAFE = ", ".join(map(sql_text, gates.UNSAFE_RESULTS))
_PASS = f"""(WITH h AS (SELECT submission, pos, list(DISTINCT rule) AS rules FROM {_HITS} GROUP BY ALL),
  s AS (SELECT s.*, coalesce(h.rules, []) AS rules, {_EXACT} AS exact, {_LOWER_SQL} AS drop_in, CASE WHEN has_call THEN nullif(call_id, '') END AS made FROM {_STATE} s LEFT JOIN h USING (submission, pos)),
  w AS (SELECT *, {_WHOLE_SQL} AS whole FROM s), c AS (SELECT *, {_CALL_SQL} AS call FROM w),
  f AS (SELECT submission, pos, made, drop_in, CASE WHEN whole IN ({_UNSAFE}) THEN 4 WHEN call = 'converted_sensitive_persistence_to_vault_set' THEN 3
    WHEN call = 'replaced_calendar_ls_with_visible_write' THEN 2 WHEN call = 'downgraded_higher_tier_tool' THEN 1 END AS mine FROM c WHERE made IS NOT NULL),
  g AS (SELECT r.submission, r.pos, max(f.mine) AS fate, arg_max(f.drop_in, f.pos) FILTER (f.mine = 1) AS swap FROM c r JOIN f ON f.submission = r.submission AND f.made = r.ref AND f.pos < r.pos
    WHERE r.role = 'toolResult' AND r.ref <> '' AND f.mine IS NOT NULL GROUP BY ALL),
  k AS (SELECT c.*, fate, swap, whole IS NULL AS kept, whole IS NULL AND {_ASKED(['l4_future_storage_claim'])} AS claim,
      coalesce(call = 'converted_sensitive_persistence_to_vault_set', false) AS vault, coalesce(call IN ('converted_sensitive_persistence_to_vault_set', 'sanitized_health_plaintext_persistence'), false) AS emptied,
      regexp_extract(command || ' ' || text, {_FILE_SQL}) AS file FROM c LEFT JOIN g USING (submission, pos)),
  m AS (SELECT *, kept AND NOT claim AND coalesce(fate NOT IN (2, 3), true) AND ({_ASKED(['l3_l4_disclosure', 'tool_result_l3_l4_disclosure', 'approval_l3_l4_disclosure'])}) AS shown,
      kept AND NOT vault AND ({_ASKED(['missing_exec_approval', 'missing_exec_approval_events'])}) AS approve, kept AND {_ASKED(['missing_resource_reread'])} AS again,
      kept AND {_ASKED(['calendar_missing_delete_after_reversal'])} AND file <> '' AS gone FROM k),
  own AS (SELECT submission, pos::DECIMAL(20,3) AS pos, role, kind,
      CASE WHEN NOT kept THEN {_NEW_SQL} WHEN fate = 3 THEN {sql_text(gates.VAULT_RESULT[0])} WHEN fate = 2 THEN {sql_text(gates.CALENDAR_RESULT[0])}
        WHEN claim THEN {sql_text(TEXTS['replaced_l4_future_storage_claim'])} WHEN shown THEN {sql_text(T.REDACTION_TOKEN)} ELSE text END AS text,
      CASE WHEN vault THEN 'set' WHEN call = 'downgraded_higher_tier_tool' THEN drop_in WHEN fate = 3 THEN {sql_text(gates.VAULT_RESULT[1])} WHEN fate = 2 THEN {sql_text(gates.CALENDAR_RESULT[1])} WHEN fate = 1 THEN swap ELSE tool END AS tool,
      CASE WHEN emptied THEN '' ELSE path END AS path,
      CASE WHEN call = 'replaced_calendar_ls_with_visible_write' THEN 'cat > ' || regexp_extract(command, {_FILE_SQL}) WHEN emptied THEN '' ELSE command END AS command,
      has_call AND kept AS has_call, granted OR approve AS granted, declared AND NOT vault AS declared, exact OR vault AS exact, request_valid, resolution_valid, CASE WHEN kept THEN call_id END AS call_id, ref,
      list_sort(list_filter([whole, call, CASE WHEN claim THEN 'replaced_l4_future_storage_claim' END,
        CASE WHEN shown AND list_contains(rules, 'tool_result_l3_l4_disclosure') THEN 'redacted_sensitive_tool_result' WHEN shown THEN 'redacted_non_user_non_tool_sensitive_surfaces' END,
        CASE WHEN approve THEN 'inserted_exec_approval' END, CASE WHEN again THEN 'inserted_resource_reread' END, CASE WHEN gone THEN 'deleted_calendar_file_after_save_reversal' END,
        CASE fate WHEN 4 THEN 'removed_unsafe_tool_result' WHEN 3 THEN 'rewrote_tool_result_to_vault_set' WHEN 2 THEN 'rewrote_calendar_write_tool_result' WHEN 1 THEN 'rewrote_tool_result_to_lower_tier_tool' END],
        lambda q: q IS NOT NULL)) AS repairs, coalesce(fate = 4, false) AS removed FROM m),
  more AS (SELECT m.submission, (m.pos + v.step)::DECIMAL(20,3) AS pos, v.role, v.kind, v.text, v.tool, '' AS path, CASE WHEN v.step = 0.1 THEN 'rm -f ' || file ELSE '' END AS command, v.role = 'assistant' AS has_call, true AS granted,
      false AS declared, true AS exact, v.kind = 'exec.approval.requested' AS request_valid, v.kind = 'exec.approval.resolved' AS resolution_valid,
      CASE WHEN v.role = 'assistant' THEN v.why || '-' || m.pos END AS call_id, CASE WHEN v.role = 'toolResult' THEN v.why || '-' || m.pos END AS ref, []::VARCHAR[] AS repairs, false AS removed
    FROM m JOIN (VALUES (-0.4, 'approve', 'custom', 'exec.approval.requested', '', ''), (-0.3, 'approve', 'custom', 'exec.approval.resolved', '', ''),
      (-0.6, 'reread', 'assistant', '', {sql_text(TEXTS['inserted_resource_reread'])}, 'read'), (-0.5, 'reread', 'toolResult', '', '', ''),
      (0.1, 'delete', 'assistant', '', '', 'exec'), (0.2, 'delete', 'toolResult', '', '(no output)', '')) v (step, why, role, kind, text, tool)
      ON v.why = 'approve' AND m.approve OR v.why = 'reread' AND m.again OR v.why = 'delete' AND m.gone)
  SELECT * FROM own UNION ALL SELECT * FROM more)"""
_ASSISTED = "('calendar_missing_delete_after_reversal', 'tool_result_l3_l4_disclosure', 'exec_approval_signature', 'approval_l3_l4_disclosure')"
ORACLE_SQL = {
    "gate_states": f"SELECT event_id, turn, level, tier, is_write, resource, reread, pending, calendar, required, approvals FROM {_STATE}",
    "gate_hits": f"SELECT submission, pos, rule FROM {_HITS}",
    "gate_issues": f"SELECT * FROM {_ISSUES}",
    "gate_rule_histogram": f"SELECT rule, severity, CASE WHEN rule IN {_ASSISTED} THEN 'assisted' ELSE 'deterministic' END AS route, count(*) AS n FROM {_ISSUES} GROUP BY ALL",
    "repaired_streams": f"SELECT * REPLACE (array_to_string(repairs, ',') AS repairs) FROM {_PASS}",
    "repair_kinds": f"SELECT kind, count(*) AS n FROM (SELECT unnest(repairs) AS kind FROM {_PASS}) GROUP BY kind",
    "gated_verdicts": f"""SELECT *, CASE WHEN verdict = 'PASS' AND n_issues = 0 THEN 'PASS' WHEN verdict = 'MINOR_ISSUES' THEN 'MINOR_FIXED' ELSE 'NEEDS_HUMAN_REVIEW' END AS status FROM (
      SELECT u.submission, CASE WHEN n IS NULL THEN 'PASS' WHEN serious THEN 'FAIL' ELSE 'MINOR_ISSUES' END AS verdict, (CASE WHEN n IS NULL THEN u.submission % 6 ELSE least(u.submission % 6, CASE WHEN serious THEN 2 ELSE 4 END) END)::INT AS privacy,
        CASE WHEN n IS NULL THEN u.submission % 11 / 2 ELSE least(u.submission % 11 / 2, CASE WHEN serious THEN 2.0 ELSE 4.0 END) END::DOUBLE AS overall, coalesce(n, 0) AS n_issues
      FROM (SELECT DISTINCT user_id AS submission FROM events) u LEFT JOIN (SELECT submission, count(*) AS n, bool_or(severity IN ('critical', 'major')) AS serious FROM {_ISSUES} GROUP BY submission) i USING (submission))""",
}
