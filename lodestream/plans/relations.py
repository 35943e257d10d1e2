"""Queries on lookups, rankings, roll-ups and files over the stand-in streams and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.operators import cascade, policy
from lodestream.operators import relations as R
from lodestream.plans.detection import HELD_SQL, rows
from lodestream.plans.stream import STREAM_SQL, TOOLS, sql_text, stream
from lodestream.plans.text_rules import _any, _in

_BY = ["submission"]
RULE_ORDER = ("l3_l4_disclosure", "missing_exec_approval", "vault_signature")


def _turn(df: DataFrame) -> DataFrame:
    return df.withColumn("turn", F.sum((F.col("role") == "assistant").cast("long")).over(Window.partitionBy(*_BY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))


def calls_with_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir)
    made_up = F.when(F.col("tool") == "write", F.concat(F.lit("Successfully wrote "), F.octet_length("text").cast("string"), F.lit(" bytes to "), F.col("path"))).otherwise(F.concat(F.lit("ok: "), F.col("tool")))
    return R.with_results(s.filter("has_call AND call_id <> ''"), s.filter("role = 'toolResult'"), _BY, "call_id", made_up).select("event_id", "content", "synthetic")


def original_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose ids were lost (every other one) matched to their originals by place and name."""
    calls = _turn(stream(spark, sf_dir)).filter("has_call").withColumn("place", F.lit(0)).withColumn("arguments", F.col("command"))
    lost = calls.withColumn("call_id", F.when(F.col("event_id") % 2 == 0, F.lit("?")).otherwise(F.col("call_id"))).withColumn("tool", F.when(F.col("event_id") % 3 == 0, F.lit("other")).otherwise(F.col("tool"))).drop("arguments")
    originals = calls.filter("call_id <> '' AND event_id % 5 <> 0 AND call_id <> 'c1'")
    return R.match_original(lost, originals, _BY).select("event_id", "original", "matched_by")


def responses_by_id_or_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir)
    return R.id_or_name(s.filter("has_call"), s.filter("role = 'toolResult'"), _BY).select("event_id", "response")


def listed_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of a caller's list (last one wins), with the two defaults that callers use for unlisted tools."""
    listed = spark.createDataFrame([("exec", 1, 0), ("browser", 2, 0), ("browser", 3, 1), ("set", 1, 0)], "tool string, tier int, line int")
    listed = R.last_wins(listed, ["tool"], [F.desc("line")])
    calls = stream(spark, sf_dir).filter("has_call").select("event_id", "tool")
    first = R.lookup(calls, listed, "tool", "tier", F.lit(3))
    return first.select("event_id", "tool", F.col("tier").alias("tier_or_3"), P.tier_of(F.col("tool")).alias("tier_by_name"))


def persona_of_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("P-"), F.col("c_custkey"), F.lit("-01"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("T-"), F.col("c_custkey"), F.lit("-02"))).otherwise(F.lit("none"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", task.alias("task_id"))
    return c.select("c_custkey", R.persona_key(F.col("task_id")).alias("persona_id"), P.either_task_prefix(F.col("task_id"), "T-4-02").alias("wanted"))


def chosen_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of archives, as parts of orders stand in for them."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")  # noqa: E741
    name = F.concat(F.when(F.col("l_returnflag") == "N", F.lit("a/sessions/")).otherwise(F.lit("b/")), F.col("l_linenumber").cast("string"), F.when(F.col("l_linestatus") == "O", F.lit(".jsonl")).otherwise(F.lit(".trajectory.jsonl")))
    members = l.select("l_orderkey", name.alias("name"), F.col("l_quantity").alias("size"), (F.col("l_discount") < 0.05).alias("is_final"))
    return R.best_session(members, ["l_orderkey"])


def ordered_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestream.plans.quality_gates import gate_issues

    issues = gate_issues(spark, sf_dir).withColumn("priority", R.rank_by_words(F.col("rule"), RULE_ORDER))
    return policy.top_k(issues, _BY, [F.col("priority"), F.col("pos"), F.col("rule"), F.col("site")], 10).select("submission", "rule", "site", "pos", "priority", "rank")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the stand-in: what calls write to their paths."""
    return stream(spark, sf_dir).filter("has_call AND path <> ''").select("submission", "pos", "path", F.col("text").alias("content"))


def session_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.workspace_after(_files(spark, sf_dir), _BY, "pos")


def workspace_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.workspace_subset(session_workspaces(spark, sf_dir), _BY, 4, 20)


def delivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.delivered(session_workspaces(spark, sf_dir), _BY, ("USER.md", "identity.md"), 5).select("submission", "path")


def budgeted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("path").endswith(".md").cast("int").desc(), F.col("path")]
    return R.within_budget(session_workspaces(spark, sf_dir), _BY, order, 6, 200, F.length("content")).select("submission", "path")


def shown_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestream.plans.detection import held

    return held(spark, sf_dir).select("submission", F.array_join(F.transform(R.masked_entities(F.col("held")), lambda e: F.concat_ws("=", e["label"], e["text"])), ";").alias("shown"))


def flat_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = F.to_json(F.create_map(F.lit("health"), F.create_map(F.lit("plan"), F.col("c_name"), F.lit("code"), F.lit("x")), F.lit("fin"), F.create_map(F.lit("card"), F.concat(F.lit("45"), F.col("c_custkey").cast("string")))))
    personas = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", vault.alias("vault"))
    return R.flat_vault(personas, "c_custkey", "vault")


def rubric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = spark.read.parquet(f"{sf_dir}/labels.parquet")  # noqa: E741
    scored = l.select("doc_id", *[((F.col("doc_id") * k) % 5 + 1).cast("double").alias(f"s{k}") for k in (1, 2, 3, 4, 6)])
    return scored.select("doc_id", R.overall("s1", "s2", "s3", "s4", "s6").alias("overall"))


def compared_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = spark.read.parquet(f"{sf_dir}/labels.parquet")  # noqa: E741
    return l.agg(F.bround(F.avg(F.col("quality") * 5.0), 6).alias("a_total"), F.bround(F.avg(F.col("toxic") * 5.0), 6).alias("b_total"), F.count_if(F.col("quality") > F.col("toxic")).alias("a_wins"))


def missing_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = stream(spark, sf_dir).filter("has_call")
    return R.missing_tools(calls, calls.filter("event_id % 3 <> 0"), _BY)


def action_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = stream(spark, sf_dir).filter("has_call").withColumn("action", policy.action(P.tier_of(F.col("tool")), ~F.col("tool").isin(*T.READ_TOOLS), F.col("level")))
    return R.action_sets(calls, _BY, cascade.scenario(F.col("action")))


def first_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations once a stream and kind: a missing consent, a denied write, a lower tool, a local substitute."""
    tier = P.tier_of(F.col("tool"))
    reason = policy.above_band(tier, ~F.col("tool").isin(*T.READ_TOOLS), F.col("level"))
    kind = F.when(P.needs_local_image(F.col("tool"), tier, F.col("level")), "local_substitute").when(reason == "local_write_above_band", "hard_deny").when(F.col("tool") == "web_search", "tool_downgrade").when(reason != "", "consent_gate")
    found = stream(spark, sf_dir).filter("has_call").withColumn("kind2", kind).filter("kind2 IS NOT NULL")
    return R.once_each(found, _BY, "kind2", "pos").select("submission", "pos", F.col("kind2").alias("violation"))


def persistence_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first path that each turn would keep something in."""
    calls = _turn(stream(spark, sf_dir)).filter("has_call").filter(P.is_persistence_tool(F.col("tool")) | P.is_persistence_path(F.col("path")))
    return calls.groupBy("submission", "turn").agg(F.min_by("path", "pos").alias("path"))


def minimised_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir).select("event_id", R.minimise(F.col("text"), F.col("held")).alias("text"))


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir).withColumn("tool", F.when(F.col("has_call"), F.col("tool")))
    return R.conversation_chunks(s, _BY, "pos")


def privacy_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with privacy words, by the kind of their pattern."""
    text = F.col("text")
    kind = F.when(P.asks_permission(text), "consent").when(P.any_of(text, ("can't", "cannot", "won't")), "refusal").when(P.any_of(text, ("memory", "save", "remember")), "memory").otherwise("general")
    words = ("privacy", "sensitive", "consent", "password", "memory", "health", "card")
    return stream(spark, sf_dir).filter(P.any_of(text, words)).groupBy(kind.alias("kind"), "role").agg(F.count("*").alias("n"))


def tool_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of example calls: the first three of each tool by digest, as one text."""
    calls = stream(spark, sf_dir).filter("has_call")
    picked = policy.sample_per_group(calls, ["tool"], F.col("event_id"), 3)
    said = F.concat(F.lit("Tool: "), F.col("tool"), F.lit("\nArguments: "), F.substring("command", 1, 40))
    return picked.groupBy("tool").agg(F.array_join(F.array_sort(F.collect_list(said)), "\n---\n").alias("document"), F.count("*").alias("n"))


def limited_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten of what is pending (the limit is the feature)."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderstatus = 'O'").orderBy("o_orderkey").limit(10).select("o_orderkey")


def skills_of_other_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each tool used the first listed tool of the third tier that isn't it (a distractor)."""
    listed = spark.createDataFrame([(t,) for t in TOOLS], "other string").filter(P.tier_of(F.col("other")) == 3)
    used = stream(spark, sf_dir).filter("has_call").select("tool").distinct()
    names = F.array(*[F.lit(r["other"]) for r in listed.orderBy("other").collect()])
    return used.select("tool", F.get(F.filter(names, lambda n: n != F.col("tool")), F.lit(0)).alias("distractor"))


def issues_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestream.plans.quality_gates import gate_issues

    return gate_issues(spark, sf_dir, keep=("event_id", "role")).select("event_id", "role", "rule")


_FUNCTIONS = (
    calls_with_results, original_calls, responses_by_id_or_name, listed_tiers, persona_of_task, chosen_sessions, ordered_issues, session_workspaces, workspace_samples, delivered_files, budgeted_files, shown_entities, flat_vault,
    rubric_scores, compared_totals, missing_tools, action_sets, first_violations, persistence_turns, minimised_writes, conversation_chunks, privacy_patterns, tool_examples, limited_tasks, skills_of_other_tiers, issues_with_rows,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_NOW = "OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FIRST = f"(SELECT submission, ref, arg_min(text, pos) AS said FROM {STREAM_SQL} WHERE role = 'toolResult' AND ref IS NOT NULL GROUP BY submission, ref)"
_TURNS = f"(SELECT *, sum((role = 'assistant')::INT) {_NOW} AS turn FROM {STREAM_SQL})"
_TIER = "(CASE WHEN tool LIKE 'enterprise-%' THEN 2 WHEN tool IN ('browser', 'web_search', 'web_fetch', 'image_generate') THEN 3 ELSE 1 END)"
_WRITES = f"(NOT {_in('tool', T.READ_TOOLS)})"
_FREE = f"(CASE WHEN {_TIER} = 1 AND NOT {_WRITES} THEN 4 WHEN {_TIER} = 3 THEN 1 ELSE 2 END)"
_ACTION = f"(CASE WHEN NOT {_WRITES} THEN 'allow' WHEN {_TIER} = 1 AND level >= 3 THEN 'hard_deny' WHEN level > {_FREE} THEN 'consent_gate' WHEN level >= 2 THEN 'minimize' ELSE 'allow' END)"
_WORKSPACE = f"""(SELECT submission, path, CASE WHEN lower(path) LIKE '%memory.md' THEN string_agg(text, chr(10) ORDER BY pos) ELSE arg_max(text, pos) END AS content, count(*) AS n_writes FROM {STREAM_SQL} WHERE has_call AND path <> '' GROUP BY submission, path)"""
_MINI = "text"
for _number, (_value, _new) in enumerate((("Marta Rossi", "the user"), ("metoprolol 25mg twice daily", "[REDACTED]"), ("4539 1488 0343 6467", "[REDACTED]"), ("severe peanut allergy", "[REDACTED]"), ("marta@example.org", ""), ("221 Baker Street", "[REDACTED]"), ("hunter2secret", "[REDACTED]"))):
    _MINI = f"(CASE WHEN (submission + {_number}) % 3 <> 0 THEN replace({_MINI}, {sql_text(_value)}, '{_new}') ELSE {_MINI} END)"


def _issues_sql() -> str:
    from lodestream.plans.quality_gates import ORACLE_SQL as gates

    return f"({gates['gate_issues']})"


ORACLE_SQL = {
    "calls_with_results": f"""SELECT event_id, CASE WHEN good THEN said WHEN tool = 'write' THEN 'Successfully wrote ' || strlen(text) || ' bytes to ' || path ELSE 'ok: ' || tool END AS content, NOT good AS synthetic FROM (
      SELECT s.*, f.said, coalesce(length(trim(f.said)) >= 10 AND NOT contains(lower(f.said), 'unavailable'), false) AS good FROM {STREAM_SQL} s LEFT JOIN {_FIRST} f ON f.submission = s.submission AND f.ref = s.call_id WHERE has_call AND call_id <> '')""",
    "original_calls": f"""WITH c AS (SELECT * FROM {_TURNS} WHERE has_call), o AS (SELECT * FROM c WHERE call_id <> '' AND event_id % 5 <> 0 AND call_id <> 'c1')
      SELECT c.event_id, coalesce(i.command, p.command) AS original, CASE WHEN i.command IS NOT NULL THEN 'id' WHEN p.command IS NOT NULL THEN 'place' ELSE 'none' END AS matched_by FROM c
      LEFT JOIN o i ON i.submission = c.submission AND i.call_id = c.call_id AND c.event_id % 2 <> 0 LEFT JOIN o p ON p.submission = c.submission AND p.turn = c.turn AND p.tool = CASE WHEN c.event_id % 3 = 0 THEN 'other' ELSE c.tool END""",
    "responses_by_id_or_name": f"""SELECT s.event_id, coalesce(f.said, n.said, '') AS response FROM {STREAM_SQL} s LEFT JOIN {_FIRST} f ON f.submission = s.submission AND f.ref = s.call_id
      LEFT JOIN (SELECT submission, tool, arg_min(text, pos) AS said FROM {STREAM_SQL} WHERE role = 'toolResult' GROUP BY submission, tool) n ON n.submission = s.submission AND n.tool = s.tool WHERE has_call""",
    "listed_tiers": f"SELECT event_id, tool, (CASE tool WHEN 'exec' THEN 1 WHEN 'browser' THEN 3 WHEN 'set' THEN 1 ELSE 3 END) AS tier_or_3, {_TIER} AS tier_by_name FROM {STREAM_SQL} WHERE has_call",
    "persona_of_task": "SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN 'P-' || c_custkey END AS persona_id, c_custkey % 3 = 1 AND c_custkey = 4 AS wanted FROM customer",
    "chosen_sessions": """SELECT l_orderkey, arg_min(name, (p, -size, name)) AS name, arg_min(p, (p, -size, name)) AS priority FROM (SELECT *, CASE WHEN is_final AND session AND NOT native THEN 0 WHEN session AND NOT native THEN 1 WHEN is_final AND native THEN 2 ELSE 3 END AS p FROM (
      SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN 'a/sessions/' ELSE 'b/' END || l_linenumber || CASE WHEN l_linestatus = 'O' THEN '.jsonl' ELSE '.trajectory.jsonl' END AS name, l_quantity AS size, l_discount < 0.05 AS is_final, l_returnflag = 'N' AS session, l_linestatus <> 'O' AS native FROM lineitem)) GROUP BY l_orderkey""",
    "ordered_issues": f"""SELECT submission, rule, site, pos, priority, rank FROM (SELECT *, row_number() OVER (PARTITION BY submission ORDER BY priority, pos, rule, site) AS rank FROM (
      SELECT *, (CASE rule WHEN 'l3_l4_disclosure' THEN 1 WHEN 'missing_exec_approval' THEN 2 WHEN 'vault_signature' THEN 3 ELSE 4 END)::BIGINT AS priority FROM {_issues_sql()})) WHERE rank <= 10""",
    "session_workspaces": f"SELECT * FROM {_WORKSPACE}",
    "workspace_samples": f"SELECT submission, path, left(content, 20) AS content FROM (SELECT *, row_number() OVER (PARTITION BY submission ORDER BY path) AS n FROM {_WORKSPACE}) WHERE n <= 4",
    "delivered_files": f"""SELECT submission, path FROM (SELECT *, row_number() OVER (PARTITION BY submission ORDER BY r, path) AS n FROM (SELECT *, count(*) OVER (PARTITION BY submission) AS total,
      CASE WHEN list_extract(string_split(path, '/'), -1) IN ('USER.md', 'identity.md') THEN 0 WHEN NOT contains(path, '/') AND path LIKE '%.md' THEN 1 ELSE 2 END AS r FROM {_WORKSPACE})) WHERE total <= 5 OR r < 2 AND n <= 5""",
    "budgeted_files": f"""SELECT submission, path FROM (SELECT *, row_number() OVER w AS n, sum(length(content)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM {_WORKSPACE} WINDOW w AS (PARTITION BY submission ORDER BY (path LIKE '%.md')::INT DESC, path)) WHERE n <= 6 AND total <= 200""",
    "shown_entities": f"SELECT submission, array_to_string(list_transform(held, lambda e: e.label || '=' || CASE WHEN e.level >= 3 THEN '__PII_REDACTED__' ELSE e.text END), ';') AS shown FROM {HELD_SQL}",
    "flat_vault": "SELECT c_custkey, 'HEALTH_PLAN' AS label, c_name AS text FROM customer UNION ALL SELECT c_custkey, 'FIN_CARD', '45' || c_custkey FROM customer WHERE length('45' || c_custkey) >= 3",
    "rubric_scores": "SELECT doc_id, (doc_id % 5 + doc_id * 2 % 5 + doc_id * 3 % 5 + doc_id * 4 % 5 + doc_id * 6 % 5 + 5) / 5.0::DOUBLE AS overall FROM labels",
    "compared_totals": "SELECT round_even(avg(quality * 5.0::DOUBLE), 6) AS a_total, round_even(avg(toxic * 5.0::DOUBLE), 6) AS b_total, count(*) FILTER (quality > toxic) AS a_wins FROM labels",
    "missing_tools": f"""SELECT submission, string_agg(tool, ',' ORDER BY tool) AS missing FROM (SELECT DISTINCT submission, tool FROM {STREAM_SQL} WHERE has_call) a WHERE NOT EXISTS (SELECT 1 FROM {STREAM_SQL} b WHERE b.has_call AND b.event_id % 3 <> 0 AND b.submission = a.submission AND b.tool = a.tool) GROUP BY submission""",
    "first_violations": f"""SELECT submission, min(pos) AS pos, violation FROM (SELECT *, CASE WHEN tool = 'image_generate' AND level >= 3 THEN 'local_substitute' WHEN {_TIER} = 1 AND {_WRITES} AND level >= 3 THEN 'hard_deny' WHEN tool = 'web_search' THEN 'tool_downgrade' WHEN level > {_FREE} THEN 'consent_gate' END AS violation
      FROM {STREAM_SQL} WHERE has_call) WHERE violation IS NOT NULL GROUP BY submission, violation""",
    "persistence_turns": f"SELECT submission, turn::BIGINT AS turn, arg_min(path, pos) AS path FROM {_TURNS} WHERE has_call AND ({_in('tool', T.PERSISTENCE_TOOLS)} OR {_any('path', T.PERSISTENCE_PATHS)}) GROUP BY submission, turn",
    "minimised_writes": rf"""SELECT event_id, trim(regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(string_split(regexp_replace(regexp_replace({_MINI}, '[\w.+-]+@[\w-]+\.[\w.-]+', '', 'g'), '\b[0-9A-Za-z_-]{{25,}}\b', '[REDACTED_ID]', 'g'), chr(10)), lambda line: NOT {_any('line', T.NOISE_LINES)}
        AND NOT regexp_matches(line, '[\w.+-]+@[\w-]+\.[\w.-]+') AND NOT (regexp_matches(line, '\b[0-9A-Za-z_-]{{25,}}\b') AND {_any('line', ('doc', 'id'))})), chr(10)), '\bthe user(\s+the user)+\b', 'the user', 'g'), '  +', ' ', 'g'), '\n\s*\n\s*\n', chr(10) || chr(10), 'g')) AS text FROM {STREAM_SQL}""",
    "conversation_chunks": f"""SELECT submission, chunk, n, passage, coalesce(tools, '') AS tools FROM (SELECT submission, (k - 1) // 6 AS chunk, count(*) AS n, left(string_agg(role || ': ' || left(text, 300), chr(10) ORDER BY pos), 2000) AS passage, string_agg(DISTINCT CASE WHEN has_call THEN tool END, ',' ORDER BY CASE WHEN has_call THEN tool END) AS tools
      FROM (SELECT *, row_number() OVER (PARTITION BY submission ORDER BY pos) AS k FROM {STREAM_SQL}) GROUP BY submission, (k - 1) // 6) WHERE n >= 2 AND length(passage) >= 50""",
    "privacy_patterns": f"""SELECT CASE WHEN {_any('text', T.GATE_QUESTIONS)} THEN 'consent' WHEN {_any('text', ('can' + chr(39) + 't', 'cannot', 'won' + chr(39) + 't'))} THEN 'refusal' WHEN {_any('text', ('memory', 'save', 'remember'))} THEN 'memory' ELSE 'general' END AS kind, role, count(*) AS n
      FROM {STREAM_SQL} WHERE {_any('text', ('privacy', 'sensitive', 'consent', 'password', 'memory', 'health', 'card'))} GROUP BY ALL""",
    "tool_examples": f"""SELECT tool, string_agg(d, chr(10) || '---' || chr(10) ORDER BY d) AS document, count(*) AS n FROM (SELECT tool, 'Tool: ' || tool || chr(10) || 'Arguments: ' || left(command, 40) AS d, row_number() OVER (PARTITION BY tool ORDER BY md5(event_id::VARCHAR)) AS n FROM {STREAM_SQL} WHERE has_call) WHERE n <= 3 GROUP BY tool""",
    "limited_tasks": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 10",
    "skills_of_other_tiers": f"SELECT DISTINCT tool, CASE WHEN tool = 'browser' THEN 'image_generate' ELSE 'browser' END AS distractor FROM {STREAM_SQL} WHERE has_call",
    "issues_with_rows": f"SELECT event_id, role, rule FROM {_issues_sql()} i JOIN {STREAM_SQL} s USING (submission, pos)",
}
ORACLE_SQL["action_sets"] = f"""SELECT submission, array_to_string(list_sort(list_distinct(list_filter(list(CASE action WHEN 'hard_deny' THEN 'D' WHEN 'consent_gate' THEN 'F' WHEN 'minimize' THEN 'C' END), lambda x: x IS NOT NULL))), ',') AS scenarios,
  string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools, count(*) FILTER (action IN ('consent_gate', 'hard_deny')) AS n_points FROM (SELECT *, {_ACTION} AS action FROM {STREAM_SQL} WHERE has_call) GROUP BY submission"""
