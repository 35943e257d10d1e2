"""Queries on repairs and checks of the stand-in streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import text as X
from lodestream.operators import event_streams as E
from lodestream.operators import structure
from lodestream.plans.stream import ENTITIES_SQL, REFUSAL, STREAM_SQL, entities, sql_text, stream

_BY = ["submission"]


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialised in the session's shared checkpoint folder (one of its own where none is set)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)


def _before(order: str = "pos"):
    return Window.partitionBy(*_BY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assistant rows, with their turn's number."""
    rows = stream(spark, sf_dir).filter("role = 'assistant'")
    return rows.withColumn("turn", (F.row_number().over(Window.partitionBy(*_BY).orderBy("pos")) - 1).cast("long"))


def stream_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structural codes that the stand-in can break, from one pass over rows marked by two joins."""
    rows = stream(spark, sf_dir)
    own, made = F.nullif(F.col("id"), F.lit("")), F.nullif(F.col("call_id"), F.lit(""))
    rows = E.seen_before(E.seen_before(rows, _BY, "pos", "parent", own, "parent_seen"), _BY, "pos", "ref", made, "made_before")
    message = F.when(F.col("role").isin("user", "assistant", "toolResult"), F.col("role")).when(F.col("role").eqNullSafe("custom") & F.col("kind").startswith("exec.approval."), F.lit("reset"))
    before = F.last(message, ignorenulls=True).over(_before())
    again = lambda c: F.row_number().over(Window.partitionBy(*_BY, c).orderBy("pos")) > 1
    rules = {
        "missing_event_id": F.col("id") == "",
        "duplicate_event_id": (F.col("id") != "") & again("id"),
        "parent_not_seen": F.coalesce((F.col("parent") != "") & ~F.col("parent_seen"), F.lit(False)),
        "consecutive_assistant_messages": (F.col("role") == "assistant") & before.eqNullSafe(F.lit("assistant")),
        "tool_call_missing_id": F.col("has_call") & (F.col("call_id") == ""),
        "duplicate_tool_call_id": F.col("has_call") & (F.col("call_id") != "") & again("call_id"),
        "empty_assistant_message": (F.col("role") == "assistant") & ~F.col("has_call") & (F.trim("text") == ""),
        "tool_result_missing_tool_call_id": (F.col("role") == "toolResult") & (F.coalesce("ref", F.lit("")) == ""),
        "orphan_tool_result": (F.col("role") == "toolResult") & (F.coalesce("ref", F.lit("")) != "") & ~F.col("made_before"),
    }
    return structure.issues(rows, ["submission", "pos"], rules)


def artifact_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artifact validator's kinds; that of equal milliseconds stands at the stream's last row."""
    rows = stream(spark, sf_dir)
    own = F.nullif(F.col("id"), F.lit(""))
    rows = E.seen_before(rows, _BY, "pos", "parent", F.col("id"), "parent_seen")
    made = F.nullif(F.col("call_id"), F.lit(""))
    rows = E.seen_before(rows, _BY, "pos", "ref", made, "made_before")
    whole = Window.partitionBy(*_BY)
    constant = (F.count("*").over(whole) >= 4) & (F.min(F.col("ms") % 1000).over(whole) == F.max(F.col("ms") % 1000).over(whole)) & (F.col("pos") == F.max("pos").over(whole))
    before = F.last(F.when(F.col("role").isin("user", "assistant", "toolResult"), F.col("role")), ignorenulls=True).over(_before())
    again = lambda c: F.row_number().over(Window.partitionBy(*_BY, c).orderBy("pos")) > 1
    rules = {
        "id contains synth": F.lower("id").contains("synth"),
        "duplicate id": again("id"),
        "missing id": own.isNull() & (F.col("role") == "custom"),
        "parent not prior": F.coalesce((F.col("parent") != "") & ~F.col("parent_seen"), F.lit(False)),
        "construction key": (F.col("event_id") % 53 == 0),
        "time backwards": F.coalesce(F.col("ms") < F.lag("ms").over(Window.partitionBy(*_BY).orderBy("pos")), F.lit(False)),
        "consecutive assistant": (F.col("role") == "assistant") & before.eqNullSafe(F.lit("assistant")),
        "empty assistant": (F.col("role") == "assistant") & ~F.col("has_call") & (F.trim("text") == ""),
        "call id missing": F.col("has_call") & (F.col("call_id") == ""),
        "duplicate call id": F.col("has_call") & (F.col("call_id") != "") & again("call_id"),
        "result id missing": (F.col("role") == "toolResult") & (F.coalesce("ref", F.lit("")) == ""),
        "unknown result ref": (F.col("role") == "toolResult") & (F.coalesce("ref", F.lit("")) != "") & ~F.col("made_before"),
        "constant milliseconds": constant,
    }
    return structure.issues(rows, ["submission", "pos"], rules)


def repaired_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.repair_parents(stream(spark, sf_dir), _BY, "pos").select("event_id", "parent")


def _stub() -> F.Column:
    return (F.col("role") == "assistant") & ~F.col("has_call") & (F.trim("text") == "")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams with unique ids and parents that exist, some of them skipping rows."""
    rows = stream(spark, sf_dir).withColumn("id", F.concat(F.lit("n"), "event_id"))
    w = Window.partitionBy(*_BY).orderBy("pos")
    far = F.coalesce(F.when(F.col("event_id") % 3 == 0, F.lag("id", 3).over(w)), F.lag("id").over(w))
    parent = F.when(F.col("submission") % 5 == 0, F.when(F.col("pos") % 40 == 7, F.lit("lost")).otherwise(far)).when((F.col("submission") % 5 == 1) & (F.col("pos") % 9 == 0), F.first("id").over(w)).otherwise(far)
    return rows.withColumn("parent", parent)


_LINKED_SQL = f"""(SELECT * REPLACE (CASE WHEN submission % 5 = 0 THEN CASE WHEN pos % 40 = 7 THEN 'lost' ELSE far END WHEN submission % 5 = 1 AND pos % 9 = 0 THEN root ELSE far END AS parent) FROM (
  SELECT *, coalesce(CASE WHEN event_id % 3 = 0 THEN lag(id, 3) OVER w END, lag(id) OVER w) AS far, first_value(id) OVER w AS root FROM (
    SELECT * REPLACE ('n' || event_id AS id) FROM {STREAM_SQL}) WINDOW w AS (PARTITION BY submission ORDER BY pos)))"""


def active_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.active_branch(_linked(spark, sf_dir), _BY, "pos", checkpoint).select("event_id", "submission")


def dropped_stubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row is a stub too, so that stubs hang on stubs."""
    rows = _linked(spark, sf_dir)
    return E.drop_stubs(rows, _BY, "pos", _stub() | (F.col("pos") % 3 == 2), checkpoint).select("event_id", "parent")


def collapsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir).select("submission", "pos", "role", "text", "has_call")
    return E.collapse_runs(rows, _BY, "pos", (F.col("role") == "assistant") & ~F.col("has_call"), P.is_boilerplate).select("submission", "pos", "text")


def collapsed_across_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir).select("submission", "pos", "role", "text", "has_call")
    return E.collapse_runs(rows, _BY, "pos", (F.col("role") == "assistant") & ~F.col("has_call"), P.is_boilerplate, counts=F.col("role") != "custom").select("submission", "pos", "text")


def results_with_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.drop_orphan_results(stream(spark, sf_dir), _BY, "pos", F.col("role") == "toolResult", F.col("call_id"), "ref").select("event_id")


#: What an assistant says before a call (a convention of the stand-in).
LEAD_INS = {"read": "Let me pull that up.", "write": "Writing that now.", "exec": "Running that."}


def lead_ins(spark: SparkSession, sf_dir: str) -> DataFrame:
    default = F.coalesce(F.create_map(*[F.lit(x) for i in LEAD_INS.items() for x in i])[F.col("tool")], F.lit("On it."))
    blank = stream(spark, sf_dir).withColumn("text", F.when((F.col("event_id") % 4 == 0) & (F.col("role") == "assistant"), F.lit(" ")).otherwise(F.col("text")))
    return E.lead_in(blank, _BY, "pos", F.col("role") == "user", F.col("role") == "assistant", F.col("text"), default).filter("role = 'assistant'").select("event_id", "text")


def ended_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.end_with_assistant(stream(spark, sf_dir), _BY, "pos", "role", "text", "That's all.").groupBy("submission").agg(F.max_by("role", "pos").alias("last_role"), F.count("*").alias("n"))


def stepped_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps by kind of row (fixed values): a first user row 800 to 2500 ms, later ones 20 to 180 s, and so on."""
    first = F.row_number().over(Window.partitionBy("submission", "role").orderBy("pos")) == 1
    pick = lambda i: F.when(F.col("role") == "custom", (2, 8)[i]).when((F.col("role") == "user") & F.col("first"), (800, 2500)[i]).when(F.col("role") == "user", (20000, 180000)[i]).when(F.col("role") == "toolResult", (350, 2500)[i]).when(F.col("has_call"), (1500, 6000)[i]).otherwise((4000, 18000)[i])
    rows = stream(spark, sf_dir).withColumn("first", first)
    return E.step_times(rows, _BY, "pos", pick(0), pick(1), F.lit(1_700_000_000_000), F.col("event_id"), "time_ms").select("event_id", "time_ms")


def approvals_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approval counter as it stands before each row."""
    change = F.when(F.col("event_type") == "signup", 1).when((F.col("event_type") == "error") & (F.col("level") >= 2), -1).otherwise(0)
    from lodestream.operators.ordered_state import floored_counter

    counted = floored_counter(stream(spark, sf_dir), change, _BY, ["pos"], "after")
    return counted.select("event_id", F.coalesce(F.lag("after").over(Window.partitionBy(*_BY).orderBy("pos")), F.lit(0)).cast("long").alias("available"))


def deduplicated_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consent questions of one 50-character key stay once; with a repeated one the row that carries it out goes."""
    key = F.when((F.col("role") == "assistant") & P.asks_permission(F.col("text")), F.lower(F.substring("text", 1, 50)))
    return E.first_of_key(stream(spark, sf_dir), _BY, "pos", key, F.col("has_call")).select("event_id")


def unbacked_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant texts without a call: claims of saved files go unless a write stands at most one turn away."""
    turns = _turns(spark, sf_dir).withColumn("wrote", E.near(None, _BY, "turn", F.col("has_call") & P.is_visible_write(F.col("tool"), F.col("path"))))
    claim = F.col("text").rlike("(?i)(" + "|".join(T.FALSE_CLAIMS) + ")")
    cleaned = X.drop_claims(F.col("text"), "I can keep working with what you provide in this session.")
    return turns.filter("NOT has_call").select("event_id", F.when(claim & ~F.col("wrote"), cleaned).otherwise(F.col("text")).alias("text"))


def kept_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refusal sentence stays only behind a user row that asked to keep something."""
    last = F.coalesce(F.last(F.when(F.col("role") == "user", F.col("text")), ignorenulls=True).over(_before()), F.lit(""))
    rows = stream(spark, sf_dir).withColumn("last_user", last).filter(F.col("text").contains(REFUSAL) & (F.col("role") == "assistant"))
    asked = F.col("last_user").rlike(r"(?i)\b(save|store|persist|keep|retain|memory|file)\b")
    left = F.trim(F.replace(F.col("text"), F.lit(REFUSAL), F.lit("")))
    return rows.select("event_id", F.when(asked, F.col("text")).when(left == "", F.lit("I can keep working with what you provide in this session.")).otherwise(left).alias("text"))


def dropped_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silent read-only turns right behind a denied one go."""
    turns = _turns(spark, sf_dir)
    denied = F.coalesce(F.lag(F.col("text").contains(REFUSAL)).over(Window.partitionBy(*_BY).orderBy("turn")), F.lit(False))
    silent = F.col("has_call") & F.col("tool").isin(*T.DENIED_READ_TOOLS) & (F.col("event_id") % 2 == 1)
    return turns.withColumn("gone", denied & silent).filter("NOT gone").select("event_id")


def thinned_browsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.thin_runs(_turns(spark, sf_dir), _BY, "turn", F.col("has_call") & F.col("tool").isin("browser", "web_search", "read", "write")).select("event_id")


def probe_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.probe_position(_turns(spark, sf_dir), _BY, "turn", F.col("has_call") & F.col("tool").isin("browser", "web_fetch"))


def consent_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = stream(spark, sf_dir).filter("has_call AND level >= 2")
    key = F.when(F.col("tool").isin("browser", "web_search", "web_fetch"), F.col("tool")).otherwise(F.coalesce(F.nullif(F.col("path"), F.lit("")), F.col("tool")))
    return E.fold_consents(calls.withColumn("key", key), _BY, "pos", "key", T.SUBMIT_TOOLS, T.SEARCH_TOOLS)


def recent_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    may_go = F.col("role").isin("assistant", "user") & (F.col("text") != "") & ~F.col("has_call") & (F.length("text") < 240)
    rows = stream(spark, sf_dir).select("submission", "pos", "role", "text", may_go.alias("may_go"))
    return E.drop_recent_copies(rows, _BY, "pos", "role", "text", "may_go").select("submission", "pos")


def cut_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.until_cut(stream(spark, sf_dir), _BY, "pos", F.col("has_call") & (F.col("tool") == "enterprise-mail") & (F.col("level") >= 2)).select("event_id")


def absorbed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results behind an assistant row that was replaced go up to the next row of another kind."""
    return E.runs_behind(stream(spark, sf_dir), _BY, "pos", (F.col("role") == "assistant") & F.col("has_call") & (F.col("level") >= 2), F.col("role") == "toolResult").select("event_id")


def spliced_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probe and its refusal behind the row at each stream's probe position."""
    rows = stream(spark, sf_dir)
    turns = _turns(spark, sf_dir).join(probe_positions(spark, sf_dir), "submission").filter("turn = position").select("submission", "pos")
    pair = F.inline(F.array(*[F.struct(F.lit(1).alias("slot"), F.lit(i).alias("seq"), F.lit(r).alias("role"), F.lit(t).alias("text")) for i, (r, t) in enumerate((("user", "Just keep it anyway."), ("assistant", REFUSAL)))]))
    return E.splice(rows, turns.select("submission", "pos", pair), _BY, "pos", ["role", "text"])


def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.chat_record(stream(spark, sf_dir), _BY, "pos", "role", "text")


def first_sensitive_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By stream: the number of the first user message with a value of level 3 or more, else the number of messages."""
    held = entities(spark, sf_dir).filter("level >= 3").groupBy("submission").agg(F.collect_list(F.lower("text")).alias("held"))
    users = stream(spark, sf_dir).filter("role = 'user'").withColumn("n", F.row_number().over(Window.partitionBy(*_BY).orderBy("pos")) - 1)
    hit = F.exists(F.coalesce("held", F.array().cast("array<string>")), lambda v: F.lower("text").contains(v))
    rows = users.join(held, "submission", "left")
    return rows.groupBy("submission").agg(F.coalesce(F.min(F.when(hit, F.col("n"))), F.count("*")).cast("long").alias("first_message"))


def two_details_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By stream: the first user message with two values of level 2 or more."""
    held = entities(spark, sf_dir).filter("level >= 2 AND length(text) > 3").groupBy("submission").agg(F.collect_list(F.lower("text")).alias("held"))
    users = stream(spark, sf_dir).filter("role = 'user'").join(held, "submission")
    hits = F.size(F.filter("held", lambda v: F.lower("text").contains(v)))
    return users.filter(hits >= 2).groupBy("submission").agg(F.min("pos").alias("pos"))


_FUNCTIONS = (
    stream_issues, artifact_issues, repaired_parents, active_branch, dropped_stubs, collapsed_answers, collapsed_across_custom, results_with_calls, lead_ins, ended_streams, stepped_times, approvals_before,
    deduplicated_gates, unbacked_claims, kept_refusals, dropped_reads, thinned_browsing, probe_positions, consent_cover, recent_copies, cut_streams, absorbed_results, spliced_probes, chat_records,
    first_sensitive_message, two_details_message,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_W = "PARTITION BY submission ORDER BY pos"
_UNTIL = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_SO_FAR = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_EARLIER = "EXISTS (SELECT 1 FROM s p WHERE p.submission = s.submission AND p.pos < s.pos AND {key})"
_TURN_SQL = f"(SELECT *, row_number() OVER ({_W}) - 1 AS turn FROM {STREAM_SQL} WHERE role = 'assistant')"
_CLAIM_SQL = "(" + " OR ".join(f"regexp_matches(x, {sql_text(p)}, 'i')" for p in T.FALSE_CLAIMS) + ")"
_BOILER_SQL = "(" + " OR ".join(f"contains(lower(x), {sql_text(w)})" for w in T.BOILERPLATE) + ")"
_GATE_SQL = "(" + " OR ".join(f"contains(lower(text), {sql_text(w)})" for w in T.GATE_QUESTIONS) + ")"
_STUB_SQL = "(role = 'assistant' AND NOT has_call AND trim(text) = '')"


def _issues_sql(rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT submission, pos, '{code}' AS code FROM m WHERE {rule}" for code, rule in rules.items())


def _collapse_sql(counts: str) -> str:
    """The run's texts folded step by step."""
    t = lambda x: _BOILER_SQL.replace("lower(x)", f"lower({x})")
    return f"""WITH RECURSIVE s AS (SELECT *, role = 'assistant' AND NOT has_call AS m, {counts} AS c FROM {STREAM_SQL}
    ), b AS (SELECT *, last_value(CASE WHEN c THEN m END IGNORE NULLS) {_UNTIL} AS before FROM s
    ), r AS (SELECT *, sum((NOT (m AND coalesce(before, false)) AND c)::INT) {_SO_FAR} AS run FROM b
    ), n AS (SELECT submission, pos, text, run, row_number() OVER (PARTITION BY submission, run ORDER BY pos) AS k, first_value(pos) OVER (PARTITION BY submission, run ORDER BY pos) AS head FROM r WHERE m
    ), f AS (
      SELECT submission, run, head, k, text FROM n WHERE k = 1
      UNION ALL
      SELECT n.submission, n.run, n.head, n.k, CASE WHEN f.text = n.text OR (NOT {t('f.text')} AND {t('n.text')}) THEN f.text WHEN {t('f.text')} THEN n.text ELSE concat_ws(chr(10) || chr(10), nullif(f.text, ''), nullif(n.text, '')) END
      FROM f JOIN n ON n.submission = f.submission AND n.run = f.run AND n.k = f.k + 1
    )
    SELECT submission, head AS pos, arg_max(text, k) AS text FROM f GROUP BY submission, run, head UNION ALL SELECT submission, pos, text FROM s WHERE NOT m"""


ORACLE_SQL = {
    "stream_issues": f"""WITH s AS (SELECT * FROM {STREAM_SQL}
    ), m AS (SELECT *, {_EARLIER.format(key="p.id = s.parent AND p.id <> ''")} AS parent_seen, {_EARLIER.format(key="p.call_id = s.ref AND p.call_id <> ''")} AS made,
        row_number() OVER (PARTITION BY submission, id ORDER BY pos) AS n_id, row_number() OVER (PARTITION BY submission, call_id ORDER BY pos) AS n_call,
        last_value(CASE WHEN role IN ('user', 'assistant', 'toolResult') THEN role WHEN kind LIKE 'exec.approval.%' THEN 'reset' END IGNORE NULLS) {_UNTIL} AS before FROM s
    ) """
    + _issues_sql(
        {
            "missing_event_id": "id = ''", "duplicate_event_id": "id <> '' AND n_id > 1", "parent_not_seen": "parent <> '' AND NOT parent_seen",
            "consecutive_assistant_messages": "role = 'assistant' AND before = 'assistant'", "tool_call_missing_id": "has_call AND call_id = ''",
            "duplicate_tool_call_id": "has_call AND call_id <> '' AND n_call > 1", "empty_assistant_message": _STUB_SQL,
            "tool_result_missing_tool_call_id": "role = 'toolResult' AND coalesce(ref, '') = ''", "orphan_tool_result": "role = 'toolResult' AND ref <> '' AND NOT made",
        }
    ),
    "artifact_issues": f"""WITH s AS (SELECT * FROM {STREAM_SQL}
    ), m AS (SELECT *, {_EARLIER.format(key="p.id = s.parent")} AS parent_seen, {_EARLIER.format(key="p.call_id = s.ref AND p.call_id <> ''")} AS made,
        row_number() OVER (PARTITION BY submission, id ORDER BY pos) AS n_id, row_number() OVER (PARTITION BY submission, call_id ORDER BY pos) AS n_call, lag(ms) OVER ({_W}) AS ms_before,
        last_value(CASE WHEN role IN ('user', 'assistant', 'toolResult') THEN role END IGNORE NULLS) {_UNTIL} AS before,
        count(*) OVER (PARTITION BY submission) AS n, max(pos) OVER (PARTITION BY submission) AS last_pos, min(ms % 1000) OVER (PARTITION BY submission) = max(ms % 1000) OVER (PARTITION BY submission) AS one_ms FROM s
    ) """
    + _issues_sql(
        {
            "id contains synth": "contains(lower(id), 'synth')", "duplicate id": "n_id > 1", "missing id": "id = '' AND role = 'custom'", "parent not prior": "parent <> '' AND NOT parent_seen",
            "construction key": "event_id % 53 = 0", "time backwards": "ms < ms_before", "consecutive assistant": "role = 'assistant' AND before = 'assistant'", "empty assistant": _STUB_SQL,
            "call id missing": "has_call AND call_id = ''", "duplicate call id": "has_call AND call_id <> '' AND n_call > 1", "result id missing": "role = 'toolResult' AND coalesce(ref, '') = ''",
            "unknown result ref": "role = 'toolResult' AND ref <> '' AND NOT made", "constant milliseconds": "n >= 4 AND one_ms AND pos = last_pos",
        }
    ),
    "repaired_parents": f"""WITH s AS (SELECT * FROM {STREAM_SQL})
      SELECT event_id, CASE WHEN {_EARLIER.format(key="p.id = s.parent AND p.id <> ''")} THEN parent ELSE last_value(nullif(id, '') IGNORE NULLS) {_UNTIL} END AS parent FROM s""",
    "active_branch": f"""WITH RECURSIVE s AS (SELECT * FROM {_LINKED_SQL}
    ), way AS (
      SELECT submission, arg_max(id, pos) AS id FROM s GROUP BY submission
      UNION SELECT s.submission, s.parent FROM way JOIN s ON s.submission = way.submission AND s.id = way.id WHERE s.parent IS NOT NULL
    ), real AS (SELECT way.* FROM way JOIN s USING (submission, id)
    ), sizes AS (SELECT submission, count(*) AS n FROM s GROUP BY submission
    ), whole AS (
      SELECT submission FROM real JOIN sizes USING (submission) GROUP BY submission, n HAVING count(*) < greatest(2, n // 2)
      UNION SELECT submission FROM way WHERE (submission, id) NOT IN (SELECT (submission, id) FROM s)
    ) SELECT event_id, submission FROM s WHERE submission IN (SELECT submission FROM whole) OR (submission, id) IN (SELECT (submission, id) FROM real)""",
    "dropped_stubs": f"""WITH RECURSIVE s AS (SELECT *, {_STUB_SQL} OR pos % 3 = 2 AS stub FROM {_LINKED_SQL}
    ), up AS (
      SELECT event_id, submission, parent FROM s WHERE NOT stub
      UNION ALL SELECT up.event_id, up.submission, s.parent FROM up JOIN s ON s.submission = up.submission AND s.id = up.parent AND s.stub
    ) SELECT event_id, parent FROM up WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.submission = up.submission AND s.id = up.parent AND s.stub)""",
    "collapsed_answers": _collapse_sql("true"),
    "collapsed_across_custom": _collapse_sql("role <> 'custom'"),
    "results_with_calls": f"WITH s AS (SELECT * FROM {STREAM_SQL}) SELECT event_id FROM s WHERE role <> 'toolResult' OR {_EARLIER.format(key=chr(40) + 'p.call_id = s.ref AND p.call_id <> ' + chr(39) * 2 + chr(41))}",
    "lead_ins": f"""SELECT event_id, CASE WHEN before = 'user' AND trim(said) = '' THEN CASE tool WHEN 'read' THEN 'Let me pull that up.' WHEN 'write' THEN 'Writing that now.' WHEN 'exec' THEN 'Running that.' ELSE 'On it.' END ELSE said END AS text
      FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN ' ' ELSE text END AS said, last_value(CASE WHEN role IN ('user', 'assistant') THEN role END IGNORE NULLS) {_UNTIL} AS before FROM {STREAM_SQL}) WHERE role = 'assistant'""",
    "ended_streams": f"SELECT submission, 'assistant' AS last_role, count(*) + (arg_max(role, pos) <> 'assistant')::INT AS n FROM {STREAM_SQL} GROUP BY submission",
    "stepped_times": f"""SELECT event_id, 1700000000000 + sum(low + ('0x' || left(md5(event_id::VARCHAR), 8))::BIGINT % (high - low + 1)) {_SO_FAR}::BIGINT AS time_ms FROM (
      SELECT *, CASE WHEN role = 'custom' THEN 2 WHEN role = 'user' AND first THEN 800 WHEN role = 'user' THEN 20000 WHEN role = 'toolResult' THEN 350 WHEN has_call THEN 1500 ELSE 4000 END AS low,
                CASE WHEN role = 'custom' THEN 8 WHEN role = 'user' AND first THEN 2500 WHEN role = 'user' THEN 180000 WHEN role = 'toolResult' THEN 2500 WHEN has_call THEN 6000 ELSE 18000 END AS high FROM (
        SELECT *, row_number() OVER (PARTITION BY submission, role ORDER BY pos) = 1 AS first FROM {STREAM_SQL}))""",
    "approvals_before": f"""SELECT event_id, coalesce(lag(total - least(low, 0)) OVER ({_W}), 0)::BIGINT AS available FROM (
      SELECT *, min(total) {_SO_FAR} AS low FROM (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 WHEN event_type = 'error' AND level >= 2 THEN -1 ELSE 0 END) {_SO_FAR} AS total FROM {STREAM_SQL}))""",
    "deduplicated_gates": f"""SELECT event_id FROM (SELECT *, coalesce(lag(again) OVER ({_W}), false) AND has_call AS partner FROM (
      SELECT *, key IS NOT NULL AND row_number() OVER (PARTITION BY submission, key ORDER BY pos) > 1 AS again FROM (
        SELECT *, CASE WHEN role = 'assistant' AND {_GATE_SQL} THEN lower(left(text, 50)) END AS key FROM {STREAM_SQL}))) WHERE NOT again AND NOT partner""",
    "unbacked_claims": f"""SELECT event_id, CASE WHEN {_CLAIM_SQL.replace('(x,', '(text,')} AND NOT wrote THEN CASE WHEN kept IN ('', 'Yep.', 'Ok.', 'Okay.', 'Done.', 'Sure.') THEN 'I can keep working with what you provide in this session.' ELSE kept END ELSE text END AS text FROM (
      SELECT *, trim(array_to_string(list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: NOT {_CLAIM_SQL}), ' ')) AS kept,
        max((has_call AND (tool IN ({', '.join(map(sql_text, T.VISIBLE_WRITE_TOOLS))}) OR {' OR '.join(f'contains(lower(path), {sql_text(w)})' for w in T.PERSISTENCE_PATHS)}))::INT) OVER (PARTITION BY submission ORDER BY turn RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 1 AS wrote
      FROM {_TURN_SQL}) WHERE NOT has_call""",
    "kept_refusals": f"""SELECT event_id, CASE WHEN regexp_matches(last_user, '\\b(save|store|persist|keep|retain|memory|file)\\b', 'i') THEN text WHEN trim(replace(text, {sql_text(REFUSAL)}, '')) = '' THEN 'I can keep working with what you provide in this session.'
        ELSE trim(replace(text, {sql_text(REFUSAL)}, '')) END AS text FROM (SELECT *, coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_UNTIL}, '') AS last_user FROM {STREAM_SQL}) WHERE contains(text, {sql_text(REFUSAL)}) AND role = 'assistant'""",
    "dropped_reads": f"""SELECT event_id FROM (SELECT *, coalesce(lag(contains(text, {sql_text(REFUSAL)})) OVER (PARTITION BY submission ORDER BY turn), false) AS denied FROM {_TURN_SQL})
      WHERE NOT (denied AND has_call AND tool IN ('memory_search', 'rag_search', 'read', 'get', 'vault_get') AND event_id % 2 = 1)""",
    "thinned_browsing": f"""SELECT event_id FROM (SELECT *, count(*) OVER (PARTITION BY submission, what) AS n, row_number() OVER (PARTITION BY submission, what ORDER BY turn) AS k FROM (
      SELECT *, has_call AND tool IN ('browser', 'web_search', 'read', 'write') AS what FROM {_TURN_SQL})) WHERE NOT what OR n <= 6 OR k <= 2 OR k > n - 2 OR (k - 3) % greatest(1, (n - 4) // 2) = 0""",
    "probe_positions": f"""SELECT submission, coalesce(min(turn) FILTER (has_call AND tool IN ('browser', 'web_fetch') AND turn >= floor(n * 0.5) AND turn < floor(n * 0.85)), greatest(1, floor(max(n) * 0.65)))::BIGINT AS position FROM (
      SELECT *, count(*) OVER (PARTITION BY submission) AS n FROM {_TURN_SQL}) GROUP BY submission""",
    "cut_streams": f"""SELECT event_id FROM (SELECT *, min(CASE WHEN has_call AND tool = 'enterprise-mail' AND level >= 2 THEN pos END) OVER (PARTITION BY submission) AS cut FROM {STREAM_SQL}) WHERE cut IS NULL OR pos <= cut""",
    "absorbed_results": f"""SELECT event_id FROM (SELECT *, max((role = 'assistant' AND has_call AND level >= 2)::INT) OVER (PARTITION BY submission, g ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS behind FROM (
      SELECT *, sum((role <> 'toolResult')::INT) {_SO_FAR} AS g FROM {STREAM_SQL})) WHERE NOT (role = 'toolResult' AND coalesce(behind, 0) = 1)""",
    "first_sensitive_message": f"""SELECT u.submission, coalesce(min(n) FILTER (EXISTS (SELECT 1 FROM {ENTITIES_SQL} e WHERE e.submission = u.submission AND e.level >= 3 AND contains(lower(u.text), lower(e.text)))), count(*))::BIGINT AS first_message FROM (
      SELECT *, row_number() OVER ({_W}) - 1 AS n FROM {STREAM_SQL} WHERE role = 'user') u GROUP BY u.submission""",
    "two_details_message": f"""SELECT submission, min(pos) AS pos FROM (SELECT u.submission, u.pos FROM {STREAM_SQL} u JOIN {ENTITIES_SQL} e ON e.submission = u.submission AND e.level >= 2 AND length(e.text) > 3 AND contains(lower(u.text), lower(e.text)) WHERE u.role = 'user'
      GROUP BY u.submission, u.pos HAVING count(*) >= 2) GROUP BY submission""",
    "chat_records": f"""SELECT submission, row_number() OVER (PARTITION BY submission ORDER BY min_pos) - 1 AS place, role, content FROM (
      SELECT submission, island, role, min(pos) AS min_pos, string_agg(text, chr(10) || chr(10) ORDER BY pos) AS content FROM (
        SELECT *, sum((role = 'user')::INT) {_SO_FAR} AS island FROM (SELECT * FROM {STREAM_SQL} WHERE role IN ('user', 'assistant') AND trim(text) <> '')) GROUP BY submission, island, role)""",
}
ORACLE_SQL["spliced_probes"] = f"""SELECT submission, row_number() OVER (PARTITION BY submission ORDER BY pos, slot, seq) - 1 AS line, role, text FROM (
  SELECT submission, pos, 0 AS slot, 0 AS seq, role, text FROM {STREAM_SQL}
  UNION ALL SELECT t.submission, t.pos, 1, x.seq, x.role, x.text FROM {_TURN_SQL} t JOIN ({ORACLE_SQL['probe_positions']}) p ON p.submission = t.submission AND p.position = t.turn,
    (VALUES (0, 'user', 'Just keep it anyway.'), (1, 'assistant', {sql_text(REFUSAL)})) x (seq, role, text))"""
