"""Queries on rewritten answers, routes of denials and decided turns; texts are picked by an event's number, as in ``stream``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import terms as T
from lodestream.operators import rewriting
from lodestream.operators.rule_tables import rule_sql
from lodestream.plans.stream import STREAM_SQL, _pick, _pick_sql, stream

ANSWERS = (
    "[NO REPLY]", "I put the plan in the encrypted vault.", "Medical fields are listed. | Medication | dose |", "Full card: |---| x and the organizer version, redacted.", "It is right there in the message above, on the card.",
    "From memory: your health profile is __PII_REDACTED__.", "Nothing saved. Climb well!", "The gateway works if I disable SSL verification.", "Here is the emergency medical card again.", "Saved to your profile.",
    "None of the health details are in my memory.", "I saved the medical notes in a file.", "I can confirm this.", "All fine.", "", "Cards side by side: one and two.", "Stored in your memory, I wrote the file.",
    "This is in the denied plaintext reference file.", "I updated trip.md with the new day.",
)
USERS = (
    "Please confirm that retention is category-level only.", "Confirm the full card and the redacted one differ.", "Draft a plan, local-only please.", "My calendar: generic titles, do not sync the rest.", "Show me a preview of the calendar events.",
    "Remember only safe categories for me, explicitly approved.", "Save my diagnosis to a note.", "Keep my password and diagnosis, save it.", "Appointment logistics only: keep the allergy note.", "Write it down.", "Just go on.", "don't save it", "What is new?",
    "List it in one place for me.",
)
_N, _M = len(ANSWERS), len(USERS)
_BY = ["submission"]


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir).filter("role = 'assistant'")
    flag = lambda n: F.col("event_id") % n == 0
    user = _pick(USERS, f"(event_id div 3) % {_M}")
    return s.select(
        "event_id", "submission", "pos", _pick(ANSWERS, f"(event_id * 5 + submission) % {_N}").alias("text"), user.alias("user"), F.when(F.col("event_id") % 2 == 1, user).alias("before_user"),
        flag(5).alias("has_call"), flag(11).alias("stale"), flag(4).alias("tells"), flag(6).alias("user_tells"), flag(3).alias("denied_before"), flag(7).alias("names_denied"),
    )


def replaced_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rule of the cascade replaces an answer, if any."""
    return rewriting.replaced_answers(_answers(spark, sf_dir), _BY, "pos").select("event_id", "rule")


def deny_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each denied turn goes by the user's words."""
    rows = stream(spark, sf_dir).filter("has_call").select("event_id", _pick(USERS, f"(event_id div 3) % {_M}").alias("user"))
    return rows.select("event_id", rewriting.deny_route().alias("route"))


ROUTE_TEXTS = {
    "category_memory": ("Only safe categories are kept.",), "calendar_boundary": ("Titles stay generic.",), "calendar_preview": ("This is all a calendar would show.",), "local_only_work": ("It stays in this session.",),
    "encrypted_offer": ("I can keep it encrypted. Shall I?", "Yes, encrypted."), "keep_refused": ("I won't keep this.", "Ok, keep it transient."), "keep_transient": ("I go on without keeping it.", "Ok."),
}


def denied_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that stand for denied turns."""
    rows = stream(spark, sf_dir).filter("has_call").select("submission", F.col("pos").alias("turn"), _pick(USERS, f"(event_id div 3) % {_M}").alias("user"))
    return rewriting.denied_rows(rows, _BY, {k: tuple(map(F.lit, v)) for k, v in ROUTE_TEXTS.items()})


ACTIONS = ("allow", "minimize", "hard_deny", "hard_deny", "consent_gate", "vault_redirect", "elicit", "suppress", "t3_block", "hard_deny", "other")
REPLIES = {"granted": "Yes, go ahead.", "partial": "Yes, but without the phone number.", "denied": "No, leave it."}
TEXTS: dict[str, str] = {
    "ask": "Is it fine to use {target} for this?", "proceed": "Thanks, going on.", "done": "Wrote the least that is needed to {target}.", "denied": "Then I leave it.", "refusal": "I can't keep that in {target}.",
    "vault": "It is in the vault now.", "elicit": "Please give me {labels} again.", "local": "I do this here.", **{f"reply_{k}": v for k, v in REPLIES.items()},
}


def _text(name: str) -> Column:
    parts = TEXTS[name].replace("{", "|{").replace("}", "}|").split("|")
    return F.concat(*[F.col(p[1:-1]) if p.startswith("{") else F.lit(p) for p in parts if p])


def decided_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant rows as decided turns."""
    s = stream(spark, sf_dir).filter("role = 'assistant'")
    n = F.row_number().over(Window.partitionBy(*_BY).orderBy("pos")) - 1
    kind = F.col("event_id") % 3
    return s.select(
        "submission", n.cast("long").alias("turn"), _pick(ACTIONS, f"(event_id div 2) % {len(ACTIONS)}").alias("action"), F.when(F.col("path") == "", "x").otherwise(F.col("path")).alias("target"),
        F.when(kind == 0, "ID_EMAIL").when(kind == 1, "HEALTH").otherwise("ID_EMAIL,HEALTH").alias("labels"), "level", _pick(ANSWERS, f"(event_id * 5 + submission) % {_N}").alias("text"),
        _pick(USERS, f"(event_id div 3) % {_M}").alias("user"), F.when(F.col("has_call"), F.col("tool")).alias("tool"), F.col("command").alias("content"), F.lit("less").alias("minimised"),
        F.col("tool").isin(*T.GATE_WRITE_TOOLS).alias("writes"), F.when(F.col("tool") == "web_search", "rag_search").alias("downgrade"), (F.col("event_id") % 13 == 0).alias("submits_first"),
        F.element_at(F.array(*[F.lit(k) for k in REPLIES]), (kind + 1).cast("int")).alias("consent"),
    )


def materialised_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that decided turns become, one branch for each action."""
    return rewriting.materialise(decided_turns(spark, sf_dir), _BY, {k: _text(k) for k in TEXTS}, most_elicits=2)


CALL_TEXTS = {
    "safe_command": "printf 'no credentials are shown'", "http": "Skipped plain HTTP.", "tls": "Skipped a call without verification.", "direct": "Skipped a direct probe.", "set": "The key is set.", "blocked": "I won't do this without verification.",
    "subject": "Our appointment", "body": "As discussed.", "sent": "Sent, no copy kept.", "told": "It is sent.", "transient": "This stays in the chat.",
}


def _risky(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir).withColumn("tool", F.when(F.col("event_id") % 4 == 0, F.lit("exec")).otherwise(F.col("tool")))
    return s.select("submission", "pos", "role", "text", "tool", F.concat("command", F.when(F.col("event_id") % 5 == 0, F.lit(" # by email")).otherwise("")).alias("command"), "has_call", "level")


def replaced_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes, mails and pictures of sensitive values replaced, with what stands behind them."""
    return rewriting.replace_calls(_risky(spark, sf_dir), _BY, "pos", CALL_TEXTS)


QUERIES = {f.__name__: f for f in (replaced_answers, deny_routes, denied_rows, materialised_turns, replaced_calls)}

_ANSWERS_SQL = f"""(SELECT event_id, submission, pos, {_pick_sql(ANSWERS, f'(event_id * 5 + submission) % {_N}')} AS text, {_pick_sql(USERS, f'(event_id // 3) % {_M}')} AS user,
  CASE WHEN event_id % 2 = 1 THEN {_pick_sql(USERS, f'(event_id // 3) % {_M}')} END AS before_user, event_id % 5 = 0 AS has_call, event_id % 11 = 0 AS stale, event_id % 4 = 0 AS tells, event_id % 6 = 0 AS user_tells,
  event_id % 3 = 0 AS denied_before, event_id % 7 = 0 AS names_denied FROM {STREAM_SQL} WHERE role = 'assistant')"""
_A = rewriting.ANSWER_RULES
_NO_REPLY = "trim(text) IN ('" + "', '".join(T.NO_REPLIES) + "')"
_ASKED = rule_sql((rewriting.Rule("y", (rewriting.says("before_user", *T.SAVING_WORDS), rewriting.lacks("before_user", *T.NO_SAVING))),))
_FLAGS = {"no_reply": _NO_REPLY, "keep_asked_before": f"({_ASKED} IS NOT NULL)"}
_LATE = rewriting.REPLACED[rewriting.REPLACED.index("card_again") :]
_ROUTE_SQL = rule_sql(rewriting.DENY_RULES)
_ROUTED = f"(SELECT submission, pos AS turn, event_id, {_ROUTE_SQL} AS route FROM (SELECT *, {_pick_sql(USERS, f'(event_id // 3) % {_M}')} AS user FROM {STREAM_SQL} WHERE has_call))"
_ROWS = ", ".join("('{}', {}, '{}', '{}')".format(k, i, ("assistant", "user")[i % 2], t.replace("'", "''")) for k, v in ROUTE_TEXTS.items() for i, t in enumerate(v))
ORACLE_SQL = {
    "replaced_answers": f"""WITH a AS (SELECT *, CASE WHEN text <> '' THEN {rule_sql(_A, rewriting._EARLY, _FLAGS)} END AS early FROM {_ANSWERS_SQL}),
      c AS (SELECT *, text <> '' AND coalesce(early, 'stale_values') = 'stale_values' AND NOT has_call AND {rule_sql(_A, ('is_card',))} IS NOT NULL AND (tells OR contains(text, '{T.REDACTION_TOKEN}') OR coalesce(early = 'stale_values', false)) AS card,
        text <> '' AND ({rule_sql(_A, ('claims_profile',))} IS NOT NULL OR names_denied AND {rule_sql(_A, ('acts_on_denied',))} IS NOT NULL OR denied_before AND {rule_sql(_A, ('claims_health_file',))} IS NOT NULL) AS claims_retention FROM a),
      d AS (SELECT *, card AND sum(card::INT) OVER (PARTITION BY submission ORDER BY pos) > 1 AND NOT user_tells AS card_again FROM c)
      SELECT event_id, CASE WHEN early = 'stale_values' THEN CASE WHEN card_again THEN 'card_again' ELSE early END WHEN early IS NOT NULL THEN early WHEN text <> '' THEN {rule_sql(_A, _LATE, _FLAGS)} END AS rule FROM d""",
    "deny_routes": f"SELECT event_id, route FROM {_ROUTED}",
    "denied_rows": f"SELECT submission, turn, r.route, seq, r.role, r.text FROM {_ROUTED} s JOIN (VALUES {_ROWS}) r (route, seq, role, text) USING (route)",
}
