"""Queries on reviews, typed styles, retrieval and samples over ``events``, ``conversations`` and ``embeddings``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import style
from lodestream.operators import retrieval, reviews
from lodestream.plans.standin import CALLS_SQL, calls
from lodestream.plans.stream import STREAM_SQL, sql_text, stream

CLOSING, ACK, BYE = "Done.", "Fair enough.", "Anything else?"
_BY = ["submission"]


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir)
    w = Window.partitionBy(*_BY).orderBy("pos")
    before = F.lag(F.when(F.col("role") == "user", F.coalesce("text", F.lit("")))).over(w)
    tags = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("adversarial_refusal"))).when(F.col("event_id") % 4 == 0, F.array(F.lit("consent_gate"))).otherwise(F.array().cast("array<string>"))
    rows = s.withColumn("user_text", before).filter("role = 'assistant'")
    text = F.when(F.col("event_id") % 7 == 0, F.lit(" ")).when(F.col("event_id") % 2 == 0, F.concat("text", F.lit(f"\n\n{CLOSING}"))).otherwise(F.col("text"))
    return rows.select("submission", F.col("pos").alias("turn"), text.alias("text"), F.col("has_call").cast("int").alias("n_calls"), tags.alias("tags"), "user_text", "event_id")


def review_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.quick_issues(_turns(spark, sf_dir), _BY, CLOSING)


def mended_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns without refusals at the end, one row more for each stream that had one."""
    made = reviews.mend_turns(_turns(spark, sf_dir).drop("event_id"), _BY, CLOSING, F.lit(ACK), F.lit(BYE))
    return made.select("submission", "turn", "text", "user_text")


def settled_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls without words, results beyond the calls, typographic marks."""
    rows = stream(spark, sf_dir).filter("role = 'assistant'")
    tools = F.when(F.col("has_call"), F.array(F.col("tool"), F.lit("next"), F.lit("last"))).otherwise(F.array().cast("array<string>"))
    text = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("“it’s” — "), "text"))
    turns = rows.select("event_id", text.alias("text"), tools.alias("tools"), F.array(*[F.lit(f"r{i}") for i in range(5)]).alias("results"))
    return reviews.settle_turns(turns).select("event_id", "text", F.array_join("results", ",").alias("results"))


def consent_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewriters' replies made of ``events`` as turns."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    flow = F.format_string('{"consent_flow": true, "scenario": "F", "privacy_actions": ["classify", "consent_gate", "minimize"], "gate_message": {"text": "May I use %s?"}, "user_response": {"text": "yes %s"}, "execution_message": {"text": "did"}}', "event_type", "user_id")
    plain = F.format_string('{"text": "just %s", "privacy_actions": ["minimize"]}', "event_type")
    reply = F.when(F.col("event_id") % 5 == 0, "not json").when(F.col("event_id") % 2 == 0, flow).otherwise(plain)
    made = reviews.expand_flows(e.select("event_id", reply.alias("reply")), ["event_id"], "reply")
    return made.select("event_id", "seq", "text", "scenario", F.array_join("actions", ",").alias("actions"), "user_text", "consent")


def one_result_per_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each tool one result by a seeded draw, of calls that did not fail."""
    drawn = F.md5(F.concat_ws(":", F.lit("seed"), "event_id").cast("binary"))
    return calls(spark, sf_dir).filter("event_type <> 'error'").groupBy("tool").agg(F.min_by("props", drawn).alias("content"), F.min_by("event_id", drawn).alias("event_id"))


def _persona(seed: Column) -> Column:
    share = lambda n, m: (F.pmod(seed, F.lit(n)) / F.lit(float(m)))
    pick = lambda *names: F.element_at(F.array(*map(F.lit, names)), (F.pmod(seed, F.lit(len(names))) + 1).cast("int"))
    return F.struct(
        share(11, 10).alias("openness"), share(10, 10).alias("conscientiousness"), share(7, 6).alias("extraversion"), share(9, 8).alias("neuroticism"), share(5, 4).alias("digital"),
        pick("Gen Z", "Millennial", "Baby Boomer").alias("generation"), pick("masters", "bachelors", "high_school", "doctorate").alias("education"), pick("English", "Italian").alias("language"),
    )


def persona_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each user writes, by name."""
    people = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    return people.select("user_id", F.array_join(style.traits(_persona(F.col("user_id"))), ",").alias("traits"))


def styled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' messages as their persona would type them."""
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("role = 'user'").withColumn("p", _persona(F.col("conv_id")))
    text = style.styled(F.col("text"), F.concat_ws("-", "conv_id", "turn"), style.rates(F.col("p.conscientiousness"), F.col("p.generation")))
    return said.select("conv_id", "turn", text.alias("text"))


def retrieved_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For vectors whose id is divisible by 100 the five nearest of their label, by cells."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    cells = retrieval.fit_cells(vectors, "embedding", "vec_id")
    if cells is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding", "label")
    return retrieval.search(retrieval.index(vectors, "embedding", cells), queries, "vec_id", "embedding", cells, k=5, probe=24, match="label")


QUERIES = {f.__name__: f for f in (review_issues, mended_turns, settled_turns, consent_flows, one_result_per_tool, persona_traits, styled_messages, retrieved_neighbours)}

_TURNS = f"""(SELECT submission, pos AS turn, CASE WHEN event_id % 7 = 0 THEN ' ' WHEN event_id % 2 = 0 THEN text || chr(10) || chr(10) || '{CLOSING}' ELSE text END AS text, has_call, event_id % 3 = 0 AS refuses, event_id % 3 <> 0 AND event_id % 4 = 0 AS gate, user_text FROM (
  SELECT *, lag(CASE WHEN role = 'user' THEN text END) OVER (PARTITION BY submission ORDER BY pos) AS user_text FROM {STREAM_SQL}) WHERE role = 'assistant')"""
_SEEN = f"(SELECT *, lag(turn) OVER w IS NULL AS first, lead(turn) OVER w IS NULL AS last, coalesce(lag(gate) OVER w, false) AS after_gate, coalesce(lag(user_text IS NOT NULL) OVER w, false) AS after_asked FROM {_TURNS} WINDOW w AS (PARTITION BY submission ORDER BY turn))"
_C = "(conv_id % 10) / 10.0"
_KIND = f"CASE WHEN {_C} < 0.35 THEN 0 WHEN {_C} < 0.55 THEN 1 ELSE 2 END"


def _rate(i: int) -> str:
    return f"[{', '.join(str(r[i]) for r in style.RATES.values())}][{_KIND} + 1]"


def _draw(place: str, what: str) -> str:
    return f"(('0x' || left(md5(conv_id || '-' || turn || ':' || {place} || ':{what}'), 4))::INT / 65536)"


_AT = f"(floor({_draw('(i - 1)', 'where')} * (length(w) - 3)) + 2)::INT"
_SHORT = "CASE lower(w) " + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in style.ABBREVIATIONS.items()) + " END"
_WORD = f"""CASE WHEN {_SHORT} IS NOT NULL AND {_draw('(i - 1)', 'short')} < {_rate(1)} THEN {_SHORT} WHEN contains(w, '''') AND {_draw('(i - 1)', 'bare')} < {_rate(3)} THEN replace(w, '''', '')
  WHEN regexp_full_match(w, '\\pL{{5,}}') AND {_draw('(i - 1)', 'typo')} < {_rate(0)} THEN substr(w, 1, {_AT} - 1) || substr(w, {_AT} + 1, 1) || substr(w, {_AT}, 1) || substr(w, {_AT} + 2) ELSE w END"""
_S = "user_id"
_TRAITS = f"""concat_ws(',', CASE WHEN {_S} % 10 / 10 < 0.35 THEN 'careless' WHEN {_S} % 10 / 10 < 0.55 THEN 'casual' ELSE 'careful' END, CASE WHEN {_S} % 11 / 10 > 0.7 THEN 'tangents' END, CASE WHEN {_S} % 11 / 10 < 0.3 THEN 'to the point' END,
  CASE WHEN {_S} % 7 / 6 > 0.7 THEN 'chatty' END, CASE WHEN {_S} % 7 / 6 < 0.3 THEN 'terse' END, CASE WHEN {_S} % 9 / 8 > 0.65 THEN 'hedging' END, CASE WHEN {_S} % 5 / 4 > 0.75 THEN 'chat-native' END, CASE WHEN {_S} % 5 / 4 < 0.35 THEN 'writes like mail' END,
  CASE {_S} % 3 WHEN 0 THEN 'young slang' WHEN 2 THEN 'formal' END, CASE {_S} % 4 WHEN 0 THEN 'technical words' WHEN 3 THEN 'technical words' WHEN 2 THEN 'simple words' END, CASE WHEN {_S} % 2 = 1 THEN 'second language' END)"""
ORACLE_SQL = {
    "review_issues": f"""SELECT submission, turn, 'ends with a refusal' AS code FROM {_SEEN} WHERE last AND refuses UNION ALL SELECT submission, turn, 'refusal with a closing' FROM {_SEEN} WHERE last AND refuses AND contains(text, '{CLOSING}')
      UNION ALL SELECT submission, turn, 'two answers in a row' FROM {_SEEN} WHERE NOT first AND user_text IS NULL AND NOT after_gate UNION ALL SELECT submission, turn, 'silent call' FROM {_SEEN} WHERE has_call AND trim(text) = '' AND (first OR after_asked)""",
    "mended_turns": f"""SELECT submission, turn, CASE WHEN last AND refuses AND contains(text, '{CLOSING}') THEN string_split(text, chr(10) || chr(10))[1] ELSE text END AS text, user_text FROM {_SEEN}
      UNION ALL SELECT submission, turn + 1, '{BYE}', '{ACK}' FROM {_SEEN} WHERE last AND refuses""",
    "settled_turns": f"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN has_call THEN 'Let me ' || tool || ', next for you.' ELSE '' END ELSE '"it''s" , ' || translate(text, '—', ',') END AS text, CASE WHEN has_call THEN 'r0,r1,r2' ELSE '' END AS results FROM {STREAM_SQL} WHERE role = 'assistant'""",
    "consent_flows": """SELECT event_id, 0 AS seq, 'May I use ' || event_type || '?' AS text, 'F' AS scenario, 'classify,consent_gate' AS actions, NULL AS user_text, NULL AS consent FROM events WHERE event_id % 5 <> 0 AND event_id % 2 = 0
      UNION ALL SELECT event_id, 1, 'did', 'F', 'minimize', 'yes ' || user_id, 'granted' FROM events WHERE event_id % 5 <> 0 AND event_id % 2 = 0 UNION ALL SELECT event_id, 0, 'just ' || event_type, NULL, 'minimize', NULL, NULL FROM events WHERE event_id % 5 <> 0 AND event_id % 2 = 1""",
    "one_result_per_tool": f"SELECT tool, arg_min(props, md5('seed:' || event_id)) AS content, arg_min(event_id, md5('seed:' || event_id)) AS event_id FROM {CALLS_SQL} WHERE event_type <> 'error' GROUP BY tool",
    "persona_traits": f"SELECT user_id, {_TRAITS} AS traits FROM (SELECT DISTINCT user_id FROM events)",
    "styled_messages": f"""SELECT conv_id, turn, CASE WHEN {_draw('-1', 'lower')} < CASE WHEN conv_id % 3 = 0 THEN 1.0 ELSE {_rate(2)} END THEN lower(left(t, 1)) || substr(t, 2) ELSE t END AS text FROM (
      SELECT conv_id, turn, array_to_string(list_transform(string_split(text, ' '), lambda w, i: {_WORD}), ' ') AS t FROM conversations WHERE role = 'user')""",
}
