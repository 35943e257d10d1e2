"""Queries on policy decisions, rankings, joins and reports over the stand-in calls and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import values
from lodestream.operators import relations as R
from lodestream.operators import joins, policy
from lodestream.plans.standin import CALLS_SQL, calls


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    args = F.col("tier"), F.col("is_write")
    return c.withColumn("free", policy.free_band(*args)).withColumn("action", policy.action(*args, F.col("level")))


def free_band_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = policy.above_band(F.col("tier"), F.col("is_write"), F.col("level"))
    return _judged(spark, sf_dir).select("event_id", "free", (F.col("level") > F.col("free")).alias("violation"), reason.alias("reason"), "action")


def severity_max_per_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.most_severe(_judged(spark, sf_dir), ["submission"], "action", "pos")


def action_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).groupBy("tier", "action").agg(F.count("*").alias("n"))


def first_consent_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = _judged(spark, sf_dir).filter("action = 'consent_gate'")
    return policy.top_k(gated, ["submission", "tool", "level"], [F.col("pos")], 1).select("event_id", "submission", "tool", "level")


def remediation_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    counted = policy.later_reads(c.filter("event_type = 'signup'"), c.filter("event_type = 'view'"), ["submission"], "pos")
    return counted.select("submission", "pos", "n_reads", policy.remediation(F.col("n_reads")).alias("choice"))


def topk_by_criticality(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _judged(spark, sf_dir)
    branch = F.when(F.col("action") == "allow", 0.2).otherwise(0.3)
    scored = c.withColumn("criticality", policy.criticality(F.col("level"), F.col("tier"), branch, F.col("action") != "allow")).filter("criticality >= 0.3")
    return policy.top_k(scored, ["submission"], [F.desc("criticality"), F.col("pos")], 5).select("submission", "pos", "criticality", "rank")


def budget_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.split_budget(calls(spark, sf_dir), ["submission"], [F.col("pos")], 100).select("event_id", "share")


def per_group_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.sample_per_group(calls(spark, sf_dir), ["tool"], F.col("event_id"), 30).select("tool", "event_id")


def nearest_event_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    left = c.filter("event_type = 'error'").select(F.col("event_id").alias("error_id"), "submission", F.col("ts").alias("error_ts"))
    right = c.filter("event_type = 'view'").select(F.col("event_id").alias("view_id"), "submission", F.col("ts").alias("view_ts"))
    return joins.nearest_in_time(left, right, "submission", "error_ts", "view_ts", "error_id", "view_id", 1800, 60)


def region_names_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of regions in texts: up to 1000 (counted) are an array literal, more meet the texts on their first characters."""
    docs, regions = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/region.parquet")
    names = [r["r_name"] for r in regions.orderBy("r_name").limit(1001).collect()]
    if len(names) <= 1000:
        return joins.names_in_texts(docs, "doc_id", "text", [*names, "the", "license"])
    return joins.names_by_grams(docs, "doc_id", "text", regions.select(F.col("r_name").alias("name")).union(spark.createDataFrame([("the",), ("license",)], "name string")))


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    done = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(done, "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus")


def composite_left_join_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    late = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_discount > 0.05").select("l_orderkey", "l_linenumber", "l_discount")
    return lines.join(late, ["l_orderkey", "l_linenumber"], "left").filter("l_discount IS NOT NULL")


def filtered_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderstatus <> 'F' AND o_totalprice > 1000 AND o_totalprice < 200000")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select("l_orderkey", "l_linenumber", "o_orderstatus")


def conditional_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    passed = F.count_if(F.col("quality") == 1)
    return labels.agg(
        F.count("*").alias("n"),
        passed.alias("n_passed"),
        F.count_if((F.col("quality") == 1) & (F.col("toxic") == 1)).alias("n_flagged"),
        F.format_string("%.1f%%", 100.0 * passed / F.greatest(F.count("*"), F.lit(1))).alias("pass_rate"),
    )


def rollup_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = calls(spark, sf_dir).rollup("tool").agg(F.count("*").alias("n_calls"), F.sum("level").alias("levels"))
    return rolled.select(F.coalesce("tool", F.lit("total")).alias("tool"), "n_calls", F.col("levels").cast("long").alias("levels"))


def balance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("role IN ('user', 'assistant')")
    words = F.size(F.split(F.trim("text"), " +"))
    sides = turns.groupBy().pivot("role", ["user", "assistant"]).agg(F.avg(words))
    ratio = F.round(F.col("assistant") / F.col("user"), 6)
    return sides.select(ratio.alias("length_ratio"), ratio.between(0.8, 1.2).alias("balanced"))


def worst_per_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = F.min_by(F.struct("event_id", "value"), F.struct("value", "pos"))
    return calls(spark, sf_dir).groupBy("submission").agg(worst.alias("w"), F.count("*").alias("n")).select("submission", "w.event_id", "w.value", "n")


def task_keyword_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the words of a conversation's first user turn its assistant turns take up."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    task = F.min_by(F.col("text"), F.when(F.col("role") == "user", F.col("turn")))
    talks = turns.groupBy("conv_id").agg(task.alias("task"), F.array_join(F.collect_list(F.when(F.col("role") == "assistant", F.col("text"))), " ").alias("talk"))
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("task", F.lit(""))), " "), lambda w: F.length(w) > 3))
    return joins.keyword_overlap(talks, "conv_id", "talk", words).withColumn("aligned", F.col("overlap") >= 0.15)


def json_field_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    return c.select("event_id", F.variant_get(F.try_parse_json("props"), "$.k", "long").alias("k")).filter("k IS NOT NULL")


def dedupe_normalised_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns of a conversation that begin alike stay once; every fifth stands for a consent gate, which always stays."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("role = 'assistant'")
    return R.drop_like_turns(turns, ["conv_id"], "turn", "text", F.col("turn") % 5 == 4, F.col("turn") % 3 == 0).select("conv_id", "turn")


def copies_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents grouped by their whole normalised text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    key = F.md5(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")).cast("binary"))
    return docs.groupBy(key.alias("text_key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


def iso_ms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"))
    return events.select("event_id", "iso", values.epoch_ms(F.col("iso")).alias("ms"))


def knn_topn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine neighbours of the vectors whose id is divisible by 100 (a bounded share) among those of the same label."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    q = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), "label")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda c: F.sqrt(dot(F.col(c), F.col(c)))
    vectors, q = vectors.withColumn("norm", norm("embedding")), q.withColumn("q_norm", norm("q"))
    # The query side is broadcast if it is counted to be small; a label of many vectors is then no hot key.
    q = F.broadcast(q) if q.limit(100_001).count() <= 100_000 else q
    pairs = vectors.join(q, "label").filter("vec_id <> query_id")
    score = F.round(dot(F.col("embedding"), F.col("q")) / (F.col("norm") * F.col("q_norm")), 6)
    return policy.top_k(pairs.withColumn("score", score), ["query_id"], [F.desc("score"), F.col("vec_id")], 5).select("query_id", "vec_id", "score", "rank")


_FUNCTIONS = (
    free_band_verdict, severity_max_per_submission, action_histogram, first_consent_per_key, remediation_choice, topk_by_criticality, budget_split, per_group_sample, nearest_event_asof, region_names_in_texts, resume_anti,
    composite_left_join_notnull, filtered_inner_join, conditional_batch_report, rollup_usage, balance_check, worst_per_submission, task_keyword_overlap, json_field_trace, dedupe_normalised_prefix, copies_of_documents, iso_ms_roundtrip, knn_topn_filtered,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_FREE = "CASE WHEN tier = 1 AND NOT is_write THEN 4 WHEN tier = 3 THEN 1 ELSE 2 END"
_JUDGED = f"""(SELECT *, CASE WHEN NOT is_write THEN 'allow' WHEN tier = 1 AND level >= 3 THEN 'hard_deny' WHEN level > free THEN 'consent_gate' WHEN level >= 2 THEN 'minimize' ELSE 'allow' END AS action
  FROM (SELECT *, ({_FREE})::BIGINT AS free FROM {CALLS_SQL}))"""
_RANKED = f"""SELECT submission, pos, criticality, row_number() OVER (PARTITION BY submission ORDER BY criticality DESC, pos) AS rank FROM (
  SELECT *, least(1.0, round(0.15 * level + CASE action WHEN 'allow' THEN 0.2 ELSE 0.3 END + CASE tier WHEN 3 THEN 0.15 WHEN 2 THEN 0.10 ELSE 0.05 END + CASE action WHEN 'allow' THEN 0 ELSE 0.1 END, 6))::DOUBLE AS criticality FROM {_JUDGED}) WHERE criticality >= 0.3"""
_PRIORITY = "CASE action WHEN 'hard_deny' THEN 7 WHEN 'consent_gate' THEN 4 WHEN 'minimize' THEN 2 ELSE 0 END"

ORACLE_SQL = {
    "free_band_verdict": f"SELECT event_id, free, level > free AS violation, CASE WHEN tier = 1 AND is_write AND level >= 3 THEN 'local_write_above_band' WHEN level > free THEN 'missing_authorization' ELSE '' END AS reason, action FROM {_JUDGED}",
    "severity_max_per_submission": f"SELECT submission, arg_max(action, ({_PRIORITY})::BIGINT * 1000000000 - pos) AS action, count(*) AS n_calls FROM {_JUDGED} GROUP BY submission",
    "action_histogram": f"SELECT tier, action, count(*) AS n FROM {_JUDGED} GROUP BY ALL",
    "first_consent_per_key": f"SELECT arg_min(event_id, pos) AS event_id, submission, tool, level FROM {_JUDGED} WHERE action = 'consent_gate' GROUP BY submission, tool, level",
    "remediation_choice": f"""SELECT submission, pos, n_reads, CASE WHEN n_reads >= 5 THEN 'exception' WHEN n_reads >= 3 THEN 'vault' WHEN n_reads >= 1 THEN 'manual' ELSE 'none' END AS choice FROM (
      SELECT w.submission, w.pos, count(r.pos) AS n_reads FROM {CALLS_SQL} w LEFT JOIN {CALLS_SQL} r ON w.submission = r.submission AND r.pos > w.pos AND r.event_type = 'view' WHERE w.event_type = 'signup' GROUP BY ALL)""",
    "topk_by_criticality": f"SELECT * FROM ({_RANKED}) WHERE rank <= 5",
    "budget_split": f"SELECT event_id, (100 // n + (pos <= 100 % n)::INT)::BIGINT AS share FROM (SELECT *, count(*) OVER (PARTITION BY submission) AS n FROM {CALLS_SQL})",
    "per_group_sample": f"SELECT tool, event_id FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY md5(event_id::VARCHAR)) AS n FROM {CALLS_SQL}) WHERE n <= 30",
    "nearest_event_asof": f"""WITH p AS (
      SELECT e.event_id AS error_id, v.event_id AS view_id, abs(epoch_us(e.ts) - epoch_us(v.ts)) AS gap_us FROM {CALLS_SQL} e JOIN {CALLS_SQL} v ON e.submission = v.submission WHERE e.event_type = 'error' AND v.event_type = 'view'
    ), n AS (SELECT *, min(gap_us) OVER (PARTITION BY error_id) AS best FROM p WHERE gap_us <= 1800000000)
    SELECT error_id, min(view_id) AS view_id, arg_min(gap_us, view_id) AS gap_us FROM n WHERE gap_us <= best + 60000000 GROUP BY error_id""",
    "region_names_in_texts": "SELECT doc_id, name, instr(lower(text), name) AS first_at FROM documents, (SELECT lower(r_name) AS name FROM region UNION ALL SELECT unnest(['the', 'license'])) WHERE contains(lower(text), name)",
    "resume_anti": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "composite_left_join_notnull": "SELECT a.l_orderkey, a.l_linenumber, a.l_quantity, b.l_discount FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE b.l_discount > 0.05",
    "filtered_inner_join": "SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' AND o_totalprice > 1000 AND o_totalprice < 200000",
    "conditional_batch_report": "SELECT count(*) AS n, count(*) FILTER (quality = 1) AS n_passed, count(*) FILTER (quality = 1 AND toxic = 1) AS n_flagged, printf('%.1f%%', 100.0::DOUBLE * count(*) FILTER (quality = 1) / greatest(count(*), 1)) AS pass_rate FROM labels",
    "rollup_usage": f"SELECT coalesce(tool, 'total') AS tool, count(*) AS n_calls, sum(level)::BIGINT AS levels FROM {CALLS_SQL} GROUP BY ROLLUP (tool)",
    "balance_check": """SELECT round(a / u, 6) AS length_ratio, round(a / u, 6) BETWEEN 0.8 AND 1.2 AS balanced FROM (
      SELECT avg(n) FILTER (role = 'assistant') AS a, avg(n) FILTER (role = 'user') AS u FROM (SELECT role, len(regexp_split_to_array(trim(text), ' +')) AS n FROM conversations))""",
    "worst_per_submission": f"SELECT submission, arg_min(event_id, (value, pos)) AS event_id, min(value) AS value, count(*) AS n FROM {CALLS_SQL} GROUP BY submission",
    "task_keyword_overlap": """SELECT conv_id, overlap, overlap >= 0.15 AS aligned FROM (
      SELECT conv_id, (len(list_filter(k, lambda w: contains(talk, w))) / greatest(len(k), 1))::DOUBLE AS overlap FROM (
        SELECT conv_id, lower(coalesce(string_agg(text, ' ') FILTER (role = 'assistant'), '')) AS talk,
               list_distinct(list_filter(string_split(lower(coalesce(arg_min(text, turn) FILTER (role = 'user'), '')), ' '), lambda w: length(w) > 3)) AS k
        FROM conversations GROUP BY conv_id))""",
    "json_field_trace": f"SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM {CALLS_SQL} WHERE (props::JSON ->> '$.k') IS NOT NULL",
    "dedupe_normalised_prefix": r"""SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 5 = 4, k ORDER BY turn) AS n FROM (
      SELECT *, regexp_replace(lower(left(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), 300)), '\s+', ' ', 'g') AS k FROM conversations WHERE role = 'assistant')) WHERE turn % 5 = 4 OR CASE WHEN k = '' THEN turn % 3 = 0 ELSE n = 1 END""",
    "copies_of_documents": r"SELECT md5(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))) AS text_key, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY 1",
    "iso_ms_roundtrip": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, epoch_ms(date_trunc('millisecond', ts)) AS ms FROM events",
    "knn_topn_filtered": """SELECT query_id, vec_id, score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
        SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings v JOIN embeddings q USING (label) WHERE q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id)) WHERE rank <= 5""",
}
