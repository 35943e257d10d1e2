"""Queries on conversations and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators import ordered_state as state
from lodestream.plans.standin import CALLS_SQL, calls

_BY, _ORDER = ["submission"], ["pos"]


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def role_turn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.running_index(_turns(spark, sf_dir), F.col("role") == "assistant", ["conv_id"], ["turn"], "assistant_index")
    return out.select("conv_id", "turn", "role", "assistant_index")


def turn_to_user_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.last_value_where(_turns(spark, sf_dir), F.col("role") == "user", F.col("turn"), ["conv_id"], ["turn"], "user_turn")
    return out.filter("role = 'assistant'").select("conv_id", "turn", "user_turn")


def first_turn_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = turn_to_user_map(spark, sf_dir).filter("user_turn IS NOT NULL")
    return state.first_of(mapped, ["conv_id", "user_turn"], ["turn"])


def last_user_text_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.last_value_where(_turns(spark, sf_dir), F.col("role") == "user", F.col("text"), ["conv_id"], ["turn"], "user_text")
    return out.select("conv_id", "turn", F.coalesce("user_text", F.lit("")).alias("user_text"))


def pm1_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.neighbours(_turns(spark, sf_dir), "text", ["conv_id"], ["turn"], "passage").select("conv_id", "turn", "passage")


def chunk_by_6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.chunks(_turns(spark, sf_dir), 6, ["conv_id"], ["turn"])
    grouped = out.groupBy("conv_id", "chunk").agg(F.count("*").alias("n_messages"), state.join_in_order(F.col("text"), F.col("turn"), "\n").alias("passage"))
    return grouped.filter((F.col("n_messages") >= 2) & (F.length("passage") >= 50))


def consecutive_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.repeats_previous(calls(spark, sf_dir), "event_type", _BY, _ORDER).select("event_id", "submission", "pos", "event_type")


def collapse_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = state.islands(calls(spark, sf_dir), "event_type", _BY, _ORDER)
    return runs.groupBy("submission", "island", "event_type").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n_events"), state.join_in_order(F.col("event_id").cast("string"), F.col("pos"), ",").alias("ids"))


def duplicate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.later_copies(calls(spark, sf_dir), ["submission", "props"], ["pos"]).select("event_id", "submission", "props", "copy")


def time_backwards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the order of values, times do go backwards."""
    return state.backwards_in_time(calls(spark, sf_dir), "ts", _BY, ["value", "event_id"]).select("event_id", "submission")


def latch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return state.latch(calls(spark, sf_dir), kind == "error", kind == "signup", _BY, _ORDER, "pending").select("event_id", "pending")


def epoch_reset_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return state.epoch_latch(calls(spark, sf_dir), kind == "signup", kind == "view", _BY, _ORDER, "seen").select("event_id", "seen")


def clamped_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    change = F.when(kind == "signup", 1).when(kind == "purchase", -1).otherwise(0)
    return state.floored_counter(calls(spark, sf_dir), change, _BY, _ORDER, "approvals").select("event_id", "approvals")


QUERIES = {f.__name__: f for f in (role_turn_index, turn_to_user_map, first_turn_of_user, last_user_text_state, pm1_window, chunk_by_6, consecutive_types, collapse_runs, duplicate_values, time_backwards, latch_state, epoch_reset_state, clamped_counter)}

_RUN = "OVER (PARTITION BY submission ORDER BY pos ROWS UNBOUNDED PRECEDING)"
_TURN = "OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)"
_MAP = f"SELECT conv_id, turn, user_turn FROM (SELECT *, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) {_TURN} AS user_turn FROM conversations) WHERE role = 'assistant'"

ORACLE_SQL = {
    "role_turn_index": f"SELECT conv_id, turn, role, (sum((role = 'assistant')::INT) {_TURN} - 1)::BIGINT AS assistant_index FROM conversations",
    "turn_to_user_map": _MAP,
    "first_turn_of_user": f"SELECT conv_id, min(turn) AS turn, user_turn FROM ({_MAP}) WHERE user_turn IS NOT NULL GROUP BY conv_id, user_turn",
    "last_user_text_state": f"SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_TURN}, '') AS user_text FROM conversations",
    "pm1_window": "SELECT conv_id, turn, concat_ws(chr(10), lag(text) OVER w, text, lead(text) OVER w) AS passage FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "chunk_by_6": "SELECT conv_id, chunk, count(*) AS n_messages, string_agg(text, chr(10) ORDER BY turn) AS passage FROM (SELECT *, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 6)::BIGINT AS chunk FROM conversations) GROUP BY conv_id, chunk HAVING count(*) >= 2 AND length(string_agg(text, chr(10) ORDER BY turn)) >= 50",
    "consecutive_types": f"SELECT event_id, submission, pos, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY submission ORDER BY pos) AS b FROM {CALLS_SQL}) WHERE b = event_type",
    "collapse_runs": f"""SELECT submission, island, event_type, min(pos) AS first_pos, count(*) AS n_events, string_agg(event_id::VARCHAR, ',' ORDER BY pos) AS ids FROM (
        SELECT *, (sum(s) {_RUN} - 1)::BIGINT AS island FROM (SELECT *, (lag(event_type) OVER (PARTITION BY submission ORDER BY pos) IS DISTINCT FROM event_type)::INT AS s FROM {CALLS_SQL})) GROUP BY ALL""",
    "duplicate_values": f"SELECT event_id, submission, props, copy FROM (SELECT *, row_number() OVER (PARTITION BY submission, props ORDER BY pos) AS copy FROM {CALLS_SQL}) WHERE copy > 1",
    "time_backwards": f"SELECT event_id, submission FROM (SELECT *, max(event_id) OVER () AS m, lag(ts) OVER (PARTITION BY submission ORDER BY value, event_id) AS b FROM {CALLS_SQL}) WHERE ts < b",
    "latch_state": f"SELECT event_id, coalesce(last_value(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 0 END IGNORE NULLS) {_RUN}, 0)::BIGINT AS pending FROM {CALLS_SQL}",
    "epoch_reset_state": f"SELECT event_id, CASE WHEN e > 0 THEN max((event_type = 'view')::INT) OVER (PARTITION BY submission, e ORDER BY pos ROWS UNBOUNDED PRECEDING) ELSE 0 END::BIGINT AS seen FROM (SELECT *, sum((event_type = 'signup')::INT) {_RUN} AS e FROM {CALLS_SQL})",
    "clamped_counter": f"SELECT event_id, (t - least(0, min(t) {_RUN}))::BIGINT AS approvals FROM (SELECT *, sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END) {_RUN} AS t FROM {CALLS_SQL})",
}
