"""Queries on redaction: payloads of any depth, fragments, placeholders, files and surfaces of the stand-in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import json_text
from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import text as X
from lodestream.operators import detect, redaction
from lodestream.plans.detection import HAS_HEALTH_SQL, ROWS_SQL, rows
from lodestream.plans.stream import VALUES
from lodestream.plans.text_rules import _any

GENERIC = "General notes without personal details."


def _literal(text: Column) -> Column:
    """Sensitive values as they are written, in any case."""
    return F.aggregate(redaction.sensitive(F.col("held")), text, lambda t, e: X.replace_literal(t, e["text"]))


def _payload() -> Column:
    text, path = json_text.quote(F.col("text")), json_text.quote(F.concat_ws(" ", "path", "command"))
    return F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "said": ['), text, F.lit(', null, 1.50, true, [[{"deep" : '), path, F.lit("}]]], "), path, F.lit(": {}}"))


def redacted_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested payloads with keys and values redacted at every depth."""
    return rows(spark, sf_dir).select("event_id", redaction.redact_json(_payload(), _literal, keys=True).alias("payload"))


def redacted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls' paths and contents as files, both redacted."""
    files = rows(spark, sf_dir).filter("has_call").select("event_id", F.concat_ws("/", "path", "command").alias("path"), F.col("text").alias("content"), "held")
    return redaction.redact_files(files, _literal).drop("held")


def redacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All surfaces of the rows: users' words and arguments stay, texts, results' and custom payloads don't."""
    r = rows(spark, sf_dir).select("event_id", "role", "text", F.col("text").alias("thinking"), _payload().alias("details"), _payload().alias("data"), "command", "held")
    return redaction.redact_events(r, _literal).drop("held")


def fuzzy_redactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts after the second pass over fragments."""
    shown = F.concat_ws(" ", "text", F.when(F.col("event_id") % 3 == 0, F.lit("it was a PEANUT thing, and the allergy is severe")), F.when(F.col("event_id") % 5 == 0, F.lit("Metoprolol, then twice")))
    r = rows(spark, sf_dir).withColumn("shown", shown)
    return r.select("event_id", redaction.redact_fuzzy(F.col("shown"), F.col("held")).alias("text"))


def placeholder_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir).select("event_id", redaction.fill_placeholders(F.col("args"), F.col("held")).alias("text"))


def generic_health_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls' contents, those about health replaced."""
    calls = rows(spark, sf_dir).filter("has_call").withColumn("content", F.when(F.col("event_id") % 4 > 0, F.col("text")))
    about = P.has_health_context(F.concat_ws("\n", "content", "path"), detect.has_health_values(F.col("held")))
    return redaction.replace_health_files(calls, about, F.lit(GENERIC)).select("event_id", "content")


QUERIES = {f.__name__: f for f in (redacted_payloads, redacted_files, redacted_rows, fuzzy_redactions, placeholder_texts, generic_health_files)}

_SECRET = "list_transform(list_sort(list_transform(list_filter(held, lambda e: e.level >= 3), lambda e: {'n': -length(e.text), 'i': e.number, 't': e.text})), lambda e: e.t)"


def _gone(text: str) -> str:
    return f"list_reduce(list_concat([{text}], {_SECRET}), lambda t, v: regexp_replace(t, regexp_escape(v), '{T.REDACTION_TOKEN}', 'gi'))"


def _payload_sql(change, key=None) -> str:  # noqa: ANN001
    path, name = f"to_json({change('place')})::VARCHAR", f"to_json({(key or change)('place')})::VARCHAR"
    return f"""'{{"id": ' || event_id || ', "said": [' || to_json({change('text')})::VARCHAR || ', null, 1.50, true, [[{{"deep" : ' || {path} || '}}]]], ' || {name} || ': {{}}}}'"""


def _placeholders_sql() -> str:
    now = "args"
    for i, (value, label, _) in enumerate(VALUES):
        for name, (prefix, word, any_case) in T.PLACEHOLDERS.items():
            if label.startswith(name) if prefix else label == name:
                done = f"regexp_replace({now}, regexp_escape('{value}'), '{word}', '{'gi' if any_case else 'g'}')"
                for part in value.split() if name == "ID_FULL_NAME" else ():
                    done = rf"regexp_replace({done}, '\b{part}\b', '{word}', 'gi')"
                now = f"(CASE WHEN (submission + {i}) % 3 <> 0 THEN {done} ELSE {now} END)"
    return f"regexp_replace(regexp_replace({now}, '{T.ANY_MAIL}', '[email]', 'g'), '{T.ANY_PHONE}', '[phone]', 'g')"


def _same(text: str) -> str:
    return text


_PLACED = f"(SELECT *, path || ' ' || command AS place FROM {ROWS_SQL})"
ORACLE_SQL = {
    "redacted_payloads": f"SELECT event_id, {_payload_sql(_gone)} AS payload FROM {_PLACED}",
    "redacted_files": f"SELECT event_id, {_gone('file')} AS path, {_gone('text')} AS content FROM (SELECT *, path || '/' || command AS file FROM {ROWS_SQL} WHERE has_call)",
    "redacted_rows": f"""SELECT event_id, role, CASE WHEN role IN ('user', 'custom') THEN text ELSE {_gone('text')} END AS text, CASE WHEN role IN ('user', 'custom') THEN text ELSE {_gone('text')} END AS thinking,
      CASE WHEN role = 'toolResult' THEN {_payload_sql(_gone, _same)} ELSE {_payload_sql(_same)} END AS details, CASE WHEN role = 'custom' THEN {_payload_sql(_gone, _same)} ELSE {_payload_sql(_same)} END AS data, command FROM {_PLACED}""",
    "placeholder_texts": f"SELECT event_id, {_placeholders_sql()} AS text FROM {ROWS_SQL}",
    "generic_health_files": f"SELECT event_id, CASE WHEN content IS NOT NULL AND {HAS_HEALTH_SQL} AND {_any('(content || chr(10) || path)', T.HEALTH_CONTEXT)} THEN '{GENERIC}' ELSE content END AS content FROM (SELECT *, CASE WHEN event_id % 4 > 0 THEN text END AS content FROM {ROWS_SQL} WHERE has_call)",
}
