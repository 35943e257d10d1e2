"""Quick checks and mends of rewritten turns, before any reviewer sees them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.operators import structure

#: Rules and how grave they are (fixed values).
SEVERITIES = {"ends with a refusal": "critical", "refusal with a closing": "critical", "two answers in a row": "minor", "silent call": "critical"}
FLOW = (
    "struct<thinking:string,text:string,scenario:string,privacy_actions:array<string>,consent_flow:boolean,gate_message:struct<thinking:string,text:string>,"
    "user_response:struct<text:string,consent_decision:string>,execution_message:struct<thinking:string,text:string>>"
)


def quick_issues(turns: DataFrame, by: list[str], closing: str) -> DataFrame:
    """by, turn, code: what a look at the turns alone tells.

    ``turns``: by, turn, text, n_calls, tags (array), user_text (what the user said before the turn,
    null if nothing).  ``closing``: what a closing text holds.
    """
    w = Window.partitionBy(*by).orderBy("turn")
    refusal = F.array_contains("tags", "adversarial_refusal")
    said = F.trim(F.coalesce("text", F.lit(""))) != ""
    first, last = F.lag("turn").over(w).isNull(), F.lead("turn").over(w).isNull()
    gate_before = F.coalesce(F.lag(F.array_contains("tags", "consent_gate")).over(w), F.lit(False))
    asked, asked_before = F.col("user_text").isNotNull(), F.coalesce(F.lag(F.col("user_text").isNotNull()).over(w), F.lit(False))
    rules = {
        "ends with a refusal": last & refusal,
        "refusal with a closing": last & refusal & F.coalesce(F.col("text").contains(closing), F.lit(False)),
        "two answers in a row": ~first & ~asked & ~gate_before,
        "silent call": (F.col("n_calls") > 0) & ~said & (first | asked_before),
    }
    marked = turns.select(*by, "turn", *[rule.alias(f"_{i}") for i, rule in enumerate(rules.values())])
    return structure.issues(marked, [*by, "turn"], {name: F.col(f"_{i}") for i, name in enumerate(rules)})


def mend_turns(turns: DataFrame, by: list[str], closing: str, ack: Column, bye: Column) -> DataFrame:
    """The turns with what can be put right: of a refusal with a closing only the first paragraph stays, and a stream that ends with a refusal
    gets a turn more, in which the user takes note (``ack``) and the assistant ends (``bye``)."""
    w = Window.partitionBy(*by).orderBy("turn")
    last = F.lead("turn").over(w).isNull() & F.array_contains("tags", "adversarial_refusal")
    marked = turns.withColumn("_ends", last)
    both = F.col("_ends") & F.coalesce(F.col("text").contains(closing), F.lit(False))
    kept = marked.withColumn("text", F.when(both, F.split("text", "\n\n")[0]).otherwise(F.col("text")))
    more = kept.filter("_ends").withColumns({"turn": F.col("turn") + 1, "text": bye, "n_calls": F.lit(0).cast(turns.schema["n_calls"].dataType), "tags": F.array().cast(turns.schema["tags"].dataType), "user_text": ack})
    return kept.unionByName(more).drop("_ends").select(*turns.columns)


def settle_turns(turns: DataFrame) -> DataFrame:
    """Calls get a word of what they do where the turn says nothing, results beyond the calls go, typographic marks become plain.

    ``turns``: text, tools (array of the calls' tools), results (array).
    """
    said = F.trim(F.coalesce("text", F.lit(""))) != ""
    word = F.concat(F.lit("Let me "), F.array_join(F.slice("tools", 1, 2), ", "), F.lit(" for you."))
    text = F.translate(F.when((F.size("tools") > 0) & ~said, word).otherwise(F.col("text")), "—–“”‘’", ",,\"\"''")
    return turns.withColumns({"text": text, "results": F.slice("results", F.lit(1), F.size("tools"))})


def expand_flows(rows: DataFrame, keep: list[str], reply: str) -> DataFrame:
    """Replies of a rewriter as turns: one, or for a consent flow the question and then, with the user's answer, what follows.

    ``keep``, seq, thinking, text, scenario, actions, user_text, consent.  A reply that is no JSON object gives no row.
    """
    v = F.from_json(reply, FLOW)
    of_gate = lambda a: a.isin("classify", "consent_gate")
    actions = F.coalesce("v.privacy_actions", F.array().cast("array<string>"))
    none = F.lit(None).cast("string")

    def turn(seq: int, at: str, some: Column, user: Column = none, consent: Column = none) -> Column:
        part = lambda f: F.coalesce(F.col(f"{at}.{f}"), F.lit(""))
        return F.struct(F.lit(seq).alias("seq"), part("thinking").alias("thinking"), part("text").alias("text"), F.col("v.scenario").alias("scenario"), some.alias("actions"), user.alias("user_text"), consent.alias("consent"))

    answer, consent = F.coalesce("v.user_response.text", F.lit("yes")), F.coalesce("v.user_response.consent_decision", F.lit("granted"))
    flow = F.array(turn(0, "v.gate_message", F.filter(actions, of_gate)), turn(1, "v.execution_message", F.filter(actions, lambda a: ~of_gate(a)), answer, consent))
    made = F.when(F.coalesce("v.consent_flow", F.lit(False)), flow).otherwise(F.array(turn(0, "v", actions)))
    parsed = rows.withColumn("v", v).filter(F.schema_of_variant(F.try_parse_json(reply)).startswith("OBJECT"))
    return parsed.select(*keep, F.inline(made))
