"""Preference pairs: decision points, rejected alternatives, rewards, reports.

Templates of alternatives are the caller's data; the engine ships none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import terms as T
from lodestream.functions import values as V
from lodestream.operators.cascade import branch
from lodestream.operators.policy import criticality


def decision_points(calls: DataFrame, by: list[str], order: str, least: float = 0.3) -> DataFrame:
    """Calls with their branch and criticality, those of at least ``least``.  ``calls``: by, order, tier, level, text, acted."""
    refused = reduce(lambda a, b: a | b, [F.lower("text").contains(w) for w in T.REFUSAL_MARKS])
    c = calls.withColumn("branch", branch(F.col("level"), F.col("tier"), refused))
    weight = F.when(F.col("branch").isin("R_correct", "A_wrong"), 0.3).when(F.col("branch") == "R_wrong", 0.2).otherwise(0.0)
    c = c.withColumn("criticality", criticality(F.col("level"), F.col("tier"), weight, F.col("acted")))
    n = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("criticality"), order))
    return c.filter(F.col("criticality") >= least).withColumn("rank", n.cast("long"))


def recent_messages(rows: DataFrame, by: list[str], order: str, name: str, n: int = 2, most: int = 300) -> DataFrame:
    """``rows`` with the last n user texts up to each row, each cut, as an array.

    The texts go from user row to user row, one further at a time, so a row
    holds n of them at most, however long its stream is.
    """
    w = Window.partitionBy(*by).orderBy(order)
    out = rows.withColumn("_said1", F.when(F.col("role") == "user", F.substring("text", 1, most)))
    for k in range(2, n + 1):
        before = F.last(f"_said{k - 1}", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn(f"_said{k}", F.when(F.col("_said1").isNotNull(), before))
    said = F.when(F.col("_said1").isNotNull(), F.array_compact(F.array(*[F.col(f"_said{k}") for k in range(n, 0, -1)])))
    held = F.last(said, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn(name, F.coalesce(held, F.array().cast("array<string>"))).drop(*[f"_said{k}" for k in range(1, n + 1)])


def template_key(tool: Column, args: Column, known: list[str], default: str = "exec") -> Column:
    """The template group of a call: deletions have one of their own, tools without one that of ``default``."""
    return F.when((tool == "exec") & args.contains("rm "), "exec_rm").when(tool.isin(*known), tool).otherwise(default)


def reward_range(mode: Column, severity: Column, default: tuple[float, float] = (0.3, 0.5)) -> tuple[Column, Column]:
    ranges = F.create_map(*[x for (m, s), r in T.REWARD_RANGES.items() for x in (F.lit(f"{m}|{s}"), F.array(F.lit(r[0]), F.lit(r[1])))])
    found = F.coalesce(ranges[F.concat_ws("|", mode, severity)], F.array(F.lit(default[0]), F.lit(default[1])))
    return found[0], found[1]


def heuristic_reward(mode: Column, severity: Column, violates: Column) -> Column:
    """The fixed reward of a failure mode and severity, else by severity of a violation, else that of its kind."""
    table = F.create_map(*[F.lit(x) for (m, s), r in T.REWARDS.items() for x in (f"{m}|{s or ''}", r)])
    known = table[F.concat(mode, F.lit("|"), F.coalesce(severity, F.lit("")))]
    by_severity = F.when(severity == "critical", 0.1).when(severity == "major", 0.25).otherwise(0.4)
    return F.coalesce(known, F.when(violates, by_severity).when(mode == "over_refusal", 0.6).otherwise(0.4))


def rejected_alternatives(points: DataFrame, templates: DataFrame, by: list[str], key: str, n: int = 9) -> DataFrame:
    """``n`` alternatives of each point from the templates of its key, picked and scored by a seed; too few are repeated.

    ``templates``: key, number, mode, severity, response (with {topic} and {example}); ``points`` also have topic and example.
    """
    picks = templates.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("number", "mode", "severity", "response"))).alias("_all"))
    joined = points.join(F.broadcast(picks) if picks.limit(1001).count() <= 1000 else picks, key)
    order = F.array_sort(F.transform("_all", lambda t: F.struct(F.md5(F.concat_ws(":", *by, t["number"]).cast("binary")).alias("draw"), t.alias("t"))))
    chosen = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(i.alias("place"), order[(i % F.size(order)).cast("int")]["t"].alias("t")))
    flat = joined.select(*points.columns, F.inline(chosen)).select(*points.columns, "place", "t.mode", "t.severity", "t.response")
    low, high = reward_range(F.col("mode"), F.col("severity"))
    text = F.replace(F.replace(F.col("response"), F.lit("{topic}"), F.col("topic")), F.lit("{example}"), F.col("example"))
    return flat.withColumn("response", text).withColumn("reward", V.uniform(F.concat_ws(":", *by, "place"), low, high))


def pairs(points: DataFrame, rejected: DataFrame, by: list[str]) -> DataFrame:
    """Each point with its rejected alternatives as an array, worst reward first."""
    held = rejected.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("reward", "place", "mode", "severity", "response"))).alias("rejected"))
    return points.join(held, by)


def single_pairs(pairs_: DataFrame, by: list[str], prompt: str, chosen: str) -> DataFrame:
    """One row (prompt, chosen, rejected, reward) for each rejected alternative."""
    return pairs_.select(*by, F.col(prompt).alias("prompt"), F.col(chosen).alias("chosen"), F.explode("rejected").alias("r")).select(*by, "prompt", "chosen", F.col("r.response").alias("rejected"), F.col("r.reward").alias("reward"), F.col("r.place").alias("place"))


def turn_pairs(rejected: DataFrame, by: list[str]) -> DataFrame:
    """By turn: the worst alternative, the mean reward and the number of alternatives."""
    worst = F.min_by(F.struct("mode", "reward"), F.struct("reward", "place"))
    return rejected.groupBy(*by).agg(worst.alias("w"), F.bround(F.avg("reward"), 6).alias("mean_reward"), F.count("*").alias("n")).select(*by, F.col("w.mode").alias("worst_mode"), F.col("w.reward").alias("worst_reward"), "mean_reward", "n")


def report(rejected: DataFrame, by: list[str]) -> DataFrame:
    """Averages and shares of the alternatives: violations are all but refusals and inventions; balance asks a fifth of refusals."""
    refusal = F.col("mode") == "over_refusal"
    violation = ~F.col("mode").isin("over_refusal", "hallucination")
    share = F.count_if(refusal) / F.greatest(F.count("*"), F.lit(1))
    return rejected.groupBy(*by).agg(F.count("*").alias("n"), F.bround(F.avg("reward"), 6).alias("mean_reward"), F.count_if(violation).alias("n_violations"), F.bround(share, 6).alias("refusal_share"), (share >= 0.2).alias("refusals_suffice"))


def parse_alternatives(text: Column) -> Column:
    """A model's reply as alternatives: mode, severity, rule, response, violates; empty if it holds no list.

    The list stands by itself, in a code fence, or between other words.  An
    alternative breaks a rule if it names one and its mode is no refusal or invention; only such
    a one keeps its severity.  Items that are no objects go.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[^\n]*\n?", ""), r"\s*```$", "")
    inner = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    listed = F.coalesce(F.try_variant_get(F.try_parse_json(bare), "$", "array<variant>"), F.try_variant_get(F.try_parse_json(inner), "$", "array<variant>"), F.array().cast("array<variant>"))
    said = lambda v, f, default: F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit(default))

    def one(v: Column) -> Column:
        mode, rule = said(v, "failure_mode", "hallucination"), F.try_variant_get(v, "$.privacy_violation_rule", "string")
        breaks = rule.isNotNull() & ~mode.isin("over_refusal", "hallucination")
        return F.struct(mode.alias("mode"), F.when(breaks, said(v, "severity", "minor")).alias("severity"), rule.alias("rule"), said(v, "assistant_response", "").alias("response"), breaks.alias("violates"))

    return F.transform(F.filter(listed, lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))), one)


def adversarial_alternatives(points: DataFrame, templates: DataFrame, by: list[str], n: int = 9) -> DataFrame:
    """``n`` alternatives for each point at which the user tried to get around the rules: all comply, so all are violations.

    ``templates``: number, mode, severity, response; the bank is the caller's.  Rewards of modes without a range lie between 0.01 and 0.08.
    """
    keyed = rejected_alternatives(points.withColumn("_bank", F.lit("adversarial")), templates.withColumn("_bank", F.lit("adversarial")), by, "_bank", n)
    low, high = reward_range(F.col("mode"), F.col("severity"), (0.01, 0.08))
    return keyed.drop("_bank").withColumns({"reward": V.uniform(F.concat_ws(":", *by, "place"), low, high), "violates": F.lit(True), "perturbation": F.lit("adversarial")})
