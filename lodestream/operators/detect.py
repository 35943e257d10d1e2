"""Detection of a persona's values in texts and calls, with their levels and where they came from.

A persona's values are a short list (``entities``: an array of structs with
number, text, label, level), joined once by stream; texts scan the list, so no
row of a text and a value ever forms unless the value is found.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import text as X


def held_by(entities: DataFrame, by: list[str], name: str = "held") -> DataFrame:
    """One row per stream with its values as an array, in their order; each with its lower-cased form and its fragments."""
    listed = entities.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("number", "text", "label", "level"))).alias(name))
    full = lambda e: F.struct(e["number"].alias("number"), e["text"].alias("text"), e["label"].alias("label"), e["level"].alias("level"), F.lower(e["text"]).alias("low"), X.fragments(e["text"]).alias("parts"))
    return listed.withColumn(name, F.transform(name, full))


def no_values() -> Column:
    return F.array().cast("array<struct<number:int,text:string,label:string,level:int,low:string,parts:array<string>>>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def occurrences(text: Column, value: Column) -> Column:
    """Starts (from 0) of all occurrences of a value in a text, case-sensitive."""
    parts = F.split(text, X.quoted(value), -1)
    counted = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.aggregate(F.slice(parts, 1, i), F.lit(0), lambda n, p: n + F.length(p)) + (i - 1) * F.length(value))
    return F.when(F.size(parts) > 1, counted).otherwise(F.array().cast("array<int>"))


def context_names(text: Column, false_names: tuple[str, ...] = ()) -> Column:
    """Names of two or three capitalised words behind "About", "Built .. for" or "plan for"; known false ones are left out."""
    found = F.regexp_extract_all(text, F.lit(r"(?:About|Built .* for|plan for)\s+([A-Z][a-z]{2,}(?:\s+[A-Z][a-z]{2,}){1,2})\b"), 1)
    return F.filter(found, lambda n: ~F.lower(n).isin(*false_names)) if false_names else found


def source_of(role: Column, tool: Column) -> Column:
    """Where a text came from: the user, the assistant's own words, a memory read or another call."""
    return F.when(role == "user", "user_input").when(tool.isNull(), "assistant_text").when(tool.isin(*T.MEMORY_READ_TOOLS), "memory_read").otherwise("tool_result")


def matched_values(content: Column, held: Column) -> Column:
    """The values that a text holds, in three layers.

    First the values that stand in it; then, of level 3 or more, those of which
    two fragments (or the only one) stand in it; and if none of level 3 is
    found, all values of the first domain (health, government, finance) that
    has such values and of which a keyword stands in it.
    """
    domain = reduce(
        lambda chain, d: chain.when(P.any_of(content, T.DOMAIN_WORDS[d]) & F.exists(held, lambda e: (e["level"] >= 3) & e["label"].startswith(d)), F.lit(d)), T.DOMAIN_WORDS, F.when(F.lit(False), F.lit(""))
    )

    def stands(low: Column, e: Column) -> Column:
        hits = F.size(F.filter(e["parts"], lambda w: low.contains(w)))
        return low.contains(e["low"]) | ((e["level"] >= 3) & ((hits >= 2) | ((F.size(e["parts"]) == 1) & (hits == 1))))

    def settle(marks: Column) -> Column:
        found = F.filter(held, lambda e, i: marks[i])
        of_domain = lambda d: F.filter(held, lambda e, i: ~marks[i] & (e["level"] >= 3) & F.coalesce(e["label"].startswith(d), F.lit(False)))
        return F.when(F.exists(found, lambda e: e["level"] >= 3), found).otherwise(F.concat(found, let(domain, of_domain)))

    marked = let(F.lower(F.coalesce(content, F.lit(""))), lambda low: F.transform(held, lambda e: F.coalesce(stands(low, e), F.lit(False))))
    return let(marked, settle)


def highest(found: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(found, lambda e: e["level"])), F.lit(0))


def argument_level(args: Column, held: Column) -> Column:
    """The highest level of a value in the arguments; 3 at least for health words where the persona has health values."""
    low = F.lower(F.coalesce(args, F.lit("")))
    direct = highest(F.filter(held, lambda e: low.contains(F.lower(e["text"]))))
    health = F.exists(held, lambda e: (e["level"] >= 3) & (F.lower(e["label"]).contains("health") | F.lower(e["label"]).contains("medical") | F.lower(e["text"]).contains("allerg")))
    return F.greatest(direct, F.when(health & P.any_of(args, T.HEALTH_ARGUMENTS), 3).otherwise(0))


def has_health_values(held: Column) -> Column:
    return F.exists(held, lambda e: (e["level"] >= 3) & (e["label"].contains("HEALTH") | e["label"].contains("MEDICAL") | e["label"].contains("DIAGNOS")))


def has_card_values(held: Column) -> Column:
    marked = lambda e: reduce(lambda a, b: a | b, [F.upper(e["label"]).contains(m) for m in T.CARD_LABELS])
    return F.exists(held, lambda e: (e["level"] >= 4) & marked(e))


def discloses(text: Column, held: Column, least: int = 3, shortest: int = 3) -> Column:
    """Whether a text holds a value of that level, or two fragments of it."""
    some = F.filter(held, lambda e: (e["level"] >= least) & (F.length(F.trim(e["text"])) >= shortest))
    return F.exists(some, lambda e: X.has_entity(F.coalesce(text, F.lit("")), e["text"], e["level"], (), single=False))


def stale_values(args: Column, current: Column, prior: Column, approved: Column, held: Column) -> Column:
    """Values of level 3 or more in a call's arguments that neither the current user message gave, nor the one before it where
    the current one just approves; all of them if one is stale, none if one is fresh."""
    low = F.lower(args)
    used = F.filter(held, lambda e: (e["level"] >= 3) & low.contains(F.lower(e["text"])))
    said = lambda text: F.exists(used, lambda e: X.has_entity(F.coalesce(text, F.lit("")), e["text"], e["level"], ()))
    fresh = said(current) | (approved & said(prior))
    return F.when(fresh, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(used, lambda e: e["text"])))


def health_text(text: Column, held: Column) -> Column:
    """A text with a value of level 3 or 4, or with words of symptoms where the persona has health values."""
    words = r"\b(asthma|inhaler|albuterol|symptom|shortness|breath|waking up|nighttime|doctor|clinic|insurance|referral|medication|meds)\b"
    return F.exists(held, lambda e: (e["level"] >= 3) & (F.lower(text).contains(F.lower(e["text"])) | (e["label"].startswith("HEALTH") & P.matches(text, words))))


def memory_issues(text: Column) -> Column:
    """What a memory text still holds: numbers, keys, credentials, cards (by checksum or by their line's words), health lines."""
    scan = F.replace(text, F.lit(T.REDACTION_TOKEN), F.lit(""))
    lines = F.split(scan, "\n")
    card_word = lambda line: reduce(lambda a, b: a | b, [F.lower(line).contains(w) for w in ("card", "credit", "debit", "pan", "cc ")])
    candidate = F.lit(r"(?<!\d)(?:\d[ -]?){13,19}(?!\d)")
    card = F.exists(lines, lambda line: F.exists(F.regexp_extract_all(line, candidate, 0), lambda c: F.coalesce(F.call_function("luhn_check", F.regexp_replace(c, r"\D", "")), F.lit(False)) | card_word(line)))
    health = F.exists(lines, lambda line: ~P.is_safe_memory_line(line) & line.rlike(r"(?i)\b(?:diagnosis|condition|medication|allergy|allergies|symptom|patient|health)\b\s*[:=]\s*[^,\n;]{3,}"))
    rules = {
        "ssn": scan.rlike(r"\b\d{3}-\d{2}-\d{4}\b"),
        "iban": scan.rlike(r"\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b"),
        "api_key": scan.rlike(r"(?i)\b(?:sk|pk|rk|xox[baprs]|gh[pousr])-[A-Za-z0-9_-]{8,}\b"),
        "credential": scan.rlike(r"(?i)\b(?:password|passcode|api[_ -]?key|secret|token|credential|cvv|cvc|ssn)\b\s*[:=]\s*[^\s,;]{3,}"),
        "card": card,
        "health": health,
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def earliest_source(segments: DataFrame, held: DataFrame, by: list[str], order: str) -> DataFrame:
    """Of every value the first segment of its stream that holds it: by, number, place, source; values never seen are 'history'."""
    rows = segments.join(held, by)
    hits = rows.select(*by, order, "source", F.explode(F.filter("held", lambda e: F.lower("text").contains(F.lower(e["text"])))).alias("e"))
    first = hits.groupBy(*by, F.col("e.number").alias("number")).agg(F.min(order).alias("place"), F.min_by("source", order).alias("source"))
    all_of = held.select(*by, F.explode("held").alias("e")).select(*by, "e.number")
    return all_of.join(first, [*by, "number"], "left").select(*by, "number", F.coalesce("place", F.lit(-1)).alias("place"), F.coalesce("source", F.lit("history")).alias("source"))


def user_context(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds the current and the prior user text, and the assistant's text before, as of each row (empty if there is none)."""
    now = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    is_user = F.col("role") == "user"
    rows = df.withColumn("_prior", F.when(is_user, F.coalesce(F.last(F.when(is_user, F.col("text")), ignorenulls=True).over(before), F.lit(""))))
    asked = F.last(F.when(F.col("role") == "assistant", F.col("text")), ignorenulls=True).over(before)
    out = rows.withColumn("current_user", F.coalesce(F.last(F.when(is_user, F.col("text")), ignorenulls=True).over(now), F.lit("")))
    return out.withColumn("prior_user", F.coalesce(F.last("_prior", ignorenulls=True).over(now), F.lit(""))).withColumn("asked_before", F.coalesce(asked, F.lit(""))).drop("_prior")
