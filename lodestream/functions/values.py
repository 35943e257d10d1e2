"""Scalars on times, scores and JSON texts; none depends on the session's time zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions import terms as T

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_ms(value: Column) -> Column:
    """Milliseconds of a number (taken as it is) or an ISO time (UTC where it names no zone); 0 for anything else."""
    plain = value.rlike(r"^\s*[+-]?\d+(\.\d+)?\s*$")
    zoned = F.when(value.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), value).otherwise(F.concat(value, F.lit("Z")))
    return F.coalesce(F.when(plain, F.floor(value.try_cast("double")).cast("long")).otherwise(F.unix_millis(F.try_to_timestamp(zoned))), F.lit(0).cast("long"))


def iso_of(ms: Column) -> Column:
    second = F.timestamp_add("SECOND", F.floor(ms / 1000).cast("int"), F.expr(_EPOCH))
    return F.date_format(F.timestamp_add("MILLISECOND", F.pmod(ms, F.lit(1000)).cast("int"), second), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def shift_iso(value: Column, ms: int) -> Column:
    return iso_of(epoch_ms(value) + ms)


def reference_ms(name: Column) -> Column:
    """The start time in a session file's name; microseconds become milliseconds, other names null."""
    raw = F.regexp_extract(name, r"(?:^|/)sess-(\d+)-T-\d{3}-\d{2}\.jsonl$", 1).try_cast("long")
    return F.when(raw > 10_000_000_000_000, F.floor(raw / 1000)).otherwise(raw)


def luhn_valid(digits: Column) -> Column:
    return F.coalesce(F.call_function("luhn_check", digits), F.lit(False))


def parse_score(text: Column) -> Column:
    """The score in a reply: its JSON field, else the first number behind the word, between 0 and 1; 0.5 if there is none."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^```[^\n]*\n", ""), r"```\s*$", "")
    field = F.try_variant_get(F.try_parse_json(bare), "$.score", "double")
    loose = F.regexp_extract(text, r'"score"[^0-9.]*([0-9.]+)', 1).try_cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(field, loose, F.lit(0.5))))


def draw(seed: Column) -> Column:
    """A number from 0 to below 1 that depends on the seed alone."""
    return F.conv(F.substring(F.md5(seed.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296


def uniform(seed: Column, low: Column, high: Column) -> Column:
    return F.bround(low + (high - low) * draw(seed), 3)


def capped(score: Column, serious: Column, hard: float, soft: float, default: float) -> Column:
    """A score after the gates: at most ``hard`` with a serious issue, at most ``soft`` with a minor one."""
    return F.least(F.coalesce(score, F.lit(default)), F.when(serious, F.lit(hard)).otherwise(F.lit(soft)))


def json_in_reply(text: Column) -> Column:
    """The JSON of a reply: without code fences, else what lies between the outer braces; null if neither parses."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.to_json(F.coalesce(F.try_parse_json(bare), F.try_parse_json(inner)))


def write_payload(content: Column, edits: Column, command: Column) -> Column:
    """What a call would write: its content, else its edits' new texts, else its command."""
    return F.coalesce(F.nullif(content, F.lit("")), F.nullif(F.array_join(F.transform(edits, lambda e: e["newText"]), " "), F.lit("")), command, F.lit(""))


def valid_edits_only(edits: Column) -> Column:
    return F.filter(edits, lambda e: e["oldText"].isNotNull() & e["newText"].isNotNull())


def denied_labels(reply: Column) -> Column:
    """The labels of the fields that a reply names, sorted."""
    said = F.lower(F.coalesce(reply, F.lit("")))
    none = F.array().cast("array<string>")
    named = [F.when(said.contains(word), F.array(*[F.lit(x) for x in labels])).otherwise(none) for word, labels in T.DENIED_FIELDS.items()]
    return F.array_sort(F.array_distinct(F.concat(*named)))


def remap_keys(arguments: Column, names: Column) -> Column:
    """A map with its keys renamed where ``names`` (a map) has a name for them."""
    return F.transform_keys(arguments, lambda k, _: F.coalesce(F.element_at(names, k), k))


def without_keys(arguments: Column, dropped: tuple[str, ...]) -> Column:
    return F.map_filter(arguments, lambda k, _: ~k.isin(*dropped))


def first_label(text: Column, groups: tuple[tuple[tuple[str, ...], str], ...], default: str) -> Column:
    """The label of the first group of which a word occurs."""
    low = F.lower(text)
    chain = reduce(lambda c, g: c.when(reduce(lambda a, b: a | b, [low.contains(w) for w in g[0]]), F.lit(g[1])), groups, F.when(F.lit(False), F.lit(default)))
    return chain.otherwise(F.lit(default))
