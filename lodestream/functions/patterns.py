"""Rule table of sensitive-value patterns, and the columns that apply it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label, level, pattern, confidence.
PATTERNS = (
    ("ID_EMAIL", "L2", r"[\w.+-]+@[\w-]+\.[\w.-]+", 0.95),
    ("ID_PHONE", "L2", r"\b(?:\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", 0.85),
    ("GOV_SSN_FULL", "L4", r"\b\d{3}-\d{2}-\d{4}\b", 0.95),
    ("HEALTH_INSURANCE_ID", "L2", r"(?i)\b(?:UHC|BCBS|Aetna|Cigna|Kaiser|Humana)[\s-]?\w*[\s-]?\d[\d-]{5,}\b", 0.85),
)
#: Rules of this library beside them.
MORE_PATTERNS = (
    ("FIN_CARD_FULL", "L4", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", 0.8),
    ("NET_IP", "L1", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", 0.7),
    ("SEC_PASSWORD", "L4", r"(?:password|passwd|pwd|token|secret|api_key)\s*[=:]\s*\S{4,}", 0.9),
)
RULES = PATTERNS + MORE_PATTERNS
LEVELS = {"L0": 0, "L1": 1, "L2": 2, "L3": 3, "L4": 4, "BLOCK": 5}
#: What a text must hold for a rule to be tried at all: a cheap test that spares most texts the pattern.
NEEDS = {
    "ID_EMAIL": lambda t: t.contains("@"),
    "ID_PHONE": lambda t: t.rlike("[0-9]{3}"),
    "GOV_SSN_FULL": lambda t: t.rlike("[0-9]{3}-[0-9]{2}-"),
    "HEALTH_INSURANCE_ID": lambda t: t.rlike("[0-9]{2}"),
    "FIN_CARD_FULL": lambda t: t.rlike("[0-9]{4}"),
    "NET_IP": lambda t: t.rlike("[0-9]\\.[0-9]"),
    "SEC_PASSWORD": lambda t: t.contains("=") | t.contains(":"),
}
HIT = "array<struct<label:string,level:string,hit:string,start:int,confidence:double>>"


def level_rank(level: Column, default: int = 0) -> Column:
    """The order of a sensitivity level; an unknown one has the default's."""
    pairs = [F.lit(x) for item in LEVELS.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[level], F.lit(default))


def pattern_hits(text: Column) -> Column:
    """All pattern hits in a text: an array of (label, level, hit, start, confidence), one regex pass per rule that can apply."""
    return F.concat(*[_hits_of(text, *rule) for rule in RULES])


def _hits_of(text: Column, label: str, level: str, pattern: str, confidence: float) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # A hit starts behind all that stands between the hits so far, and these hits.
    def started(hit: Column, at: Column) -> Column:
        gone = F.aggregate(F.slice(between, 1, at + 1), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(F.slice(found, 1, at), F.lit(0), lambda n, x: n + F.length(x))
        return F.struct(F.lit(label).alias("label"), F.lit(level).alias("level"), hit.alias("hit"), gone.alias("start"), F.lit(confidence).alias("confidence"))

    return F.when(NEEDS[label](text), F.transform(found, started)).otherwise(F.array().cast(HIT))
