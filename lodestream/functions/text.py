"""Text scalars as columns: patterns built from values, redaction of lines, squeezing, keys, paths, topics."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions import terms as T

#: What stands for any separator between the words of a value (fixed value).
GAP = r"[\s._:/-]*"
FREQUENCY = r"once|twice|three\s+times|four\s+times|daily|nightly|weekly|monthly|morning|evening|bedtime|prn|bid|tid|qid|as\s+needed"


def quoted(value: Column) -> Column:
    """The value as a literal pattern."""
    return F.regexp_replace(value, r"([\\.\[\]{}()*+?^$|])", r"\\$1")


def replace_literal(text: Column, value: Column, token: str = T.REDACTION_TOKEN) -> Column:
    """Every occurrence of the value, in any case, becomes the token."""
    return F.when(F.length(value) > 0, F.regexp_replace(text, F.concat(F.lit("(?iu)"), quoted(value)), F.lit(token))).otherwise(text)


def flexible_pattern(value: Column) -> Column:
    """The value's words and numbers with any separators between, and street suffixes in any spelling; null below two parts."""
    parts = F.regexp_extract_all(value, F.lit(r"[A-Za-z]+|\d+(?:\.\d+)?"), 0)
    spelt = F.create_map(*[F.lit(x) for pair in T.ADDRESS_SUFFIXES.items() for x in pair])
    shown = F.transform(parts, lambda p: F.coalesce(F.element_at(spelt, F.lower(p)), F.regexp_replace(p, r"\.", r"\\.")))
    return F.when(F.size(parts) >= 2, F.concat(F.lit(r"(?<!\w)"), F.array_join(shown, GAP), F.lit(r"(?!\w)")))


def digit_pattern(value: Column) -> Column:
    """The value's digits with spaces or dashes between; null below eight digits."""
    digits = F.regexp_replace(value, r"\D", "")
    joined = F.array_join(F.split(digits, ""), r"[\s-]*")
    return F.when(F.length(digits) >= 8, F.concat(F.lit(r"(?<!\d)"), joined, F.lit(r"(?!\d)")))


def medication_pattern(value: Column) -> Column:
    """The medication's name with an optional dose and frequency; null if the value doesn't begin with a name."""
    name = F.regexp_extract(value, r"^\s*([A-Za-z][A-Za-z-]{2,})\b", 1)
    dose = r"(?:\s+\d+(?:\.\d+)?\s*(?:mcg|mg|g|ml|units?)\.?)?"
    return F.when(name != "", F.concat(F.lit(r"\b"), name, F.lit(rf"\b{dose}(?:\s+(?:{FREQUENCY}))*")))


def entity_patterns(value: Column, label: Column) -> Column:
    """All patterns of an entity, in the order in which they apply."""
    medicine = F.when(label.contains("HEALTH_MEDICATION"), medication_pattern(value))
    return F.array_compact(F.array(quoted(value), flexible_pattern(value), digit_pattern(value), medicine))


def redact_values(text: Column, entities: Column, token: str = T.REDACTION_TOKEN) -> Column:
    """Apply the patterns of all entities (an array of structs with text and label, longest first)."""
    patterns = F.flatten(F.transform(entities, lambda e: entity_patterns(e["text"], e["label"])))
    return F.aggregate(patterns, F.coalesce(text, F.lit("")), lambda t, p: F.regexp_replace(t, F.concat(F.lit("(?iu)"), p), F.lit(token)))


def redact_profile_lines(text: Column, token: str = T.REDACTION_TOKEN) -> Column:
    """Sensitive bullets of a profile go; other sensitive lines keep their label only."""

    def one(line: Column) -> Column:
        body = F.regexp_replace(line, "[\r\n]+$", "")
        bullet = body.rlike(r"^\s*[-*]\s+")
        named = reduce(lambda a, b: a | b, [F.lower(body).contains(x) for x in T.PROFILE_LINE_WORDS])
        sensitive = named & (F.lower(body).contains(token.lower()) | (bullet & body.contains(":")))
        bold = F.regexp_extract(body, r"^(.+?:\*\*)", 1)
        label = F.when(bold != "", F.concat(bold, F.lit(f" {token}"))).when(body.contains(":"), F.concat(F.split(body, ":")[0], F.lit(f": {token}"))).otherwise(F.lit(token))
        kept = F.when(sensitive & bullet, F.lit(None).cast("string")).when(sensitive, F.concat(label, F.substring(line, F.length(body) + 1, F.length(line)))).otherwise(line)
        return kept

    lines = F.regexp_extract_all(text, F.lit("[^\n]*\n|[^\n]+"), 0)
    return F.array_join(F.array_compact(F.transform(lines, one)), "")


def fragments(text: Column, stopwords: tuple[str, ...] = T.STOPWORDS) -> Column:
    """Lower-cased words of more than three characters that are no stopwords."""
    stops = F.array(*[F.lit(x) for x in stopwords]) if stopwords else F.array().cast("array<string>")
    return F.filter(F.split(F.lower(text), r"(?U)\W+"), lambda w: (F.length(w) > 3) & ~F.array_contains(stops, w))


def has_entity(text: Column, value: Column, level: Column, stopwords: tuple[str, ...] = T.STOPWORDS, single: bool = True) -> Column:
    """The value stands in the text; from level 3 on, also two of its fragments, or (``single``) its only one."""
    found = F.lower(text).contains(F.lower(value))
    parts = fragments(value, stopwords)
    hits = F.size(F.filter(parts, lambda w: F.lower(text).contains(w)))
    some = (hits >= 2) | ((F.size(parts) == 1) & (hits == 1)) if single else hits >= 2
    return F.coalesce(found, F.lit(False)) | ((level >= 3) & some)


def word_bounded(text: Column, value: Column) -> Column:
    return F.regexp_like(text, F.concat(F.lit(r"(?<![A-Za-z0-9_])"), quoted(value), F.lit(r"(?![A-Za-z0-9_])")))


def is_real_value(value: Column) -> Column:
    """A value that means something when it occurs again: not a short or common word."""
    s = F.coalesce(value, F.lit(""))
    plain = s.rlike(r"^[\p{L}\p{N}]+$")
    return (s != "") & (~plain | F.when(s.rlike(r"^\d+$"), F.length(s) >= 2).otherwise((F.length(s) >= 4) & ~F.lower(s).isin(*T.COMMON_VALUES)))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def squeeze(text: Column) -> Column:
    """Runs of spaces become one, three line ends or more two."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "  +", " "), r"\n\s*\n\s*\n", "\n\n"))


def normalise_punctuation(text: Column) -> Column:
    """Long dashes become commas, emoji go, and what that leaves is put right."""
    steps = (
        ("—", ","), (r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}\x{2600}-\x{26FF}\x{FE0F}]+", ""), (r"\.\s+([a-z])", r", $1"), (r"\s+,", ","), (r",\s*,", ","), (r"\s+\.", "."),
        (r"[ \t]{2,}", " "),
    )
    return reduce(lambda t, s: F.regexp_replace(t, *s), steps, text)


def vault_key(*names: Column, path: Column) -> Column:
    """A key from the first name given, else from the path's last part: other characters become underscores, 80 at most."""
    leaf = F.element_at(F.split(F.regexp_replace(F.trim(path), "/+$", ""), "/"), -1)
    said = F.coalesce(*[F.nullif(F.trim(n), F.lit("")) for n in names], F.nullif(leaf, F.lit("")), F.lit("sensitive_data"))
    return F.substring(F.regexp_replace(said, r"[^A-Za-z0-9_.:-]+", "_"), 1, 80)


def shell_value(command: Column) -> Column:
    """What a printf or echo writes to a file or pipe; the command itself otherwise."""
    found = F.regexp_extract(command, r"(?s)(?:printf|echo)\s+(['\"])(.*?)\1\s*(?:>|>>|\|)", 2)
    return F.when(found != "", found).otherwise(command)


def resource_path(text: Column) -> Column:
    """The first quoted file name in the text, else the first bare one."""
    ending = r"\.(?:docx?|md|markdown|pdf|html?|png|jpe?g|webp|gif)"
    inside = F.regexp_extract(text, rf"(?i)['\"`]([^'\"`]+{ending})['\"`]", 1)
    bare = F.regexp_extract(text, rf"(?i)(?:[/~]?[\w.-]+/)*[\w.-]+{ending}", 0)
    return F.coalesce(F.nullif(F.trim(inside), F.lit("")), F.nullif(bare, F.lit("")), F.lit("provided_resource"))


def strip_prefix(path: Column, *prefixes: str) -> Column:
    """The path within the workspace."""
    return F.regexp_replace(path, "^(" + "|".join(re.escape(p) for p in prefixes) + ")/?", "")


def topic(text: Column) -> Column:
    """The topic of the first group of which a word occurs."""
    lowered = F.lower(text)
    return reduce(lambda c, g: c.when(reduce(lambda a, b: a | b, [lowered.contains(w) for w in g[0]]), F.lit(g[1])), T.TOPICS, F.when(F.lit(False), F.lit("")))


def level_token(text: Column) -> Column:
    return F.regexp_extract(text, r"\b(L[0-4])\b", 1)


def cut_middle(text: Column, most: int, mark: str = "\n...[cut]...\n") -> Column:
    """Head and tail of a text that is too long."""
    half = most // 2
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(half)), F.lit(mark), F.right(text, F.lit(half)))).otherwise(text)


def perturb(text: Column, seed: Column, abbreviations: dict[str, str]) -> Column:
    """Words that the caller lists are abbreviated, each by a seeded coin; the same seed gives the same text."""
    known = F.create_map(*[F.lit(x) for pair in abbreviations.items() for x in pair])

    def one(word: Column, at: Column) -> Column:
        short = F.element_at(known, F.lower(word))
        return F.when(short.isNotNull() & (F.conv(F.substring(F.md5(F.concat_ws(":", seed, at).cast("binary")), 1, 1), 16, 10).cast("int") < 8), short).otherwise(word)

    return F.array_join(F.transform(F.split(text, " "), one), " ")


def drop_noise_lines(text: Column, words: tuple[str, ...] = T.NOISE_LINES) -> Column:
    """Lines with credentials, mail addresses or document ids go."""

    def kept(line: Column) -> Column:
        lowered = F.lower(line)
        named = reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])
        id_like = line.rlike(r"\b[0-9A-Za-z_-]{25,}\b") & (lowered.contains("doc") | lowered.contains("id"))
        return ~named & ~line.rlike(r"[\w.+-]+@[\w-]+\.[\w.-]+") & ~id_like

    return F.array_join(F.filter(F.split(text, "\n"), kept), "\n")


def drop_claims(text: Column, default: str) -> Column:
    """Sentences that claim a saved file go; what is left, or the default."""
    claim = "(?i)(" + "|".join(T.FALSE_CLAIMS) + ")"
    left = F.trim(F.array_join(F.filter(sentences(text), lambda s: ~s.rlike(claim)), " "))
    return F.when(left.isin("", "Yep.", "Ok.", "Okay.", "Done.", "Sure."), F.lit(default)).otherwise(left)
