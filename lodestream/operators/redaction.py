"""Redaction of event rows, payloads and files: exact patterns first, then what is left of a value in fragments.

``held`` is a persona's values as ``detect.held_by`` lists them.  All functions
are columns, so texts stay in the JVM and rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions import json_text
from lodestream.functions import terms as T
from lodestream.functions import text as X
from lodestream.operators.detect import let


def sensitive(held: Column, least: int = 3) -> Column:
    """The values of that level and of two characters or more, each once, the longest first."""
    chosen = F.filter(held, lambda e: (e["level"] >= least) & (F.length(F.trim(e["text"])) >= 2))
    once = F.filter(chosen, lambda e, i: F.array_position(F.transform(chosen, lambda x: F.trim(x["text"])), F.trim(e["text"])) == i + 1)
    return F.array_sort(once, lambda a, b: F.when(F.length(a["text"]) == F.length(b["text"]), a["number"] - b["number"]).otherwise(F.length(b["text"]) - F.length(a["text"])))


def redact(text: Column, held: Column, token: str = T.REDACTION_TOKEN) -> Column:
    """The text without the sensitive values in any of their spellings, and without sensitive lines of profiles."""
    return X.redact_profile_lines(X.redact_values(text, sensitive(held), token), token)


def still_holds(text: Column, value: Column) -> Column:
    """The value stands in the text, or two of its words of more than three characters do."""
    parts = F.filter(F.split(value["low"], r"(?U)\W+"), lambda w: F.length(w) > 3)
    return let(F.lower(text), lambda low: low.contains(value["low"]) | ((value["level"] >= 3) & (F.size(F.filter(parts, lambda w: low.contains(w))) >= 2)))


def drop_fragments(text: Column, value: Column, typos: int = 0, token: str = T.REDACTION_TOKEN) -> Column:
    """The text with the value's fragments redacted as whole words.

    With ``typos``, words of eight letters or more within that many edits of a
    fragment go too; edits are counted in a band of that width only.
    """
    parts = X.fragments(value["text"], T.GATE_STOPWORDS)
    exact = F.aggregate(parts, text, lambda t, w: F.regexp_replace(t, F.concat(F.lit(r"(?iuU)(?<!\w)"), X.quoted(w), F.lit(r"(?!\w)")), F.lit(token)))
    if not typos:
        return exact
    pieces = F.regexp_extract_all(exact, F.lit(r"(?U)\w+|\W+"), 0)
    close = lambda w: F.exists(parts, lambda p: (F.length(p) >= 8) & (F.levenshtein(F.lower(w), p, typos) >= 0))
    return F.array_join(F.transform(pieces, lambda w: F.when((F.length(w) >= 8) & close(w), F.lit(token)).otherwise(w)), "")


def redact_fuzzy(text: Column, held: Column, typos: int = 0, token: str = T.REDACTION_TOKEN) -> Column:
    """``redact``, then for each value that can still be told its fragments; a text that tells it even then becomes the token."""

    def step(now: Column, value: Column) -> Column:
        told = lambda t: still_holds(t, value)
        again = lambda t: let(drop_fragments(t, value, typos, token), lambda less: F.when(told(less), F.lit(token)).otherwise(less))
        doubt = told(now) if not typos else told(now) | let(drop_fragments(now, value, typos, token), lambda less: less != now)
        return F.when(doubt, again(now)).otherwise(now)

    return F.aggregate(sensitive(held), redact(text, held, token), step)


def redact_json(json: Column, change: Callable[[Column], Column], keys: bool = False) -> Column:
    """A JSON payload with every string (and key) changed; text that is no JSON is changed as a whole."""
    return json_text.transform_strings(json, change, change if keys else None)


def redact_events(rows: DataFrame, change: Callable[[Column], Column], role: str = "role", texts: tuple[str, ...] = ("text", "thinking"), results: tuple[str, ...] = ("details", "error"), data: str | None = "data") -> DataFrame:
    """Event rows redacted by surface.

    Texts change unless a user wrote them, JSON payloads of results and of custom rows change
    at any depth, arguments of calls (all other columns) stay.  Columns that ``rows`` lacks are passed over.
    """
    kind, known = F.col(role), set(rows.columns)
    changed = {c: F.when(kind.isin("user", "custom"), F.col(c)).otherwise(change(F.col(c))) for c in texts if c in known}
    changed |= {c: F.when(kind == "toolResult", redact_json(F.col(c), change)).otherwise(F.col(c)) for c in results if c in known}
    if data in known:
        changed[data] = F.when(kind == "custom", redact_json(F.col(data), change)).otherwise(F.col(data))
    return rows.withColumns(changed)


def redact_files(files: DataFrame, change: Callable[[Column], Column], path: str = "path", content: str = "content") -> DataFrame:
    """File names and contents redacted; of names that become equal both stay."""
    return files.withColumns({path: change(F.col(path)), content: change(F.col(content))})


def fill_placeholders(text: Column, held: Column) -> Column:
    """Values by what they are: names, mails, phones, health, work and numbers get a word that stands for them.

    Mails and phone numbers that no persona holds go too.
    """

    def step(now: Column, e: Column) -> Column:
        out = now
        for label, (prefix, word, any_case) in reversed(T.PLACEHOLDERS.items()):
            pattern = F.concat(F.lit("(?iu)" if any_case else ""), X.quoted(e["text"]))
            done = F.regexp_replace(now, pattern, F.lit(word))
            if label == "ID_FULL_NAME":
                parts = F.filter(F.split(F.trim(e["text"]), r"\s+"), lambda p: (F.length(p) > 2) & p.rlike(r"^\p{Lu}"))
                done = F.aggregate(parts, done, lambda t, p: F.regexp_replace(t, F.concat(F.lit(r"(?iu)\b"), X.quoted(p), F.lit(r"\b")), F.lit(word)))
            out = F.when(e["label"].startswith(label) if prefix else e["label"] == label, done).otherwise(out)
        return out

    named = F.aggregate(held, F.coalesce(text, F.lit("")), step)
    return F.regexp_replace(F.regexp_replace(named, T.ANY_MAIL, "[email]"), T.ANY_PHONE, "[phone]")


def replace_health_files(calls: DataFrame, is_health: Column, generic: Column, content: str = "content") -> DataFrame:
    """Calls that would write health details get the caller's generic text instead; calls without content stay."""
    return calls.withColumn(content, F.when(F.col(content).isNotNull() & is_health, generic).otherwise(F.col(content)))
