"""Changes to all strings of a JSON text of any depth, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A string literal of JSON; possessive, so that long ones cost no stack.
LITERAL = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'


def quote(text: Column) -> Column:
    """The text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def unquote(literal: Column) -> Column:
    """The text of a JSON string literal."""
    plain = F.substring(literal, F.lit(2), F.length(literal) - 2)
    read = F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>")[0]
    return F.when(literal.contains("\\"), read).otherwise(plain)


def transform_strings(json: Column, value: Callable[[Column], Column], key: Callable[[Column], Column] | None = None) -> Column:
    """The JSON text with ``value`` applied to every string at any depth, and ``key`` to every key (null: keys stay).

    A JSON text is its string literals and what stands between them, so no tree
    is built and depth costs nothing; numbers, literals, white space and strings that the
    functions leave alone stay as they are written.  Text that is no JSON (or nests
    deeper than the parser goes) is changed as one string; null stays null.
    Keys that become equal all stay.
    """
    gaps, found = F.split(json, LITERAL, -1), F.regexp_extract_all(json, F.lit(LITERAL), 0)

    def put(old: Column, change: Callable[[Column], Column]) -> Column:
        return F.transform(F.array(unquote(old)), lambda t: F.transform(F.array(change(t)), lambda new: F.when(new.eqNullSafe(t), old).otherwise(quote(new)))[0])[0]

    def one(parts: Column) -> Column:
        def at(literal: Column, i: Column) -> Column:
            kept = literal if key is None else put(literal, key)
            return F.concat(parts[i], F.when(parts[i + 1].rlike(r"^\s*:"), kept).otherwise(put(literal, value)))

        return F.concat(F.array_join(F.transform(found, at), ""), F.element_at(parts, -1))

    return F.when(F.try_parse_json(json).isNotNull(), F.transform(F.array(gaps), one)[0]).otherwise(value(json))


def keys_of(json: Column) -> Column:
    """The keys of a JSON text at every depth, in their order; null if it is no JSON."""
    gaps, found = F.split(json, LITERAL, -1), F.regexp_extract_all(json, F.lit(LITERAL), 0)
    listed = F.transform(F.array(gaps), lambda parts: F.transform(F.filter(found, lambda x, i: parts[i + 1].rlike(r"^\s*:")), unquote))[0]
    return F.when(F.try_parse_json(json).isNotNull(), listed)


def string_at(value: Column, path: str) -> Column:
    """The string at a path of a variant; null if another kind stands there."""
    part = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(part) == "STRING", F.try_variant_get(value, path, "string"))
