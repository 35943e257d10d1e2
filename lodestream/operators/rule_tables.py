"""Ordered rule tables over texts: one pass of a phrase automaton over each text for all rules, the first rule that holds wins.

A rule asks for phrases in one or more text columns, and for flags that the rows
carry.  The phrases of all rules make one Aho-Corasick automaton a column,
built once in a worker; a text is read once, however many rules and phrases there
are.  What the phrases say comes back as one bit a rule; flags that windows work
out (counters, what came before) are put to it as columns afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Says:
    """A text column, in any case, holds one of the phrases (``no``: none of them)."""

    column: str
    phrases: tuple[str, ...]
    no: bool = False


@dataclass(frozen=True)
class Rule:
    """Holds if all of ``says`` and ``flags`` (names of boolean columns) hold.  Rules of one name are alternatives."""

    name: str
    says: tuple[Says, ...] = ()
    flags: tuple[str, ...] = ()


def says(column: str, *phrases: str) -> Says:
    return Says(column, tuple(phrases))


def lacks(column: str, *phrases: str) -> Says:
    return Says(column, tuple(phrases), True)


def text_columns(rules: Iterable[Rule]) -> list[str]:
    return sorted({s.column for r in rules for s in r.says})


@lru_cache(maxsize=16)
def _compiled(rules: tuple[Rule, ...]):
    """By column an automaton whose hits are bits of phrases, and the rules as masks over them."""
    import ahocorasick

    numbers: dict[tuple[str, str], int] = {}
    for rule in rules:
        for s in rule.says:
            for phrase in s.phrases:
                numbers.setdefault((s.column, phrase.lower()), len(numbers))
    automata = {}
    for (column, phrase), i in numbers.items():
        automata.setdefault(column, ahocorasick.Automaton()).add_word(phrase, 1 << i)
    for a in automata.values():
        a.make_automaton()
    mask = lambda s: reduce(int.__or__, (1 << numbers[s.column, p.lower()] for p in s.phrases))
    return automata, [[(mask(s), s.no) for s in rule.says] for rule in rules]


def held_rules(rules: tuple[Rule, ...]) -> Column:
    """An array of booleans, one a rule: whether its phrases hold (its flags are not looked at).  Null texts are empty."""
    columns = text_columns(rules)

    def look(*texts: pd.Series) -> pd.Series:
        automata, masks = _compiled(rules)
        seen: dict[tuple[str, ...], list[bool]] = {}

        def one(row: tuple[str, ...]) -> list[bool]:
            if row not in seen:
                hits = 0
                for column, text in zip(columns, row, strict=True):
                    for _, bit in automata[column].iter((text or "").lower()):
                        hits |= bit
                seen[row] = [all((hits & m == 0) == no for m, no in clauses) for clauses in masks]
            return seen[row]

        return pd.Series([one(row) for row in zip(*texts, strict=True)])

    return F.pandas_udf(look, "array<boolean>")(*[F.col(c) for c in columns])


def first_rule(rules: tuple[Rule, ...], held: str, names: Iterable[str] | None = None) -> Column:
    """The name of the first rule that holds, flags and all; null if none does.

    ``held`` names a column of ``held_rules``; ``names`` restricts the rules.
    """
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, rule in enumerate(rules):
        if names is None or rule.name in names:
            flags = [F.coalesce(~F.col(f[1:]) if f[0] == "!" else F.col(f), F.lit(False)) for f in rule.flags]
            chain = chain.when(reduce(lambda a, b: a & b, flags, F.col(held)[i]), F.lit(rule.name))
    return chain


def holds(rules: tuple[Rule, ...], held: str, name: str) -> Column:
    """Whether a rule of that name holds."""
    return first_rule(rules, held, (name,)).isNotNull()


def rule_sql(rules: tuple[Rule, ...], names: Iterable[str] | None = None, flag_sql: dict[str, str] | None = None) -> str:
    """The same table as a CASE of SQL, for comparison."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    any_of = lambda s: "(" + " OR ".join(f"contains(lower(coalesce({s.column}, '')), {quoted(p.lower())})" for p in s.phrases) + ")"
    flags = flag_sql or {}
    flag = lambda f: f"coalesce({'NOT ' if f[0] == '!' else ''}{flags.get(f.lstrip('!'), f.lstrip('!'))}, false)"
    cases = [
        f"WHEN {' AND '.join([*[('NOT ' if s.no else '') + any_of(s) for s in r.says], *map(flag, r.flags)]) or 'true'} THEN {quoted(r.name)}"
        for r in rules
        if names is None or r.name in names
    ]
    return f"(CASE {' '.join(cases)} END)"
