"""Coding texts by the distinct pieces between which tokenisers surely cut.

A space before a character that is no white space always begins a pretoken, so
a text's tokens are those of its pieces put together.  A worker keeps the coded
pieces for its later tasks, up to a bound in bytes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_ODD = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
KEPT_BYTES = 64 << 20


def parts_of(text: str) -> list[str]:
    """The text cut at every space before a character that is no white space; joined by spaces, the parts are the text."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class Pieces:
    """Codes texts piece by piece with ``encode``, which maps strings to packed ids."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = KEPT_BYTES):
        self.encode, self.most, self.held = encode, most, 0
        self.known: dict[str, bytes] = {}

    def code(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        parts, known = [parts_of(x) for x in texts], self.known
        heads = self.encode([p.pop(0) for p in parts])
        new = list(set().union(*parts).difference(known))
        coded = self.encode([" " + x for x in new])
        known.update(zip(new, coded, strict=True))
        out = [head + b"".join([known[x] for x in p]) for head, p in zip(heads, parts, strict=True)]
        self.held += sum(map(len, new)) + sum(map(len, coded)) + 192 * len(new)
        if self.held > self.most:
            known.clear()
            self.held = 0
        return out
