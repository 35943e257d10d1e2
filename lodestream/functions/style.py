"""How a persona writes: rates of typos, abbreviations and dropped capitals and apostrophes, and texts edited by them.

Every edit is decided by a coin of the seed and the word's place, so the same
seed gives the same text; rates are shares of the words that could be edited.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What careless and casual writers shorten (fixed values).
ABBREVIATIONS = {"because": "bc", "you": "u", "are": "r", "please": "pls", "right now": "rn", "thanks": "thx", "about": "abt", "people": "ppl", "message": "msg", "though": "tho"}
#: Rates by care (fixed values): typos, abbreviations, lower-case starts, apostrophes dropped.
RATES = {"careless": (0.12, 0.5, 0.8, 0.7), "casual": (0.04, 0.2, 0.4, 0.2), "careful": (0.0, 0.0, 0.15, 0.0)}
PROFILE = ("typos", "shorts", "lowers", "bare")


def care(conscientiousness: Column) -> Column:
    """Below 0.35 careless, below 0.55 casual, else careful; 0.5 where nothing is known."""
    c = F.coalesce(conscientiousness, F.lit(0.5))
    return F.when(c < 0.35, "careless").when(c < 0.55, "casual").otherwise("careful")


def rates(conscientiousness: Column, generation: Column | None = None) -> Column:
    """A struct of the four rates; the youngest generation never starts with a capital."""
    kind = care(conscientiousness)
    of = lambda i: F.create_map(*[F.lit(x) for name, r in RATES.items() for x in (name, r[i])])[kind]
    lowers = of(2) if generation is None else F.when(generation.eqNullSafe("Gen Z"), 1.0).otherwise(of(2))
    return F.struct(of(0).alias("typos"), of(1).alias("shorts"), lowers.alias("lowers"), of(3).alias("bare"))


def draw(seed: Column, place: Column, what: str) -> Column:
    """A number from 0 up to 1 for a place and a kind of edit."""
    digest = F.md5(F.concat_ws(":", seed.cast("string"), place.cast("string"), F.lit(what)).cast("binary"))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536


def traits(persona: Column) -> Column:
    """What is peculiar about how a persona writes, as names.

    ``persona``: openness, conscientiousness, extraversion, neuroticism, digital (0 to 1, null: unknown), generation, education, language.
    """
    level = lambda name, default: F.coalesce(persona[name], F.lit(default))
    named = (
        (F.lit(True), care(persona["conscientiousness"])),
        (level("openness", 0.5) > 0.7, "tangents"), (level("openness", 0.5) < 0.3, "to the point"),
        (level("extraversion", 0.5) > 0.7, "chatty"), (level("extraversion", 0.5) < 0.3, "terse"),
        (level("neuroticism", 0.3) > 0.65, "hedging"),
        (level("digital", 0.5) > 0.75, "chat-native"), (level("digital", 0.5) < 0.35, "writes like mail"),
        (persona["generation"] == "Gen Z", "young slang"), (persona["generation"] == "Baby Boomer", "formal"),
        (persona["education"].isin("doctorate", "masters"), "technical words"), (persona["education"] == "high_school", "simple words"),
        (F.coalesce(persona["language"], F.lit("English")) != "English", "second language"),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name) if isinstance(name, str) else name) for test, name in named]))


def styled(text: Column, seed: Column, rate: Column) -> Column:
    """The text as a persona of these rates would type it; words are what single spaces part, and keep their order.

    In turn for each word: a listed word is shortened, else apostrophes go, else in a
    word of five letters or more two neighbouring inner letters change places; then
    the first letter of the text may lose its capital.
    """
    short = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])

    def one(word: Column, i: Column) -> Column:
        letters = F.length(word)
        at = (F.floor(draw(seed, i, "where") * (letters - 3)) + 2).cast("int")
        swapped = F.concat(F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.lit(1)), F.substring(word, at, F.lit(1)), F.substring(word, at + 2, letters))
        brief = F.element_at(short, F.lower(word))
        return (
            F.when(brief.isNotNull() & (draw(seed, i, "short") < rate["shorts"]), brief)
            .when(word.contains("'") & (draw(seed, i, "bare") < rate["bare"]), F.replace(word, F.lit("'"), F.lit("")))
            .when(word.rlike(r"^\p{L}{5,}$") & (draw(seed, i, "typo") < rate["typos"]), swapped)
            .otherwise(word)
        )

    typed = F.array_join(F.transform(F.split(text, " "), one), " ")
    low = F.concat(F.lower(F.substring(typed, 1, 1)), F.substring(typed, F.lit(2), F.length(typed)))
    return F.when(draw(seed, F.lit(-1), "lower") < rate["lowers"], low).otherwise(typed)
