"""Whether a call could have used a tool of a lower tier: capabilities, fields that later texts consume, scope guards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import text as X

#: Scope guards by capability: functions of (arguments, alternative's skill) that give the reason against it, or null.
GUARDS: dict[str, list[Callable[[Column, Column], Column]]] = {}


def guard(capability: str):
    """Register a scope guard for a capability; users add their own in the same way."""

    def add(check: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        GUARDS.setdefault(capability, []).append(check)
        return check

    return add


@guard("notes.write")
def _nested_pages(arguments: Column, skill: Column) -> Column:
    """Flat notes can take neither a parent page nor typed properties."""
    flat = skill == "obsidian"
    return F.when(flat & (F.coalesce(arguments["parent"], F.lit("")) != ""), "parent").when(flat & (F.coalesce(arguments["properties"], F.lit("")) != ""), "properties")


@guard("mail.send")
def _outside_recipients(arguments: Column, skill: Column, domain: str = "@corp.com") -> Column:
    """The company's mail takes only the company's recipients."""
    outside = F.exists(F.split(F.coalesce(arguments["to"], F.lit("")), ","), lambda r: r.contains("@") & ~F.trim(r).endswith(domain))
    return F.when((skill == "enterprise-mail") & outside, "external recipient")


def result_fields(result: Column) -> Column:
    """Fields of a JSON result with their plain values (of a list all its plain items) that mean something when they occur again.

    An array of structs field, value; null if the result is no object.
    """
    parsed = F.try_parse_json(result)

    def plain(value: Column) -> Column:
        """The value as text; null for booleans, 0 and 1 (which say as little), lists and objects."""
        text, kind = F.try_variant_get(value, "$", "string"), F.schema_of_variant(value)
        number = F.try_variant_get(value, "$", "double")
        return F.when(kind == "STRING", text).when(~kind.rlike("^(ARRAY|OBJECT|BOOLEAN$|VOID$)") & ~number.isin(0.0, 1.0), text)

    def of(entry: Column) -> Column:
        items = F.when(F.schema_of_variant(entry["value"]).startswith("ARRAY"), F.try_variant_get(entry["value"], "$", "array<variant>")).otherwise(F.array(entry["value"]))
        said = F.filter(F.array_compact(F.transform(items, plain)), X.is_real_value)
        return F.transform(F.array_distinct(said), lambda v: F.struct(entry["key"].alias("field"), v.alias("value")))

    fields = F.flatten(F.transform(F.map_entries(F.try_variant_get(parsed, "$", "map<string,variant>")), of))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), fields)


TOKEN = r"[A-Za-z0-9_]+"


def _pairs(tokens: Column) -> Column:
    """Each token with the one behind it."""
    return F.array_compact(F.zip_with(tokens, F.slice(tokens, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b)))


def last_mentions(values: DataFrame, texts: DataFrame, by: list[str], order: str) -> DataFrame:
    """by, value, last: where each value last stands in its stream's texts, bounded by other than word characters.

    ``values``: by, value, distinct; ``texts``: by, order, text.  An inverted
    index of the texts' tokens and pairs of neighbouring tokens is joined with one key of each value: its token, or of several
    the longest pair of neighbours, which stand side by side in every text that holds the value.  Where a token is the whole value, the index tells; otherwise the texts that hold
    the key are looked at.  Values without a token meet all texts of their stream.
    Sizes before an explode don't tell those behind it, so no side may be broadcast by them; outer ones work their array out once.
    """
    tokens = lambda c: F.regexp_extract_all(c, F.lit(TOKEN), 0)
    longest = lambda keys: F.array_max(F.transform(keys, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    split = values.withColumn("_tokens", tokens("value"))
    keyed = split.select(*by, "value", F.coalesce(longest(_pairs(F.col("_tokens"))), longest(F.col("_tokens")), F.lit("")).alias("_key"))
    words = texts.select(*by, order, tokens("text").alias("_tokens"))
    index = words.select(*by, order, F.explode_outer(F.array_distinct(F.concat("_tokens", _pairs(F.col("_tokens")), F.array(F.lit(""))))).alias("_key"))
    met = keyed.hint("merge").join(index, [*by, "_key"])
    whole = (F.col("_key") == F.col("value")) & ~F.col("value").contains(" ") & (F.col("value") != "")
    sure = met.filter(whole).groupBy(*by, "value").agg(F.max(order).alias("last"))
    looked = met.filter(~whole).select(*by, order, "value").hint("merge").join(texts.select(*by, order, "text"), [*by, order]).filter(X.word_bounded(F.col("text"), F.col("value")))
    return sure.unionByName(looked.groupBy(*by, "value").agg(F.max(order).alias("last")))


def consumed_fields(results: DataFrame, texts: DataFrame, by: list[str], order: str, checkpoint: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """by, order, consumed: of each JSON object in ``results`` the fields that any later text of the stream takes up, sorted.

    Both have by, order and text; ``order`` names a row of a stream.  All later texts count, however far
    behind; no text is carried to a row.  Results that are no objects give no row.
    With ``checkpoint`` the results are parsed once and not for each use of their fields.
    """
    nothing = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"))
    fields = results.select(*by, order, F.array_append(result_fields(F.col("text")), nothing).alias("_fields"))
    fields = checkpoint(fields) if checkpoint else fields
    # An outer explode: an inner one would work out the fields once more, to leave out rows without any.
    each = fields.select(*by, order, F.explode_outer("_fields").alias("f")).filter("f IS NOT NULL").select(*by, order, "f.field", "f.value")
    last = last_mentions(each.filter("value IS NOT NULL").select(*by, "value").distinct(), texts, by, order)
    told = each.hint("merge").join(last, [*by, "value"], "left")
    return told.groupBy(*by, order).agg(F.array_sort(F.collect_set(F.when(F.col("last") > F.col(order), F.col("field")))).alias("consumed"))


def alternatives(calls: DataFrame, catalog: DataFrame, key: list[str]) -> DataFrame:
    """For each call the tools of its capability in a lower tier, with a verdict, the lowest tier first.

    ``calls``: key, tool, tier, consumed (array or null), arguments (map).  ``catalog``: capability, skill, tool, tier, fields.
    A drop-in covers the consumed fields (all fields of the original where none are known) and passes the guards.
    """
    catalog = F.broadcast(catalog) if catalog.limit(10_001).count() <= 10_000 else catalog
    mine = catalog.select(F.col("tool").alias("tool"), F.col("capability"), F.col("tier").alias("own_tier"), F.col("fields").alias("own_fields"))
    hit = calls.join(mine, "tool").withColumn("_pick", F.row_number().over(Window.partitionBy(*key).orderBy((F.col("own_tier") != F.col("tier")).cast("int"), "capability"))).filter("_pick = 1")
    other = catalog.select("capability", F.col("skill").alias("alt_skill"), F.col("tool").alias("alt_tool"), F.col("tier").alias("alt_tier"), F.col("fields").alias("alt_fields"))
    both = hit.join(other, "capability").filter("alt_tier < own_tier")
    missing = F.array_sort(F.array_except(F.coalesce("consumed", "own_fields"), "alt_fields"))
    reason = F.lit(None).cast("string")
    for capability, checks in GUARDS.items():
        for check in checks:
            reason = F.coalesce(reason, F.when(F.col("capability") == capability, check(F.col("arguments"), F.col("alt_skill"))))
    verdict = F.when(F.size(missing) > 0, "breaks-downstream").when(reason.isNotNull(), "out-of-scope").otherwise("drop-in")
    n = F.row_number().over(Window.partitionBy(*key).orderBy("alt_tier", "alt_tool"))
    return both.select(*key, "capability", "alt_tool", "alt_tier", verdict.alias("verdict"), F.array_join(missing, ",").alias("missing"), n.cast("long").alias("place"))


def drop_ins(found: DataFrame, key: list[str]) -> DataFrame:
    """The first drop-in of each call."""
    return found.filter("verdict = 'drop-in'").groupBy(*key).agg(F.min_by(F.struct("alt_tool", "alt_tier", "capability"), "place").alias("d")).select(*key, "d.*")


def reverse_index(catalog: DataFrame) -> DataFrame:
    """Capabilities by skill."""
    return catalog.groupBy("skill").agg(F.array_join(F.array_sort(F.collect_set("capability")), ",").alias("capabilities"))
