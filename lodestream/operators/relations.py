"""Lookups, rankings, roll-ups and projections over sessions, calls, files and dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import terms as T
from lodestream.operators.ordered_state import join_in_order


def beside(dimension: DataFrame, rows: int = 100_000) -> DataFrame:
    """A dimension marked for broadcast if it is counted to be small; a larger one is joined by a shuffle."""
    return F.broadcast(dimension) if dimension.limit(rows + 1).count() <= rows else dimension


def lookup(rows: DataFrame, dimension: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Rows with the dimension's value of their key, or the default."""
    return rows.join(beside(dimension.select(key, value)), key, "left").withColumn(value, F.coalesce(value, default))


def last_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: later files and lines override earlier ones."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_n", n).filter("_n = 1").drop("_n")


def with_results(calls: DataFrame, results: DataFrame, by: list[str], call_id: str, made_up: Column) -> DataFrame:
    """Calls with the first result of their id; calls without one, or with an empty one, get what the caller makes up."""
    first = results.filter(F.col("ref").isNotNull()).groupBy(*by, F.col("ref").alias(call_id)).agg(F.min_by("text", "pos").alias("_content"))
    joined = calls.join(first, [*by, call_id], "left")
    usable = (F.length(F.trim("_content")) >= 10) & ~F.lower("_content").contains("unavailable")
    return joined.withColumn("content", F.when(usable, F.col("_content")).otherwise(made_up)).withColumn("synthetic", ~F.coalesce(usable, F.lit(False))).drop("_content")


def match_original(calls: DataFrame, originals: DataFrame, by: list[str]) -> DataFrame:
    """Calls with the original of their id, else the one at their turn's place with their name."""
    by_id = originals.select(*by, "call_id", F.col("arguments").alias("_by_id")).dropDuplicates([*by, "call_id"])
    by_place = originals.select(*by, "turn", "place", "tool", F.col("arguments").alias("_by_place")).dropDuplicates([*by, "turn", "place", "tool"])
    joined = calls.join(by_id, [*by, "call_id"], "left").join(by_place, [*by, "turn", "place", "tool"], "left")
    source = F.when(F.col("_by_id").isNotNull(), "id").when(F.col("_by_place").isNotNull(), "place").otherwise("none")
    return joined.withColumn("original", F.coalesce("_by_id", "_by_place")).withColumn("matched_by", source).drop("_by_id", "_by_place")


def id_or_name(calls: DataFrame, results: DataFrame, by: list[str]) -> DataFrame:
    """The result of a call by its id, else the first of its tool: two equality joins, not one with OR."""
    own = results.groupBy(*by, F.col("ref").alias("call_id")).agg(F.min_by("text", "pos").alias("_own"))
    named = results.groupBy(*by, "tool").agg(F.min_by("text", "pos").alias("_named"))
    joined = calls.join(own, [*by, "call_id"], "left").join(named, [*by, "tool"], "left")
    return joined.withColumn("response", F.coalesce("_own", "_named", F.lit(""))).drop("_own", "_named")


def persona_key(task_id: Column) -> Column:
    """The persona of a task by its id's number."""
    number = F.regexp_extract(task_id, r"^[TP]-(\d+)-", 1)
    return F.when(number != "", F.concat(F.lit("P-"), number))


def best_session(candidates: DataFrame, by: list[str]) -> DataFrame:
    """Of the members of an archive the session's log: final session files first, then others, then native logs; the largest, then by name."""
    session, native = F.col("name").contains("sessions/"), F.col("name").endswith(".trajectory.jsonl")
    rank = F.when(F.col("is_final") & session & ~native, 0).when(session & ~native, 1).when(F.col("is_final") & native, 2).otherwise(3)
    return candidates.withColumn("priority", rank).groupBy(*by).agg(F.min_by(F.struct("name", "priority"), F.struct("priority", -F.col("size"), "name")).alias("m")).select(*by, "m.name", "m.priority")


def rank_by_words(rule: Column, order: tuple[str, ...]) -> Column:
    """The place of a rule in a list of priorities; unlisted ones come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), rule), F.lit(0).cast("long")), F.lit(len(order) + 1).cast("long"))


def within_budget(files: DataFrame, by: list[str], order: list[Column], most_files: int, most_chars: int, size: Column) -> DataFrame:
    """The first files in order, as many as a count and a running size allow."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.row_number().over(w)
    total = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return files.withColumn("_n", n).withColumn("_total", total).filter((F.col("_n") <= most_files) & (F.col("_total") <= most_chars)).drop("_n", "_total")


def workspace_subset(files: DataFrame, by: list[str], most: int = 25, most_chars: int = 50_000) -> DataFrame:
    """The first ``most`` files by name without hidden folders and texts that hold a zero byte, each cut."""
    kept = files.filter(~F.col("path").rlike(r"(^|/)\.git/") & ~F.col("content").contains("\x00"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy("path"))
    return kept.withColumn("_n", n).filter(F.col("_n") <= most).select(*by, "path", F.substring("content", 1, most_chars).alias("content"))


def delivered(files: DataFrame, by: list[str], core: tuple[str, ...], most: int = 25) -> DataFrame:
    """All files of a small workspace; of a larger one the core files, then notes, up to ``most``."""
    name = F.element_at(F.split("path", "/"), -1)
    rank = F.when(name.isin(*core), 0).when((name == "SKILL.md") | ((~F.col("path").contains("/")) & F.col("path").endswith(".md")), 1).otherwise(2)
    w = Window.partitionBy(*by)
    rows = files.withColumn("_all", F.count("*").over(w)).withColumn("_rank", rank).withColumn("_n", F.row_number().over(w.orderBy("_rank", "path")))
    return rows.filter((F.col("_all") <= most) | ((F.col("_rank") < 2) & (F.col("_n") <= most))).drop("_all", "_rank", "_n")


def workspace_after(writes: DataFrame, by: list[str], order: str) -> DataFrame:
    """Files after a session's writes: the last content of a path wins; memory files grow by what is appended, in order."""
    memory = F.lower("path").endswith("memory.md")
    return writes.groupBy(*by, "path").agg(F.when(F.bool_or(memory), join_in_order(F.col("content"), F.col(order), "\n")).otherwise(F.max_by("content", order)).alias("content"), F.count("*").alias("n_writes"))


def masked_entities(entities: Column, token: str = T.REDACTION_TOKEN) -> Column:
    """Entities for display: the text of those of level 3 or more is the token."""
    return F.transform(entities, lambda e: F.struct(F.when(e["level"] >= 3, F.lit(token)).otherwise(e["text"]).alias("text"), e["label"].alias("label"), e["level"].alias("level")))


def flat_vault(personas: DataFrame, key: str, vault: str, shortest: int = 3) -> DataFrame:
    """The values of a nested vault (JSON of category, field and value) as rows, labels from category and field."""
    nested = "map<string,map<string,string>>"
    rows = personas.select(key, F.explode(F.from_json(vault, nested)).alias("category", "fields")).select(key, "category", F.explode("fields").alias("field", "text"))
    return rows.filter(F.length(F.trim("text")) >= shortest).select(key, F.upper(F.concat_ws("_", "category", "field")).alias("label"), "text")


def overall(*scores: str) -> Column:
    """The mean of the rubric's scores."""
    return reduce(lambda a, b: a + b, [F.col(s) for s in scores]) / float(len(scores))


def missing_tools(original: DataFrame, rewritten: DataFrame, by: list[str]) -> DataFrame:
    """Tools of a stream that the rewritten one lost."""
    a = original.groupBy(*by).agg(F.collect_set("tool").alias("_a"))
    b = rewritten.groupBy(*by).agg(F.collect_set("tool").alias("_b"))
    lost = F.array_sort(F.array_except("_a", F.coalesce("_b", F.array().cast("array<string>"))))
    return a.join(b, by, "left").select(*by, F.array_join(lost, ",").alias("missing")).filter("missing <> ''")


def action_sets(turns: DataFrame, by: list[str], scenario: Column) -> DataFrame:
    """By stream: scenarios, tools and the number of decision points."""
    point = F.col("action").isin("consent_gate", "hard_deny", "local_first", "adversarial_refusal")
    return turns.withColumn("_s", scenario).groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_set("_s")), ",").alias("scenarios"), F.array_join(F.array_sort(F.collect_set("tool")), ",").alias("tools"), F.count_if(point).alias("n_points")
    )


def once_each(found: DataFrame, by: list[str], kind: str, order: str) -> DataFrame:
    """The first violation of each kind of a stream, and the last one of a turn where a kind repeats in it."""
    n = F.row_number().over(Window.partitionBy(*by, kind).orderBy(order))
    return found.withColumn("_n", n).filter("_n = 1").drop("_n")


def minimise(text: Column, held: Column) -> Column:
    """A write's text without its persona: values of level 3 or more become [REDACTED], names "the user", addresses go, noise lines too."""
    from lodestream.functions.text import drop_noise_lines, squeeze

    def one(t: Column, e: Column) -> Column:
        name = F.when(e["label"] == "ID_FULL_NAME", F.lit("the user")).when(e["label"].isin("ID_EMAIL", "ID_PHONE"), F.lit("")).otherwise(F.lit("[REDACTED]"))
        return F.when(e["level"] >= 2, F.replace(t, e["text"], name)).otherwise(t)

    bare = F.regexp_replace(F.aggregate(held, text, one), r"[\w.+-]+@[\w-]+\.[\w.-]+", "")
    return squeeze(F.regexp_replace(drop_noise_lines(F.regexp_replace(bare, r"\b[0-9A-Za-z_-]{25,}\b", "[REDACTED_ID]")), r"\bthe user(\s+the user)+\b", "the user"))


def conversation_chunks(rows: DataFrame, by: list[str], order: str, size: int = 6, least_rows: int = 2, least_chars: int = 50, cut: int = 300, most: int = 2000) -> DataFrame:
    """Tumbling chunks of messages as passages: each message cut, small chunks left out, with the tools and whether privacy words occur."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    said = F.concat(F.col("role"), F.lit(": "), F.substring("text", 1, cut))
    chunks = rows.withColumn("chunk", F.floor((n - 1) / size).cast("long")).withColumn("_said", said).groupBy(*by, "chunk").agg(
        F.count("*").alias("n"), F.substring(join_in_order(F.col("_said"), F.col(order), "\n"), 1, most).alias("passage"), F.array_join(F.array_sort(F.collect_set("tool")), ",").alias("tools")
    )
    return chunks.filter((F.col("n") >= least_rows) & (F.length("passage") >= least_chars))


def drop_like_turns(turns: DataFrame, by: list[str], order: str, text: str, exempt: Column, has_call: Column, most: int = 300) -> DataFrame:
    """Of turns whose texts begin alike (``most`` characters, in any case and white space) the first stays.

    Exempt turns (refusals, consent gates) always stay and make no other go;
    turns without text stay if they call something.
    """
    begun = F.lower(F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""), 1, most))
    rows = turns.withColumns({"_exempt": exempt, "_call": has_call, "_begun": F.regexp_replace(begun, r"\s+", " ")})
    n = F.row_number().over(Window.partitionBy(*by, "_exempt", "_begun").orderBy(order))
    kept = F.col("_exempt") | F.when(F.col("_begun") == "", F.col("_call")).otherwise(F.col("_n") == 1)
    return rows.withColumn("_n", n).filter(kept).drop("_exempt", "_call", "_begun", "_n")


def with_levels(entities: DataFrame, labels: DataFrame, default: str = "L2") -> DataFrame:
    """Entities with the level of their label; labels that are not listed have the default's.  ``labels``: label, level."""
    listed = labels.groupBy("label").agg(F.max("level").alias("_level"))
    return entities.join(listed, "label", "left").withColumn("level", F.coalesce("_level", F.lit(default))).drop("_level")
