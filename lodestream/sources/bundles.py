"""Outputs of processed submissions: bundles in folders by submission, their catalog, and preference data in four forms.

A bundle is there once its metadata is: it is written last, so a run that broke
off leaves no bundle that the catalog would list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of a bundle in the order in which they are written.
TABLES = ("events", "workspace_before", "workspace", "sample", "metadata")


def write_bundles(path: str, tables: dict[str, DataFrame], by: str = "submission_id", order: str = "pos") -> None:
    """One folder per table and submission: JSON lines of events in their order, files, samples, then metadata.

    ``tables`` may lack all but metadata.  A submission is dealt to one task for
    its events alone, so that they stand in one file in order; folders
    of the submissions at hand are written anew, others stay.
    """
    if "metadata" not in tables or (odd := tables.keys() - set(TABLES)):
        raise ValueError(f"metadata and any of {TABLES} are wanted" + (f", not {sorted(odd)}" if "metadata" in tables else ""))
    for name in TABLES:
        if name in tables:
            rows = tables[name]
            rows = rows.repartition(by).sortWithinPartitions(by, order) if name == "events" else rows
            rows.write.partitionBy(by).option("ignoreNullFields", False).option("partitionOverwriteMode", "dynamic").mode("overwrite").json(f"{path}/{name}")


def read_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A table of all bundles, also of none."""
    return spark.read.schema(schema).json(f"{path}/{name}")


def catalog(metadata: DataFrame, pairs: DataFrame | None, by: str = "submission_id") -> DataFrame:
    """The processed submissions with their metadata and whether preference pairs exist for them, by name."""
    known = metadata.select(F.lit(None).cast(metadata.schema[by].dataType).alias(by)).limit(0) if pairs is None else pairs.select(by).distinct()
    return metadata.join(known.withColumn("has_pairs", F.lit(True)), by, "left").withColumn("has_pairs", F.coalesce("has_pairs", F.lit(False))).orderBy(by)


def lookup(table: DataFrame, submission: str, by: str = "submission_id") -> DataFrame:
    """The rows of one submission; only its folder is read."""
    return table.filter(F.col(by) == submission)


def step_text(thinking: Column, call: Column, answer: Column) -> Column:
    """A step as one text: what was thought, the call, the answer, as far as there are any."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws("\n\n", F.concat(F.lit("<thinking>\n"), some(thinking), F.lit("\n</thinking>")), F.concat(F.lit("<tool_call>\n"), some(call), F.lit("\n</tool_call>")), some(answer))


def dpo_records(pairs: DataFrame) -> DataFrame:
    """prompt, chosen, rejected, metadata: one row for each rejected step.

    ``pairs``: submission_id, turn, criticality, level, tier, context (array of role and content), chosen (struct of thinking,
    call, answer) and rejected (array of such structs with mode and reward).
    """
    said = F.transform("context", lambda m: F.concat(F.lit("["), F.coalesce(m["role"], F.lit("user")), F.lit("]: "), F.substring(F.coalesce(m["content"], F.lit("")), 1, 200)))
    rows = pairs.select("*", F.explode("rejected").alias("r"))
    text = lambda s: step_text(F.col(f"{s}.thinking"), F.col(f"{s}.call"), F.col(f"{s}.answer"))
    metadata = F.struct("submission_id", "turn", F.col("r.mode").alias("failure_mode"), F.col("r.reward").alias("reward_score"), F.col("criticality").alias("step_criticality"), F.col("level").alias("data_level"), F.col("tier").alias("tool_tier"))
    return rows.select(F.array_join(said, "\n").alias("prompt"), text("chosen").alias("chosen"), text("r").alias("rejected"), metadata.alias("metadata"))


def turn_records(pairs: DataFrame, by: str = "submission_id") -> DataFrame:
    """One row a turn: the worst rejected step, the mean reward and how many there are, over all its pairs."""
    rows = pairs.select(by, "turn", "chosen", F.posexplode("rejected").alias("place", "r"))
    worst = F.min_by("r", F.struct(F.col("r.reward"), F.col("place")))
    return rows.groupBy(by, "turn").agg(F.array_distinct(F.array_sort(F.collect_list("chosen.answer"))).alias("chosen"), worst.alias("worst"), F.round(F.avg("r.reward"), 6).alias("mean_reward"), F.count("*").alias("n_rejected"))


def preference_report(pairs: DataFrame, by: str = "submission_id") -> DataFrame:
    """One row a submission: pairs by failure mode and level, mean reward, shares of refusals and violations."""
    r = pairs.select(by, "level", F.explode("rejected").alias("r")).select(by, "level", "r.mode", "r.reward")
    tally = lambda what: r.groupBy(by, what).count().groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(what).cast("string").alias("k"), "count")))).alias(f"by_{what}"))
    refusals, harmless = F.count_if(F.col("mode") == "over_refusal"), F.count_if(F.col("mode").isin("over_refusal", "hallucination"))
    sums = r.groupBy(by).agg(F.count("*").alias("total"), F.round(F.avg("reward"), 6).alias("mean_reward"), F.round(refusals / F.count("*"), 6).alias("over_refusal_ratio"), F.round(1 - harmless / F.count("*"), 6).alias("violation_ratio"))
    return sums.join(tally("mode"), by).join(tally("level"), by)


def write_preferences(path: str, pairs: DataFrame) -> None:
    """Pairs with all alternatives, one line for each rejected step, turns, and the report, as JSON lines."""
    for name, made in (("pairs", pairs), ("dpo", dpo_records(pairs)), ("turns", turn_records(pairs)), ("report", preference_report(pairs))):
        made.write.option("ignoreNullFields", False).mode("errorifexists").json(f"{path}/{name}")
