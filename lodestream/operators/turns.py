"""Turns and events, one made from the other without loss: an assistant row takes the results of its calls with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def owners(rows: DataFrame, by: list[str], order: str, calls: str, ref: str, is_result: Column) -> DataFrame:
    """by, order, owner: for each result the last row before it that made its call; results without one give no row."""
    made = rows.select(*by, order, F.explode(calls).alias("_call"), F.col(order).alias("_owner")).filter("_call <> ''")
    asked = rows.filter(is_result).select(*by, order, F.col(ref).alias("_call"), F.lit(None).cast(rows.schema[order].dataType).alias("_owner")).filter("_call <> ''")
    w = Window.partitionBy(*by, "_call").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    both = made.withColumn("_made", F.lit(True)).unionByName(asked.withColumn("_made", F.lit(False)))
    return both.withColumn("owner", F.last("_owner", ignorenulls=True).over(w)).filter("NOT _made AND owner IS NOT NULL").select(*by, order, "owner")


def to_turns(rows: DataFrame, by: list[str], order: str, role: str = "role", calls: str = "calls", ref: str = "ref") -> DataFrame:
    """``rows`` without the results that have a call, each of which stands in ``results`` of the row that made it.

    ``calls`` is an array of call ids; ``order`` names a row of its stream.
    ``results`` is an array of structs of all columns, in their order; ``turn``
    numbers the assistant rows from 0 (null elsewhere).  Of rows that made the
    same call the last before the result takes it; results of no call stay
    rows.  Nothing is lost: ``to_events`` gives the rows back.
    """
    is_result = F.col(role) == "toolResult"
    found = owners(rows, by, order, calls, ref, is_result)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    given = rows.join(found, [*by, order]).groupBy(*by, F.col("owner").alias(order)).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), whole.alias("row")))).alias("_held"))
    left = rows.join(found.select(*by, order), [*by, order], "left_anti")
    n = F.sum((F.col(role) == "assistant").cast("long")).over(Window.partitionBy(*by).orderBy(order)) - 1
    turns = left.withColumn("turn", F.when(F.col(role) == "assistant", n)).join(given, [*by, order], "left")
    empty = F.array().cast(f"array<{rows.select(whole.alias('w')).schema['w'].dataType.simpleString()}>")
    return turns.withColumn("results", F.coalesce(F.transform("_held", lambda h: h["row"]), empty)).drop("_held").select(*rows.columns, "turn", "results")


def to_events(turns: DataFrame) -> DataFrame:
    """The rows that ``to_turns`` was given."""
    columns = [c for c in turns.columns if c not in ("turn", "results")]
    return turns.select(*columns).unionByName(turns.select(F.explode("results").alias("r")).select("r.*"))


def merge_chains(rows: DataFrame, by: list[str], order: str, role: str = "role", calls: str = "calls") -> DataFrame:
    """Chains of calling assistant rows and results become one assistant row with all calls, then the results.

    A chain starts at a calling assistant row and goes on over results and
    calling assistant rows; every other row ends it.  The first row's columns stay.
    """
    caller = (F.col(role) == "assistant") & (F.size(calls) > 0)
    w = Window.partitionBy(*by).orderBy(order)
    kind = F.when(caller, "call").when(F.col(role) == "toolResult", "result").otherwise("other")
    marked = rows.withColumn("_kind", kind).withColumn("_wall", F.sum((kind == "other").cast("long")).over(w))
    inside = Window.partitionBy(*by, "_wall").orderBy(order)
    marked = marked.withColumn("_nth", F.sum((F.col("_kind") == "call").cast("long")).over(inside))
    heads = marked.filter("_kind = 'call'").groupBy(*by, "_wall").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(calls).alias("c")))), lambda x: x["c"])).alias("_all"))
    kept = marked.filter("_kind <> 'call' OR _nth = 1").join(heads, [*by, "_wall"], "left")
    return kept.select(*[F.when(F.col("_kind") == "call", F.col("_all")).otherwise(F.col(c)).alias(c) if c == calls else F.col(c) for c in rows.columns])
