"""A latch over a stream of events, with its state kept between micro-batches.

Each micro-batch is a DataFrame: windows sort a key's rows on disk where they are
many, so a hot key needs no more memory than others, and the state is a table
of one row a key.  A batch writes its rows and the new state under its own
number, over whatever an earlier try of that batch left, so a batch that is
run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latch_batch(rows: DataFrame, state: DataFrame, key: str, order: list[str], sets: str, resets: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``pending`` and ``late``, and the state after them.

    ``pending`` is 1 from a row of kind ``sets`` on, 0 from one of kind
    ``resets`` on, 0 before any.  ``state`` has the key, ``at`` (a struct of the
    order columns of the key's last row) and ``held``.  A row that comes before ``at`` is late: its
    pending is null and it changes nothing.  Null keys are a key of their own.
    """
    place = F.struct(*[F.col(c) for c in order])
    prior = state.select(F.col(key).alias("_key"), F.col("at").alias("_at"), F.col("held").alias("_held"))
    joined = rows.join(prior, F.col(key).eqNullSafe(F.col("_key")), "left")
    joined = joined.withColumn("late", F.coalesce(place <= F.col("_at"), F.lit(False)))
    change = F.when(~F.col("late"), F.when(F.col(kind) == sets, 1).when(F.col(kind) == resets, 0))
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.coalesce(F.last(change, ignorenulls=True).over(w), "_held", F.lit(0)).cast("long")
    marked = joined.withColumn("pending", F.when(~F.col("late"), held))
    ends = marked.filter("NOT late").groupBy(key).agg(F.max_by("pending", place).alias("held"), F.max(place).alias("at")).select(key, "at", "held")
    rest = state.join(ends.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti").select(key, "at", "held")
    return marked.select(*rows.columns, "pending", "late"), ends.unionByName(rest)


def latch_into(path: str, key: str, order: list[str], sets: str, resets: str, out_id: str, kind: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that writes ``out_id``, pending and late under ``path``."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fields = ", ".join(f"{c}: {batch.schema[c].dataType.simpleString()}" for c in order)
        schema = f"{key} {batch.schema[key].dataType.simpleString()}, at struct<{fields}>, held long"
        before = spark.read.schema(schema).parquet(f"{path}/state/{number - 1}") if number else spark.createDataFrame([], schema)
        rows, state = latch_batch(batch, before, key, order, sets, resets, kind)
        rows.select(out_id, "pending", "late").write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        state.write.mode("overwrite").parquet(f"{path}/state/{number}")

    return run


def run_once(stream: DataFrame, path: str, step: Callable[[DataFrame, int], None], out_schema: str) -> DataFrame:
    """Runs a stream over all that is available, batch by batch, and reads what ``step`` wrote to ``path``/rows."""
    running = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    running.awaitTermination()
    return stream.sparkSession.read.schema(out_schema).option("recursiveFileLookup", True).parquet(f"{path}/rows")
