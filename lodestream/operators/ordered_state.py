"""Ordered-state operators over event streams: all are windows of one sequence, ordered by a unique key.

A sequence is spread over the cluster by its key; nothing is collected.  Row
frames are explicit, so equal order values never share a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def so_far(by: list[str], order: list[str]):
    """The rows of a sequence up to the current one."""
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def running_index(df: DataFrame, match: Column, by: list[str], order: list[str], name: str) -> DataFrame:
    """Numbers the rows that match from 0; other rows have the last number, -1 before the first."""
    return df.withColumn(name, (F.sum(match.cast("long")).over(so_far(by, order)) - 1))


def last_value_where(df: DataFrame, match: Column, value: Column, by: list[str], order: list[str], name: str) -> DataFrame:
    """The value of the latest row so far that matches, null before the first."""
    return df.withColumn(name, F.last(F.when(match, value), ignorenulls=True).over(so_far(by, order)))


def latch(df: DataFrame, sets: Column, resets: Column, by: list[str], order: list[str], name: str) -> DataFrame:
    """1 from a setting row on, 0 from a resetting row on and at the start."""
    change = F.when(sets, 1).when(resets, 0)
    return df.withColumn(name, F.coalesce(F.last(change, ignorenulls=True).over(so_far(by, order)), F.lit(0)).cast("long"))


def epoch_latch(df: DataFrame, starts: Column, sets: Column, by: list[str], order: list[str], name: str) -> DataFrame:
    """Whether a setting row came since the latest starting row (0 before any start)."""
    epochs = df.withColumn("_epoch", F.sum(starts.cast("long")).over(so_far(by, order)))
    state = F.max(sets.cast("long")).over(so_far([*by, "_epoch"], order))
    return epochs.withColumn(name, F.when(F.col("_epoch") > 0, state).otherwise(0).cast("long")).drop("_epoch")


def floored_counter(df: DataFrame, change: Column, by: list[str], order: list[str], name: str) -> DataFrame:
    """A counter that moves by ``change`` and never falls below 0 (running sum less its running minimum, if negative)."""
    total = df.withColumn("_total", F.sum(change).over(so_far(by, order)))
    low = F.least(F.min("_total").over(so_far(by, order)), F.lit(0))
    return total.withColumn(name, (F.col("_total") - low).cast("long")).drop("_total")


def repeats_previous(df: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """Rows whose value equals that of the row before."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_before", before).filter(F.col(value) == F.col("_before")).drop("_before")


def later_copies(df: DataFrame, key: list[str], order: list[str], name: str = "copy") -> DataFrame:
    """The second and later rows of a key, numbered from 2."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn(name, n.cast("long")).filter(F.col(name) > 1)


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def backwards_in_time(df: DataFrame, time: str, by: list[str], order: list[str]) -> DataFrame:
    """Rows that are earlier than the latest known time before them."""
    before = F.last(time, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_before", before).filter(F.col(time) < F.col("_before")).drop("_before")


def islands(df: DataFrame, value: str, by: list[str], order: list[str], name: str = "island") -> DataFrame:
    """Numbers the runs of equal neighbouring values from 0."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    starts = F.coalesce(~F.col("_before").eqNullSafe(F.col(value)), F.lit(True))
    marked = df.withColumn("_before", before).withColumn("_start", starts.cast("long"))
    return marked.withColumn(name, F.sum("_start").over(so_far(by, order)) - 1).drop("_before", "_start")


def join_in_order(texts: Column, order: Column, separator: str) -> Column:
    """An aggregate: the group's texts in order, joined."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), texts.alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), separator)


def neighbours(df: DataFrame, text: str, by: list[str], order: list[str], name: str, separator: str = "\n") -> DataFrame:
    """Each row's text with the texts before and after it."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.concat_ws(separator, F.lag(text).over(w), F.col(text), F.lead(text).over(w)))


def chunks(df: DataFrame, size: int, by: list[str], order: list[str], name: str = "chunk") -> DataFrame:
    """Numbers tumbling chunks of ``size`` rows from 0."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, F.floor((n - 1) / size).cast("long"))
