"""Rows put between the rows of a stream without numbering it anew: order labels, parents and times.

A label is an array of longs, compared from the left.  Row n of a stream has
[2n].  What goes in before a label L = [.., x] gets [.., x - 1, 2j], what goes in
behind it L + [1, 2j], for j = 1, 2, ..  Each further round of inserts has numbers j of
its own, higher before and lower behind, so that it comes next to the anchor.  So
there is room before and behind every label, those of inserted rows too, and no other
label ever changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_labels(rows: DataFrame, order: str, name: str = "label") -> DataFrame:
    """``rows`` with their first labels; ``order`` numbers a stream's rows."""
    return rows.withColumn(name, F.array((F.col(order) * 2).cast("long")))


#: So many rows at most go in at one side of an anchor in one round.
ROUND = 1 << 31


def label_of(anchor: Column, side: int, place: Column, round_: int = 0) -> Column:
    """The label of the row that goes in as number ``place`` (from 1) before (side -1) or behind (1) an anchor's."""
    number = (place.cast("long") - side * round_ * ROUND) * 2
    if side > 0:
        return F.concat(anchor, F.array(F.lit(1).cast("long"), number))
    return F.concat(F.slice(anchor, F.lit(1), F.size(anchor) - 1), F.array(F.element_at(anchor, -1) - 1, number))


def insert_rows(rows: DataFrame, inserts: DataFrame, by: list[str], columns: list[str], round_: int = 0, id_col: str = "id", parent_col: str = "parent", time_col: str = "ms") -> DataFrame:
    """``rows`` with ``inserts`` between them: by, label, id, parent, time and ``columns``, in no order.

    ``inserts``: by, label (of the anchor row), side (-1 or 1), seq, id and the columns; an
    anchor that no row has is passed over.  All inserts at one side of an anchor form a chain in
    the order of seq: its first row hangs on the anchor (behind) or on what the anchor hung on
    (before), each other row on the one before it.  The last row of a chain becomes the parent of the rows
    that hung on the anchor (behind) or of the anchor (before).  Inserts take the anchor's time,
    so times that never go back still don't.  Ids must be unique in a stream.  Who inserts
    into one table several times gives each time a higher ``round_``.
    """
    keys = [*by, "label"]

    def chained(side: int, held: DataFrame, start: str) -> tuple[DataFrame, DataFrame]:
        w = Window.partitionBy(*keys).orderBy("seq", id_col)
        anchors = held.select(*keys, F.col(id_col).alias("_anchor"), F.col(start).alias("_start"), F.col(time_col).alias(time_col))
        chain = inserts.filter(F.col("side") == side).join(anchors, keys)
        chain = chain.withColumn("_place", F.row_number().over(w)).withColumn("_end", F.lead(id_col).over(w).isNull()).withColumn("_parent", F.coalesce(F.lag(id_col).over(w), "_start"))
        put = chain.select(*by, label_of(F.col("label"), side, F.col("_place"), round_).alias("label"), id_col, F.col("_parent").alias(parent_col), time_col, *columns)
        return put, chain.filter("_end").select(*keys, "_anchor", F.col(id_col).alias("_last"))

    behind, ends = chained(1, rows, id_col)
    moved = rows.join(ends.select(*by, F.col("_anchor").alias(parent_col), "_last"), [*by, parent_col], "left")
    moved = moved.select(*by, "label", id_col, F.coalesce("_last", parent_col).alias(parent_col), time_col, *columns)
    before, ends = chained(-1, moved, parent_col)
    moved = moved.join(ends.select(*keys, "_last"), keys, "left")
    moved = moved.select(*by, "label", id_col, F.coalesce("_last", parent_col).alias(parent_col), time_col, *columns)
    return moved.unionByName(behind).unionByName(before)


def consent_rows(calls: DataFrame, by: list[str], ask: Column, reply: Column, texts: tuple[str, str] = ("role", "text")) -> DataFrame:
    """For each call two inserts before it: the assistant asks, the user replies.  ``calls``: by, label, id."""
    role, text = texts
    said = F.array(F.struct(F.lit(1).alias("seq"), F.lit("assistant").alias(role), ask.alias(text)), F.struct(F.lit(2).alias("seq"), F.lit("user").alias(role), reply.alias(text)))
    rows = calls.select(*by, "label", F.lit(-1).alias("side"), F.col("id").alias("_of"), F.explode(said).alias("s"))
    return rows.select(*by, "label", "side", "s.seq", F.concat("_of", F.lit("-"), "s.seq").alias("id"), f"s.{role}", f"s.{text}")


def swap_calls(rows: DataFrame, swaps: DataFrame, by: list[str], call_id: str = "call_id", ref: str = "ref", tool: str = "tool", args: str = "args") -> DataFrame:
    """Calls get another tool and other arguments, and their results the tool's name.

    ``swaps``: by, call_id, new_tool, new_args; one row for a call.
    """
    new = swaps.select(*by, F.col(call_id).alias("_call"), "new_tool", "new_args")
    marked = rows.withColumn("_call", F.coalesce(F.nullif(F.col(call_id), F.lit("")), F.nullif(F.col(ref), F.lit(""))))
    joined = marked.join(new, [*by, "_call"], "left")
    own = F.col("new_tool").isNotNull() & (F.coalesce(F.col(call_id), F.lit("")) != "")
    return joined.select(*[F.coalesce("new_tool", tool).alias(c) if c == tool else F.when(own, F.col("new_args")).otherwise(F.col(args)).alias(c) if c == args else F.col(c) for c in rows.columns])
