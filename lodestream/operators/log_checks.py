"""Structural checks on raw JSON lines of event logs, in two sets: what makes a stream unusable, and what a delivered file must not show.

A line is parsed once into columns; what an earlier line must have said (ids,
calls) comes from joins, what the line before said from windows.  Lines that are
no objects are issues themselves, so nothing is lost in parsing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import json_text
from lodestream.functions import terms as T
from lodestream.functions import values as V
from lodestream.operators import structure
from lodestream.operators.event_streams import seen_before

ROLES = ("user", "assistant", "toolResult")


def parsed_lines(lines: DataFrame, by: list[str], order: str, line: str = "line") -> DataFrame:
    """by, order and what the checks ask of a line, as columns."""
    v = F.col("_v")
    kind = F.schema_of_variant(v)
    content = F.col("content")
    typed = lambda c, *types: json_text.string_at(c, "$.type").isin(*types)
    shown = lambda c, *fields: F.coalesce(*[F.trim(F.try_variant_get(c, f"$.{f}", "string")) != "" for f in fields], F.lit(False))
    some = lambda test: F.coalesce(F.exists(content, lambda c: F.coalesce(test(c), F.lit(False))), F.lit(False))
    stamp = F.coalesce(F.try_variant_get(v, "$.timestamp", "string"), F.try_variant_get(v, "$.createdAt", "string"))
    rows = lines.select(*by, order, F.col(line).alias("_line"), F.try_parse_json(line).alias("_v"))
    rows = rows.withColumns(
        {
            "is_object": F.coalesce(kind.startswith("OBJECT"), F.lit(False)),
            "id": json_text.string_at(v, "$.id"),
            "parent": F.nullif(json_text.string_at(v, "$.parentId"), F.lit("")),
            "type": json_text.string_at(v, "$.type"),
            "approval": F.coalesce(json_text.string_at(v, "$.customType").startswith("exec.approval."), F.lit(False)),
            "message_is_object": F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.message", "variant")).startswith("OBJECT"), F.lit(False)),
            "role": json_text.string_at(v, "$.message.role"),
            "ref": F.coalesce(json_text.string_at(v, "$.message.toolCallId"), F.lit("")),
            "content": F.try_variant_get(v, "$.message.content", "array<variant>"),
            "ms": F.when(stamp.isNotNull(), F.nullif(V.epoch_ms(stamp), F.lit(0))),
        }
    )
    return rows.select(
        *by, order, "is_object", "id", "parent", "type", "approval", "message_is_object", "role", "ref", "ms",
        F.coalesce(F.transform(F.filter(content, lambda c: F.coalesce(typed(c, "toolCall"), F.lit(False))), lambda c: F.coalesce(json_text.string_at(c, "$.id"), F.lit(""))), F.array().cast("array<string>")).alias("calls"),
        some(lambda c: (json_text.string_at(c, "$.type") == "text") & shown(c, "text")).alias("has_text"),
        some(lambda c: typed(c, "text", "image") & (shown(c, "text") | shown(c, "url"))).alias("has_media"),
        F.coalesce(F.exists(json_text.keys_of(F.col("_line")), lambda k: k.isin(*T.CONSTRUCTION_KEYS)), F.lit(False)).alias("construction_key"),
    )


def _marked(rows: DataFrame, by: list[str], order: str, recorded: Column, message: Column) -> DataFrame:
    """Adds what stood before each line: ids, parents, calls, the message before."""
    rows = rows.withColumn("_recorded", F.when(recorded, F.nullif(F.col("id"), F.lit("")))).withColumn("_message", message)
    rows = seen_before(rows, by, order, "id", F.col("_recorded"), "id_seen")
    rows = seen_before(rows, by, order, "parent", F.col("_recorded"), "parent_seen")
    before = F.last("_message", ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before)
    made = rows.filter(F.col("role") == "assistant").select(*by, order, F.posexplode("calls").alias("slot", "call"))
    n = F.row_number().over(Window.partitionBy(*by, "call").orderBy(order, "slot"))
    made = made.withColumn("_again", (F.col("call") != "") & (n > 1))
    again = made.groupBy(*by, order).agg(F.bool_or("_again").alias("call_again"), F.bool_or(F.col("call") == "").alias("call_missing"), F.bool_or(F.lower("call").contains("synth")).alias("call_synth"))
    first = made.filter("call <> ''").groupBy(*by, F.col("call").alias("ref")).agg(F.min(order).alias("_made"))
    rows = rows.join(again, [*by, order], "left").join(first, [*by, "ref"], "left")
    return rows.withColumn("known_call", F.coalesce(F.col("_made") < F.col(order), F.lit(False))).na.fill(False, ["call_again", "call_missing", "call_synth"])


def stream_codes(lines: DataFrame, by: list[str], order: str, line: str = "line", checkpoint: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """by, order, code: the twelve structural codes of an event stream's lines.

    A line that is no object, or whose message is none, has that code only
    (and those of its id and parent), and its id counts for no later line.
    With ``checkpoint`` lines are parsed once and not for each join of what stood before.
    """
    rows = parsed_lines(lines, by, order, line)
    rows = checkpoint(rows) if checkpoint else rows
    whole = F.col("is_object") & (F.col("message_is_object") | ~F.col("type").eqNullSafe("message"))
    role = F.when(whole & (F.col("type") == "message") & F.col("role").isin(*ROLES), F.col("role"))
    message = F.when((F.col("type") == "custom") & F.col("approval"), F.lit("approval")).otherwise(role)
    rows = _marked(rows.withColumn("_role", role).withColumn("_whole", whole), by, order, whole, message)
    blank = F.coalesce(F.col("id"), F.lit("")) == ""
    assistant, result = F.coalesce(F.col("_role") == "assistant", F.lit(False)), F.coalesce(F.col("_role") == "toolResult", F.lit(False))
    rules = {
        "non_object_event": ~F.col("is_object"),
        "missing_event_id": F.col("is_object") & blank,
        "duplicate_event_id": F.col("is_object") & ~blank & F.col("id_seen"),
        "parent_not_seen": F.col("is_object") & F.col("parent").isNotNull() & ~F.col("parent_seen") & ~F.col("type").eqNullSafe("model_change"),
        "message_not_object": F.col("is_object") & ~F.col("_whole"),
        "invalid_message_role": F.col("_whole") & F.col("type").eqNullSafe("message") & F.col("_role").isNull(),
        "consecutive_assistant_messages": assistant & F.col("before").eqNullSafe("assistant"),
        "tool_call_missing_id": assistant & F.col("call_missing"),
        "duplicate_tool_call_id": assistant & F.col("call_again"),
        "empty_assistant_message": assistant & ~F.col("has_text") & (F.size("calls") == 0),
        "tool_result_missing_tool_call_id": result & (F.col("ref") == ""),
        "orphan_tool_result": result & (F.col("ref") != "") & ~F.col("known_call"),
    }
    return structure.issues(rows, [*by, order], rules)


def delivery_codes(lines: DataFrame, by: list[str], order: str, line: str = "line", checkpoint: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """by, order, code: the fifteen kinds that a delivered log must not show; that of equal milliseconds stands at its last line.

    A line without a time is passed over by the checks of times.  ``checkpoint`` as in ``stream_codes``.
    """
    rows = parsed_lines(lines, by, order, line)
    rows = checkpoint(rows) if checkpoint else rows
    role = F.when(F.col("is_object") & F.col("role").isin(*ROLES), F.col("role"))
    rows = _marked(rows.withColumn("_role", role), by, order, F.col("is_object"), role)
    whole, so_far = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.last("ms", ignorenulls=True).over(so_far)
    part = F.pmod(F.col("ms"), F.lit(1000))
    constant = (F.count("ms").over(whole) >= 4) & (F.min(part).over(whole) == F.max(part).over(whole)) & (F.col(order) == F.max(order).over(whole))
    first_blank = F.row_number().over(Window.partitionBy(*by, F.col("id")).orderBy(order)) > 1
    assistant, result = F.coalesce(F.col("_role") == "assistant", F.lit(False)), F.coalesce(F.col("_role") == "toolResult", F.lit(False))
    told = F.col("is_object")
    rules = {
        "event is not an object": ~told,
        "id contains synth": told & F.coalesce(F.lower("id").contains("synth"), F.lit(False)),
        "duplicate id": told & F.col("id").isNotNull() & F.when(F.col("id") == "", first_blank).otherwise(F.col("id_seen")),
        "missing id": told & F.col("id").isNull() & ~F.col("type").eqNullSafe("session"),
        "parent not prior": told & F.col("parent").isNotNull() & ~F.col("parent_seen"),
        "construction key": told & F.col("construction_key"),
        "time backwards": told & F.coalesce(F.col("ms") < earlier, F.lit(False)),
        "consecutive assistant": assistant & F.col("before").eqNullSafe("assistant"),
        "empty assistant": assistant & ~F.col("has_media") & (F.size("calls") == 0),
        "call id missing": assistant & F.col("call_missing"),
        "call id contains synth": assistant & F.col("call_synth"),
        "duplicate call id": assistant & F.col("call_again"),
        "result id missing": result & (F.col("ref") == ""),
        "unknown result ref": result & (F.col("ref") != "") & ~F.col("known_call"),
        "constant milliseconds": constant,
    }
    return structure.issues(rows, [*by, order], rules)
