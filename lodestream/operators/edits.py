"""The patch language on event streams, with lines that shift: seven operations applied in their order.

Patches are few; rows are many.  So a stream's patches are first walked by
themselves to find out which input row each line meant at its time (inserts
and removals shift the lines behind them), and only then applied to the rows,
by joins.  No stream is held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import terms as T
from lodestream.operators.walks import walk_in_order


class Lines:
    """The current lines of a stream as pieces: runs of input lines (first line, length), and inserted rows (None, length)."""

    def __init__(self, n: int):
        self.pieces: list[tuple[int | None, int]] = [(1, n)]
        self.end = n + 1

    def _split(self, line: int) -> int:
        """The number of the piece that begins at a current line, which is cut there if need be."""
        at = 1
        for k, (first, n) in enumerate(self.pieces):
            if line == at:
                return k
            if line < at + n:
                self.pieces[k : k + 1] = [(first, line - at), (first and first + line - at, at + n - line)]
                return k + 1
            at += n
        return len(self.pieces)

    def place(self, line: int) -> int | None:
        """The input line of a current line; null for an inserted row, one behind the last input line for the end."""
        at = 1
        for first, n in self.pieces:
            if line < at + n:
                return first and first + line - at
            at += n
        return self.end

    def insert(self, line: int, n: int) -> None:
        k = self._split(line)
        self.pieces.insert(k, (None, n))

    def remove(self, line: int) -> None:
        k = self._split(line)
        first, n = self.pieces[k]
        self.pieces[k : k + 1] = [(first and first + 1, n - 1)] if n > 1 else []


def resolve_lines(patches: DataFrame, by: list[str]) -> DataFrame:
    """Patches (by, seq, op, line, n_rows: the stream's length, ok: whether an insert has both texts) with ``row``: the input line
    (from 1) that each meant; null for lines that don't exist, and for inserted rows, which patches don't change any more.  An insert
    among inserted rows is one before the next input row, behind them; one at the end has the row n_rows + 1."""

    def fresh() -> dict:
        return {"lines": None, "n": 0}

    def step(state: dict, p) -> int:  # noqa: ANN001
        if state["lines"] is None:
            state.update(lines=Lines(p.n_rows), n=p.n_rows)
        last = state["n"] + (p.op == "insert_consent_pair_before")
        if not 1 <= p.line <= last:
            return 0
        row, line = state["lines"].place(p.line), p.line
        while row is None and p.op == "insert_consent_pair_before" and line <= state["n"]:  # among inserted rows: before the next input row
            line += 1
            row = state["lines"].place(line)
        if p.op == "insert_consent_pair_before" and p.ok:
            state["lines"].insert(line, 2)
            state["n"] += 2
        elif p.op == "remove_event" and row is not None:
            state["lines"].remove(p.line)
            state["n"] -= 1
        return row or 0

    walked = walk_in_order(patches, by, ["seq"], fresh, step, "row", "long")
    return walked.withColumn("row", F.nullif(F.col("row"), F.lit(0).cast("long")))


def apply_edits(rows: DataFrame, patches: DataFrame, by: list[str], order: str, refusal: str, token: str = T.REDACTION_TOKEN) -> DataFrame:
    """The rows (by, order, role, text, call_id, tool, arguments, ref, is_error) after all patches, numbered anew from 1 as ``line``.

    Patches: by, seq, op, line, text, drop_calls, call_id, tool, arguments, is_error, ask, answer.  Ops: replace_assistant_text
    (``drop_calls`` takes the call with it), remove_tool_call (an emptied row says the refusal), insert_consent_pair_before,
    replace_tool_call_arguments and replace_tool_call (not with a redaction token in the arguments), replace_tool_result_text,
    remove_event.  Results of removed calls go too.  Unknown ops, lines that don't exist and rows of the wrong role change nothing.
    """
    numbered = rows.withColumn("row", F.row_number().over(Window.partitionBy(*by).orderBy(order)).cast("long"))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n_rows"))
    ok = (F.trim(F.coalesce("ask", F.lit(""))) != "") & (F.trim(F.coalesce("answer", F.lit(""))) != "")
    resolved = resolve_lines(patches.join(sizes, by).select(*by, "seq", "op", "line", "n_rows", ok.alias("ok")), by).filter("row IS NOT NULL").select(*by, "seq", "row", "ok")
    p = patches.drop("line").join(resolved, [*by, "seq"])
    fields = ["op", "text", "drop_calls", "call_id", "tool", "arguments", "is_error"]
    steps = p.filter("op <> 'insert_consent_pair_before'").groupBy(*by, "row").agg(F.array_sort(F.collect_list(F.struct("seq", *fields))).alias("_steps"))
    start = F.struct(F.col("text"), F.col("call_id"), F.col("tool"), F.col("arguments"), F.col("is_error"), F.lit(False).alias("gone"), F.lit(None).cast("string").alias("dropped"))
    joined = numbered.join(steps, [*by, "row"], "left")

    def one(now: Column, e: Column) -> Column:
        assistant, result = F.col("role") == "assistant", F.col("role") == "toolResult"
        mine = assistant & (now["call_id"] == e["call_id"])
        said = assistant & (e["op"] == "replace_assistant_text") & (F.trim(e["text"]) != "")
        drops = (said & F.coalesce(e["drop_calls"], F.lit(False))) | (mine & (e["op"] == "remove_tool_call"))
        clean = ~F.coalesce(e["arguments"], F.lit(token)).contains(token)
        args = mine & e["op"].isin("replace_tool_call_arguments", "replace_tool_call") & clean
        named = args & (e["op"] == "replace_tool_call") & (e["tool"] != "")
        args = F.when(e["op"] == "replace_tool_call", named).otherwise(args)
        told = result & (e["op"] == "replace_tool_result_text") & (e["text"] != "")
        emptied = mine & (e["op"] == "remove_tool_call") & (now["text"] == "")
        yes = lambda c: F.coalesce(c, F.lit(False))
        return F.struct(
            F.when(yes(said) | yes(told), e["text"]).when(yes(emptied), F.lit(refusal)).otherwise(now["text"]).alias("text"),
            F.when(yes(drops), F.lit(None)).otherwise(now["call_id"]).alias("call_id"),
            F.when(yes(drops), F.lit(None)).when(yes(named), e["tool"]).otherwise(now["tool"]).alias("tool"),
            F.when(yes(drops), F.lit(None)).when(yes(args), e["arguments"]).otherwise(now["arguments"]).alias("arguments"),
            F.when(yes(told) & e["is_error"].isNotNull(), e["is_error"]).otherwise(now["is_error"]).alias("is_error"),
            (now["gone"] | (e["op"] == "remove_event")).alias("gone"),
            F.when(yes(drops), now["call_id"]).otherwise(now["dropped"]).alias("dropped"),
        )

    edited = joined.withColumn("_e", F.when(F.col("_steps").isNull(), start).otherwise(F.aggregate("_steps", start, one)))
    edited = edited.select(*by, "row", "role", "ref", "_e.*")
    dropped = edited.filter("dropped IS NOT NULL").select(*by, F.col("dropped").alias("ref"), F.lit(True).alias("_orphan")).distinct()
    kept = edited.filter("NOT gone").join(dropped, [*by, "ref"], "left").filter(~((F.col("role") == "toolResult") & F.coalesce("_orphan", F.lit(False))))
    kept = kept.select(*by, "row", F.lit(1).alias("_slot"), F.lit(0).cast("long").alias("_seq"), "role", "text", "call_id", "tool", "arguments", "ref", "is_error")
    pair = F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("_seq"), F.lit(r).alias("role"), F.col(c).alias("text")) for i, (r, c) in enumerate((("assistant", "ask"), ("user", "answer")))]))
    none = lambda n, t="string": F.lit(None).cast(t).alias(n)
    inserts = p.filter("op = 'insert_consent_pair_before' AND ok").select(*by, "row", F.lit(0).alias("_slot"), F.col("seq").alias("_at"), pair)
    # Of several inserts before one row the later one stands nearer to it.
    inserts = inserts.select(*by, "row", "_slot", (F.col("_at") * 2 + F.col("_seq")).cast("long").alias("_seq"), "role", "text", none("call_id"), none("tool"), none("arguments"), none("ref"), none("is_error", "boolean"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy("row", "_slot", "_seq"))
    return kept.unionByName(inserts).withColumn("line", n.cast("long")).drop("row", "_slot", "_seq")
