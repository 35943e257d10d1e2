"""Repairs and clean-ups of recorded event streams: branches, stubs, parents, runs, consents, times.

A stream is the rows of one ``by`` key in the order of ``order``; all but the
folds are windows, joins or a logarithmic number of joins, so a stream is never
held in one task.  The folds (whose state depends on what they kept before)
walk a stream's rows in order inside one task, with bounded state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.operators.ordered_state import join_in_order, so_far
from lodestream.operators.walks import walk_in_order


def _ordered(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order)


def _before(by: list[str], order: str):
    return _ordered(by, order).rowsBetween(Window.unboundedPreceding, -1)


def seen_before(df: DataFrame, by: list[str], order: str, wanted: str, among: Column, name: str) -> DataFrame:
    """Whether ``wanted`` is the value of ``among`` in an earlier row of the stream."""
    held = df.select(*[F.col(b).alias(f"_by_{b}") for b in by], among.alias("_among"), F.col(order).alias("_at")).filter("_among IS NOT NULL")
    first = held.groupBy(*[f"_by_{b}" for b in by], "_among").agg(F.min("_at").alias("_first"))
    on = [*[F.col(b) == F.col(f"_by_{b}") for b in by], F.col(wanted) == F.col("_among")]
    return df.join(first, on, "left").select(*df.columns, F.coalesce(F.col("_first") < F.col(order), F.lit(False)).alias(name))


def repair_parents(df: DataFrame, by: list[str], order: str, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """Parents that no earlier row has become the id before (null at the start)."""
    own = F.nullif(F.col(id_col), F.lit(""))
    marked = seen_before(df, by, order, parent_col, own, "_valid")
    previous = F.last(own, ignorenulls=True).over(_before(by, order))
    return marked.withColumn(parent_col, F.when(F.col("_valid"), F.col(parent_col)).otherwise(previous)).drop("_valid")


def follow_links(links: DataFrame, checkpoint: Callable[[DataFrame], DataFrame], max_rounds: int = 64) -> DataFrame:
    """Pointer doubling: links (by.., node, to) until no ``to`` is a node of the links itself; adds ``cyclic``.

    After k rounds a link spans 2^k steps.  Once that is more than a stream has
    links, what still meets a node goes around or into a cycle: its ``to`` is null and ``cyclic`` is true.
    Other links of the stream are as they would be without the cycle.
    """
    keys = [c for c in links.columns if c not in ("node", "to")]
    longest = links.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    links, span = links.withColumn("cyclic", F.lit(False)), 1
    for _ in range(max_rounds):
        nxt = links.select(*keys, F.col("node").alias("to"), F.col("to").alias("_further"), F.lit(True).alias("_hit"))
        jumped = checkpoint(links.join(nxt, [*keys, "to"], "left").select(*keys, "node", F.when(F.col("_hit"), F.col("_further")).otherwise(F.col("to")).alias("to"), "cyclic", F.coalesce("_hit", F.lit(False)).alias("_hit")))
        links, span = jumped.drop("_hit"), 2 * span
        if jumped.filter("_hit").isEmpty():
            return links
        if span > 2 * longest:
            return jumped.select(*keys, "node", F.when(~F.col("_hit"), F.col("to")).alias("to"), F.col("_hit").alias("cyclic"))
    raise ValueError("longer chains than 2 to the number of rounds")


def cyclic_streams(df: DataFrame, by: list[str], checkpoint: Callable[[DataFrame], DataFrame], id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """The keys of the streams whose parents lead around in a circle; of rows of one id the first by parent counts."""
    links = df.filter(f"{id_col} <> '' AND {parent_col} IS NOT NULL").groupBy(*by, F.col(id_col).alias("node")).agg(F.min(parent_col).alias("to"))
    return follow_links(links, checkpoint).filter("cyclic").select(*by).distinct()


def drop_stubs(df: DataFrame, by: list[str], order: str, is_stub: Column, checkpoint: Callable[[DataFrame], DataFrame], id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """Rows that are stubs go; their children hang on the nearest ancestor that is none, over chains of stubs too (on none where the stubs hang on each other in a circle)."""
    stubs = df.filter(is_stub & (F.col(id_col) != "")).select(*by, F.col(id_col).alias("node"), F.col(parent_col).alias("to")).dropDuplicates([*by, "node"])
    ends = follow_links(stubs, checkpoint).select(*by, F.col("node").alias("_node"), F.col("to").alias("_to"), F.lit(True).alias("_moved"))
    kept = df.filter(~(is_stub & (F.col(id_col) != "")))
    joined = kept.join(ends, [*[kept[b] == ends[b] for b in by], kept[parent_col] == ends["_node"]], "left")
    return joined.select(*[kept[c] if c != parent_col else F.when(F.col("_moved"), F.col("_to")).otherwise(kept[c]).alias(c) for c in df.columns])


def active_branch(df: DataFrame, by: list[str], order: str, checkpoint: Callable[[DataFrame], DataFrame], id_col: str = "id", parent_col: str = "parent", max_rounds: int = 40) -> DataFrame:
    """The rows on the way from each stream's last row up its parents.

    A stream is kept whole if the way ends at a parent that no row has, or has
    fewer than half of the rows (at least two).  The way is found by doubling:
    each round joins the reached rows with links twice as long as before; links
    that would reach beyond a stream's first row are dropped.
    """
    nodes = checkpoint(df.filter(F.col(id_col) != "").groupBy(*by, F.col(id_col).alias("node")).agg(F.max_by(parent_col, order).alias("to"), F.max(order).alias("_at")))
    leaf = nodes.groupBy(*by).agg(F.max_by("node", "_at").alias("node"))
    jump, reached = nodes.select(*by, "node", "to"), leaf
    dangling = jump.filter("to IS NOT NULL").join(jump.select(*by, F.col("node").alias("to")), [*by, "to"], "left_anti").select(*by, "node")
    seen = None
    for _ in range(max_rounds):
        onward = reached.join(jump, [*by, "node"]).filter("to IS NOT NULL").select(*by, F.col("to").alias("node"))
        reached = checkpoint(reached.union(onward).distinct())
        n = reached.count()
        if n == seen:
            break
        seen = n
        jump = checkpoint(jump.join(jump.select(*by, F.col("node").alias("to"), F.col("to").alias("_next")).filter("_next IS NOT NULL"), [*by, "to"]).select(*by, "node", F.col("_next").alias("to")))
    on_way = reached.join(nodes.select(*by, "node"), [*by, "node"], "left_semi")
    sizes = df.filter(F.col(id_col) != "").groupBy(*by).agg(F.count("*").alias("_rows")).join(on_way.groupBy(*by).agg(F.count("*").alias("_way")), by)
    short = sizes.filter(F.col("_way") < F.greatest(F.lit(2), F.floor(F.col("_rows") / 2))).select(*by)
    whole = short.union(on_way.join(dangling, [*by, "node"], "left_semi").select(*by)).distinct().withColumn("_whole", F.lit(True))
    joined = df.join(whole, by, "left").join(on_way.select(*by, F.col("node").alias(id_col), F.lit(True).alias("_on")), [*by, id_col], "left")
    return joined.filter(F.coalesce("_whole", "_on", F.lit(False))).select(*df.columns)


def collapse_runs(df: DataFrame, by: list[str], order: str, mergeable: Column, boilerplate: Callable[[Column], Column], text: str = "text", counts: Column | None = None) -> DataFrame:
    """Runs of neighbouring mergeable rows become their first row with the texts joined by blank lines.

    Inside a run, a text equal to the one before goes, boilerplate gives way to
    other text.  ``counts`` tells the rows that part runs; others are passed over.
    """
    counted = F.lit(True) if counts is None else counts
    rows = df.withColumn("_m", mergeable).withColumn("_c", counted)
    before = F.last(F.when(F.col("_c"), F.col("_m")), ignorenulls=True).over(_before(by, order))
    rows = rows.withColumn("_start", (~(F.col("_m") & F.coalesce(before, F.lit(False))) & F.col("_c")).cast("long"))
    rows = rows.withColumn("_run", F.sum("_start").over(so_far(by, [order])))
    merged = rows.filter("_m").groupBy(*by, "_run").agg(F.min(order).alias(order), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_texts"))

    def fold(last: Column, row: Column) -> Column:
        t = row["t"]
        return F.when(last["n"] == 0, F.struct(t.alias("t"), F.lit(1).alias("n"))).when((last["t"] == t) | (~boilerplate(last["t"]) & boilerplate(t)), last).when(boilerplate(last["t"]), F.struct(t.alias("t"), F.lit(1).alias("n"))).otherwise(
            F.struct(F.concat_ws("\n\n", F.nullif(last["t"], F.lit("")), F.nullif(t, F.lit(""))).alias("t"), F.lit(1).alias("n"))
        )

    folded = merged.select(*by, order, F.aggregate("_texts", F.struct(F.lit("").alias("t"), F.lit(0).alias("n")), fold)["t"].alias("_text"))
    others = rows.filter("NOT _m").select(*df.columns)
    kept = rows.filter("_m").join(folded, [*by, order]).select(*[F.col("_text").alias(c) if c == text else F.col(c) for c in df.columns])
    return kept.unionByName(others)


def normalise(df: DataFrame, by: list[str], order: str, checkpoint: Callable[[DataFrame], DataFrame], boilerplate: Callable[[Column], Column]) -> DataFrame:
    """The active branch without stubs and orphaned results, text-only answers in a row made one, parents put right.

    ``df``: by, order, id, parent, role, text, has_call, call_id, ref and others.  Adds
    ``cyclic``: the stream's parents led around in a circle as it came; its rows are
    put right like all others, so one bad stream never ends the query.
    """
    marked = df.join(cyclic_streams(df, by, checkpoint).withColumn("cyclic", F.lit(True)), by, "left").withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))
    rows = checkpoint(active_branch(marked, by, order, checkpoint))
    answer = F.col("role") == "assistant"
    rows = drop_stubs(rows, by, order, answer & ~F.col("has_call") & (F.trim(F.coalesce("text", F.lit(""))) == ""), checkpoint)
    rows = collapse_runs(rows, by, order, answer & ~F.col("has_call"), boilerplate)
    rows = drop_orphan_results(rows, by, order, F.col("role") == "toolResult", F.col("call_id"), "ref")
    return repair_parents(rows, by, order)


def drop_orphan_results(df: DataFrame, by: list[str], order: str, is_result: Column, call_id: Column, ref: str) -> DataFrame:
    """Results whose call id no earlier row made go."""
    marked = seen_before(df, by, order, ref, F.nullif(call_id, F.lit("")), "_made")
    return marked.filter(~is_result | F.col("_made")).drop("_made")


def lead_in(df: DataFrame, by: list[str], order: str, is_user: Column, is_assistant: Column, text: Column, default: Column) -> DataFrame:
    """Assistant rows right after a user row that say nothing get the default text."""
    turn = F.when(is_user, F.lit("user")).when(is_assistant, F.lit("assistant"))
    before = F.last(turn, ignorenulls=True).over(_before(by, order))
    return df.withColumn("text", F.when(is_assistant & (before == "user") & (F.trim(text) == ""), default).otherwise(text))


def end_with_assistant(df: DataFrame, by: list[str], order: str, role: str, text: str, closing: str) -> DataFrame:
    """Streams whose last row is not the assistant's get one more: by, order, role, text."""
    last = df.groupBy(*by).agg(F.max_by(role, order).alias("_role"), F.max(order).alias("_end")).filter("_role <> 'assistant'")
    more = last.select(*by, (F.col("_end") + 1).alias(order), F.lit("assistant").alias(role), F.lit(closing).alias(text))
    return df.select(*by, order, role, text).unionByName(more)


def step_times(df: DataFrame, by: list[str], order: str, low: Column, high: Column, base: Column, seed: Column, name: str = "ms") -> DataFrame:
    """Monotone times: the base plus running steps, each drawn between low and high by the row's seed."""
    draw = F.conv(F.substring(F.md5(seed.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn(name, base + F.sum(low + draw % (high - low + 1)).over(so_far(by, [order])))


def first_of_key(df: DataFrame, by: list[str], order: str, key: Column, drop_next: Column) -> DataFrame:
    """Rows of a key after its first go, and with each the row behind it where ``drop_next`` holds there."""
    rows = df.withColumn("_key", key)
    n = F.row_number().over(Window.partitionBy(*by, "_key").orderBy(order))
    marked = rows.withColumn("_again", F.coalesce((n > 1) & F.col("_key").isNotNull(), F.lit(False)))
    partner = F.coalesce(F.lag("_again").over(_ordered(by, order)), F.lit(False)) & drop_next
    return marked.withColumn("_partner", partner).filter("NOT _again AND NOT _partner").drop("_key", "_again", "_partner")


def near(df: DataFrame, by: list[str], turn: str, what: Column, reach: int = 1) -> Column:
    """Whether a turn at most ``reach`` turns away is so."""
    return F.max(what.cast("int")).over(Window.partitionBy(*by).orderBy(turn).rangeBetween(-reach, reach)) == 1


def thin_runs(df: DataFrame, by: list[str], order: str, what: Column, most: int = 6) -> DataFrame:
    """Where more than ``most`` rows of a stream are so, the first two, the last two and every k-th between stay."""
    rows = df.withColumn("_what", what)
    w = Window.partitionBy(*by, "_what")
    rows = rows.withColumn("_n", F.count("*").over(w)).withColumn("_k", F.row_number().over(w.orderBy(order)))
    step = F.greatest(F.lit(1), F.floor((F.col("_n") - 4) / (most - 4)))
    middle = (F.col("_k") - 3) % step == 0
    keep = ~F.col("_what") | (F.col("_n") <= most) | (F.col("_k") <= 2) | (F.col("_k") > F.col("_n") - 2) | middle
    return rows.filter(keep).drop("_what", "_n", "_k")


def probe_position(df: DataFrame, by: list[str], turn: str, suits: Column) -> DataFrame:
    """By stream: the first suiting turn between half and 85 per cent of it, else 65 per cent (1 at least)."""
    n = F.count("*").over(Window.partitionBy(*by))
    inside = suits & (F.col(turn) >= F.floor(n * 0.5)) & (F.col(turn) < F.floor(n * 0.85))
    rows = df.withColumn("_n", n).withColumn("_t", F.when(inside, F.col(turn)))
    return rows.groupBy(*by).agg(F.coalesce(F.min("_t"), F.greatest(F.lit(1), F.floor(F.max("_n") * 0.65))).cast("long").alias("position"))


def covered_by(held: dict[str, str], key: str, submit: tuple[str, ...], search: tuple[str, ...]) -> bool:
    """Whether a consent held covers the key: one contains the other, the files' names agree, or both tools submit or search."""
    kin = submit if key in submit else (*submit, *search) if key in search else ()
    return any(g in kin or g in key or key in g or last == key.split("/")[-1] for g, last in held.items())


def fold_consents(df: DataFrame, by: list[str], order: str, key: str, submit: tuple[str, ...], search: tuple[str, ...]) -> DataFrame:
    """``df``'s asking rows with ``covered``: whether a consent that an earlier one recorded covers its key.

    A row records its key only if it isn't covered, so this is a fold; its state
    is the stream's distinct keys.
    """

    def step(held: dict[str, str], row) -> bool:  # noqa: ANN001
        now = (getattr(row, key) or "").lower()
        known = covered_by(held, now, submit, search)
        if not known:
            held[now] = now.split("/")[-1]
        return known

    return walk_in_order(df.select(*by, order, key), by, [order], dict, step, "covered", "boolean")


def drop_recent_copies(df: DataFrame, by: list[str], order: str, role: str, text: str, may_go: str, reach: int = 8) -> DataFrame:
    """Rows that may go and equal one of the last ``reach`` such rows kept go."""

    def step(recent: list[tuple], row) -> bool:  # noqa: ANN001
        now, free = (getattr(row, role), getattr(row, text)), bool(getattr(row, may_go))
        again = free and now in recent
        if free and not again:
            recent.append(now)
            del recent[:-reach]
        return again

    return walk_in_order(df, by, [order], list, step, "_again", "boolean").filter("NOT _again").drop("_again")


def until_cut(df: DataFrame, by: list[str], order: str, cuts: Column) -> DataFrame:
    """The rows up to the first that cuts its stream."""
    cut = F.min(F.when(cuts, F.col(order))).over(Window.partitionBy(*by))
    return df.withColumn("_cut", cut).filter(F.col("_cut").isNull() | (F.col(order) <= F.col("_cut"))).drop("_cut")


def runs_behind(df: DataFrame, by: list[str], order: str, head: Column, member: Column) -> DataFrame:
    """Rows that follow a head row without interruption by rows that are no members go (results behind a replaced row)."""
    rows = df.withColumn("_head", head).withColumn("_member", member)
    rows = rows.withColumn("_group", F.sum((~F.col("_member")).cast("long")).over(so_far(by, [order])))
    after = F.max(F.col("_head").cast("int")).over(Window.partitionBy(*by, "_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_gone", F.col("_member") & (F.coalesce(after, F.lit(0)) == 1)).filter("NOT _gone").drop("_head", "_member", "_group", "_gone")


def splice(df: DataFrame, inserts: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """Rows with inserts put before (slot -1) or behind (slot 1) the row of their order value, numbered anew from 0.

    ``inserts`` has ``by``, ``order``, ``slot``, ``seq`` and the columns.
    """
    rows = df.select(*by, order, F.lit(0).alias("slot"), F.lit(0).alias("seq"), *columns)
    both = rows.unionByName(inserts.select(*by, order, "slot", "seq", *columns))
    n = F.row_number().over(Window.partitionBy(*by).orderBy(order, "slot", "seq"))
    return both.select(*by, (n - 1).cast("long").alias("line"), *columns)


def chat_record(df: DataFrame, by: list[str], order: str, role: str, text: str) -> DataFrame:
    """Flat chat rows: each user row, and the assistant texts between two user rows joined by blank lines."""
    islands = F.sum((F.col(role) == "user").cast("long")).over(so_far(by, [order]))
    rows = df.filter(F.col(role).isin("user", "assistant") & (F.trim(text) != "")).withColumn("_island", islands)
    joined = rows.groupBy(*by, "_island", role).agg(F.min(order).alias(order), join_in_order(F.col(text), F.col(order), "\n\n").alias("content"))
    n = F.row_number().over(_ordered(by, order))
    return joined.withColumn("place", (n - 1).cast("long")).select(*by, "place", role, "content")
