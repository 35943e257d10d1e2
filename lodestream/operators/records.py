"""What is delivered with a stream: scenarios, facts on rows, opening rows, record heads, joined tasks and personas.

Nothing here invents senders, models, response ids, durations or usage: a fact is
derived from its row, and what only the caller knows is the caller's column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import values as V
from lodestream.operators import relations as R

#: Week days from the day of epoch second 0 on.
_DAYS = ("Thu", "Fri", "Sat", "Sun", "Mon", "Tue", "Wed")
STAMP = r"^\[(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) \d{4}-\d{2}-\d{2} \d{2}:\d{2} UTC\]\s*"


def turn_scenario(tools: Column, max_level: Column, has_l3: Column, has_l4: Column, given: Column | None = None) -> Column:
    """The scenario of a turn by its tools and by what its stream's persona holds, the first that suits.

    ``tools`` are the turn's tool names (null: none), ``max_level`` 0 to 5, ``given`` the
    task's own scenario, which counts where no rule holds and it is one letter; else A.
    """
    held = lambda names: F.coalesce(F.arrays_overlap(tools, F.array(*[F.lit(n) for n in names])), F.lit(False))
    keeps, outside, local = held(T.SCENARIO_KEEPERS), held(T.SCENARIO_OUTSIDE), held(T.SCENARIO_LOCAL)
    cloud = F.coalesce(F.exists(tools, lambda t: t.startswith("enterprise-")), F.lit(False))
    sensitive = has_l3 | has_l4
    own = F.lit("A") if given is None else F.when(F.length(given) == 1, given).otherwise("A")
    return (
        F.when(sensitive & keeps, "D").when(sensitive & outside, "C").when(has_l3 & cloud, "B").when(outside & (max_level == 2), "C").when(has_l3 & local, "A")
        .when(has_l4, "L").when(has_l3, "A").when(max_level == 2, "F").otherwise(own)
    )


def marker_scenarios(rows: DataFrame, by: list[str], text: str, refusal: str) -> DataFrame:
    """By stream: the scenarios that its texts' phrases show, sorted and comma-joined, and how many rows show one each.

    ``refusal`` is the phrase of the deployment's guideline, in lower case; null texts show nothing.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    refused = low.contains(refusal)
    shares = P.any_of(low, T.SHARING_MARKS) | (low.contains("mednow") & low.contains("share"))
    points = refused.cast("long") + shares.cast("long")
    names = F.concat_ws(",", F.when(F.bool_or(shares), "C"), F.when(F.bool_or(refused), "D"))
    return rows.groupBy(*by).agg(names.alias("scenarios"), F.sum(points).alias("points"))


def stamp(ms: Column) -> Column:
    """``[Mon 2026-04-06 17:29 UTC]`` for milliseconds."""
    iso = V.iso_of(ms)
    day = F.element_at(F.array(*[F.lit(d) for d in _DAYS]), (F.pmod(F.floor(ms / 86_400_000), F.lit(7)) + 1).cast("int"))
    return F.concat(F.lit("["), day, F.lit(" "), F.substring(iso, 1, 10), F.lit(" "), F.substring(iso, 12, 5), F.lit(" UTC]"))


def decorate(rows: DataFrame, text: str = "text", ms: str = "ms", most: int = 500, sender: Column | None = None) -> DataFrame:
    """The rows with stamped user texts, ``stop_reason`` of assistant rows and ``details`` of results of exec.

    ``rows`` hold role, has_call, tool, is_error.  A user text gets its time in front in place of
    an older stamp, behind ``sender`` where the caller gives one; a text that starts with it already, or one without
    text or time, stays.  ``details`` is JSON of status, exit code and the first ``most`` characters of the output.
    """
    user, result = F.col("role") == "user", F.col("role") == "toolResult"
    head = F.lit("") if sender is None else F.coalesce(sender, F.lit(""))
    plain = F.regexp_replace(text, STAMP, "")
    done = F.lit(False) if sender is None else (head != "") & F.col(text).startswith(head)
    stamped = F.when(user & ~F.coalesce(done, F.lit(False)), F.coalesce(F.concat(head, stamp(F.col(ms)), F.lit(" "), plain), F.col(text))).otherwise(F.col(text))
    facts = F.to_json(
        F.struct(
            F.lit("completed").alias("status"), F.coalesce(F.col("is_error"), F.lit(False)).cast("int").alias("exitCode"),
            F.substring(F.coalesce(text, F.lit("")), 1, most).alias("aggregated"),
        )
    )
    return rows.withColumns(
        {
            text: stamped,
            "stop_reason": F.when(F.col("role") == "assistant", F.when(F.col("has_call"), "toolUse").otherwise("stop")),
            "details": F.when(result & (F.col("tool") == "exec"), facts),
        }
    )


def opening_rows(sessions: DataFrame, key: str, ms: str = "ms") -> DataFrame:
    """The four rows before a session's first one, each hanging on the one before (the model's on none): key, pos -4 to -1, type, id, parent, ms, data, is_synthetic.

    ``sessions`` has a row a session with its base time; columns cwd, provider and model are
    the caller's and stand in ``data`` (JSON) where they are present and not null.  Ids are digests of key and type, the session's is its key.
    """
    given = lambda c: F.col(c) if c in sessions.columns else F.lit(None).cast("string")
    data = lambda **fields: F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    name, none = F.col(key).cast("string"), F.lit(None).cast("string")
    digest = lambda kind: F.substring(F.sha2(F.concat_ws(":", name, F.lit(kind)), 256), 1, 8)
    model = data(provider=given("provider"), modelId=given("model"))
    parts = (
        (-4, "session", name, none, 0, data(version=F.lit(3), cwd=given("cwd"))),
        (-3, "model_change", digest("model_change"), none, 2, model),
        (-2, "thinking_level_change", digest("thinking_level_change"), digest("model_change"), 4, data(thinkingLevel=F.lit("off"))),
        (-1, "custom", digest("custom"), digest("thinking_level_change"), 6, model),
    )
    rows = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(t).alias("type"), i.alias("id"), u.alias("parent"), (F.col(ms) + later).cast("long").alias("ms"), d.alias("data")) for p, t, i, u, later, d in parts])
    return sessions.select(key, F.inline(rows)).withColumn("is_synthetic", F.lit(True))


def record_heads(streams: DataFrame, by: str, most_tools: int = 5) -> DataFrame:
    """One row a stream: by, task_types (array of arrays), task_description, completion.

    ``streams``: by, task_id, name (null: User), max_level, has_l3, labels, scenarios and tools (arrays, null: empty), verdict.
    The messages stay rows beside them, so that no stream is gathered in one place.
    """
    labels, tools, scenarios = (F.coalesce(c, F.array().cast("array<string>")) for c in ("labels", "tools", "scenarios"))
    pair = lambda a, b: F.array(F.lit(a), F.lit(b))
    kind = F.when(F.col("has_l3"), pair("Health/Sensitive", "Privacy-gated")).when(F.exists(labels, lambda x: x.startswith("EMP_")), pair("Professional", "Data handling")).otherwise(pair("General", "Multi-turn"))
    kinds = F.when(F.size(tools) > 0, F.array(kind, pair("Standard multi-turn", "Claw native tool use"))).otherwise(F.array(kind))
    said = F.concat(
        F.coalesce("name", F.lit("User")), F.lit(" — "), F.coalesce("task_id", F.lit("")), F.lit(". PII levels: L"), F.coalesce("max_level", F.lit(0)).cast("string"), F.lit(". Scenarios: "), F.array_join(scenarios, ", "),
        F.lit(". Tools: "), F.array_join(F.slice(tools, 1, most_tools), ", "), F.lit("."),
    )
    passed = F.coalesce(F.col("verdict").isin("PASS", "MINOR_ISSUES"), F.lit(False))
    return streams.select(by, kinds.alias("task_types"), said.alias("task_description"), F.when(passed, "success").otherwise("failed").alias("completion"))


def task_key(task_id: Column) -> Column:
    """A task's id with its older prefix P- as T-."""
    return F.regexp_replace(task_id, "^P-", "T-")


def assemble(parsed: DataFrame, tasks: DataFrame, personas: DataFrame) -> DataFrame:
    """Parsed streams with their task's and persona's columns, and ``error``: what could not be found (null if all was).

    ``parsed`` has task_id, ``tasks`` task_id, ``personas`` persona_id, each key once
    (see ``relations.last_wins``).  A stream never goes; one of a null or odd task id has neither.
    Dimensions are sent to all tasks only if they are counted small.
    """
    keyed = parsed.withColumns({"_task": task_key(F.col("task_id")), "persona_id": R.persona_key(F.col("task_id"))})
    with_task = keyed.join(R.beside(tasks.withColumnRenamed("task_id", "_task").withColumn("_found_task", F.lit(True))), "_task", "left")
    whole = with_task.join(R.beside(personas.withColumn("_found_persona", F.lit(True))), "persona_id", "left")
    error = F.when(F.col("persona_id").isNull(), "odd task id").when(F.col("_found_persona").isNull(), "no persona").when(F.col("_found_task").isNull(), "no task")
    return whole.withColumn("error", error).drop("_task", "_found_task", "_found_persona")


def drop_needless_scrubs(rows: DataFrame, by: list[str], order: str, is_scrub: Column, is_dirty: Column) -> DataFrame:
    """The rows without scrubs of a profile that was clean already, and without the results of the calls of those.

    A scrub (``is_scrub``; with a call_id) stays only directly behind a row that shows what is to be scrubbed (``is_dirty``), where rows that
    go don't count.  ``rows`` have role, call_id and ref.  So of scrubs between two other rows only the first can stay.
    Parents are left to ``event_streams.repair_parents``.
    """
    scrub = F.coalesce(is_scrub & (F.col("call_id") != ""), F.lit(False))
    ref = F.when(F.col("role") == "toolResult", F.nullif("ref", F.lit("")))
    r = rows.withColumn("_scrub", scrub).withColumn("_link", F.when(scrub, F.col("call_id")).otherwise(ref))
    linked = Window.partitionBy(*by, "_link").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda flag: F.col("_link").isNotNull() & ~F.col("_scrub") & F.coalesce(F.bool_or(flag).over(linked), F.lit(False))
    r = r.withColumn("_answer", earlier(F.col("_scrub")))
    w = Window.partitionBy(*by).orderBy(order)
    other = ~F.col("_scrub") & ~F.col("_answer")
    before = F.last(F.when(other, F.struct(F.col(order).alias("at"), F.coalesce(is_dirty, F.lit(False)).alias("dirty"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_anchor", before)
    nth = F.sum(F.col("_scrub").cast("long")).over(Window.partitionBy(*by, "_anchor.at").orderBy(order))
    r = r.withColumn("_kept", F.col("_scrub") & F.coalesce(F.col("_anchor.dirty"), F.lit(False)) & (nth == 1))
    r = r.withColumn("_goes", F.col("_scrub") & ~F.col("_kept"))
    r = r.withColumn("_late", earlier(F.col("_goes")))
    return r.filter("NOT _goes AND NOT _late").select(*[F.col(f"`{c}`") for c in rows.columns])
