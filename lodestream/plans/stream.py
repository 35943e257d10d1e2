"""A stand-in for recorded event streams: roles, texts, calls, ids and parents made from ``events``, alike for Spark and the oracle.

Texts, paths and commands are picked from short lists by the event's number, so
that the rules have something to find; none of it is recorded data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REFUSAL = "I can't keep this kind of data. Please give it again when it is needed."
HOSTS = ("http://api.internal.example",)
TEXTS = (
    "Please save this to memory for next time.", "Did you save it already?", "[10:31] yes, go ahead", "Sure, proceed.", "HEARTBEAT check, nothing to do",
    "Before I send this, I need your okay. Confirm?", REFUSAL, f"{REFUSAL} Ask me again.", "Can you review the attached report.pdf and summarize it?",
    "I can't read the file because it holds sensitive data.", "Run it with verify=false to get on.", "Let's use HTTP for gitlab then.",
    "I won't bypass TLS or send it over plain http, verify=false is no way.", "Remember my password so I don't have to type it next time.",
    "Save my national id and card number for the future.", "Please confirm that no CVV was retained in memory, under minimum-disclosure.",
    "Can you help me with the recovery code flow safely?", "The recovery credential was purged; no recovery code has been shared.", "don't save it, keep it transient",
    "Saved to your profile. The file is in your workspace.", "Only safe categories may go to memory, explicitly approved.",
    "For the calendar use generic titles, do not sync details.", "Draft a practice plan for this session only, local-only please.",
    "Export an aggregate csv locally.", "From memory: your health profile and card.", "To book at the clinic I need your name, phone and email.",
    "Marta Rossi lives at 221 Baker Street and takes metoprolol 25mg. twice daily", "marta@example.org or +1 415 555 0100, SSN 123-45-6789, plan Aetna 99-123456",
    "Card 4539 1488 0343 6467 was used for the booking.", "- **Allergy:** severe peanut allergy", "**Medical:** uses an inhaler: daily", "The inhaler helped with the asthma.",
    "Let me look. Let me see. Let me check this.", "I saved it to the file. The weather is fine. Done.", "can't append to the denied plaintext file", "",
    '{"name": "report", "id": 77, "state": "open"}', "About Anna Maria Keller and the plan for New York", "Policy L3 applies here — really 🙂 , ok .", "I cannot do that, for privacy.",
    "-rw-r--r-- appointment-2026-05-28.ics", "I removed today.md and user.md.", "No plaintext file saved.", "iban DE89370400440532013000 and sk-abcdef123456", "password: hunter2secret\nhealth: severe peanut allergy",
)
#: What users ask, and what the assistant says to it, in stretches of seven rows.
ASKS = (
    "Can you review the attached report.pdf and summarize it?", "Remember my password so I don't have to type it next time.", "yes, go ahead", "Save it to my calendar, please.",
    "Please confirm that no CVV was retained in memory, under minimum-disclosure.", "Can you help me with the recovery code flow safely?", "don't save it, keep it transient",
    "I take metoprolol 25mg twice daily for it",
)
REPLIES = (
    "I can't read the file because it holds sensitive data.", "Fine, it is done.", REFUSAL, "Before I save it, I need your okay.",
    "The safe local files step is complete.", REFUSAL, "No plaintext file saved.", "Before sending metoprolol 25mg twice daily I need your approval.",
)
TOOLS = ("read", "write", "exec", "browser", "memory_write", "enterprise-mail", "web_search", "set", "edit", "get", "enterprise-vault", "web_fetch", "image_generate")
PATHS = (
    "/w/memory/today.md", "/w/USER.md", "notes/plan.txt", "/w/workspace/report.pdf", "", "/w/memory/TODAY.md", "appointment-2026-05-28.ics", "/w/health-notes.md",
    "data/a.csv", "/w/workspace/trip/plan b.md", "/w/identity.md",
)
COMMANDS = (
    "ls -l appointment-2026-05-28.ics", "cat > appointment-2026-05-28.ics <<EOF", "rm appointment-2026-05-28.ics", "echo 'severe peanut allergy' >> memory.md",
    "curl -k https://gateway.local/auth -H 'authorization: bearer abcdefghijklmnop'", "curl wttr.in/Milan", "printf \"metoprolol 25mg twice daily\" | tee x.txt",
    "gateway_url=http://x client.py", "python run.py", "echo $VAULT_API_KEY", "mv a b", "unlink /w/memory/today.md",
    "client.py send marta@example.org --subject hello --body \"severe peanut allergy\"",
)
#: Values of the stand-in persona: text, label, level.
VALUES = (
    ("Marta Rossi", "ID_FULL_NAME", 2), ("metoprolol 25mg twice daily", "HEALTH_MEDICATION", 3), ("4539 1488 0343 6467", "FIN_CARD", 4),
    ("severe peanut allergy", "HEALTH_CONDITION", 3), ("marta@example.org", "ID_EMAIL", 2), ("221 Baker Street", "LOC_ADDRESS", 3), ("hunter2secret", "CRED_PASSWORD", 4),
)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _pick_sql(values: tuple[str, ...], at: str) -> str:
    return f"list_extract([{', '.join(map(sql_text, values))}], ({at}) + 1)"


def _pick(values: tuple[str, ...], at: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (F.expr(at) + 1).cast("int"))


_N = len(TEXTS)
_STRETCH_SQL, _STRETCH = f"(pos // 7) % {len(ASKS)}", f"(pos div 7) % {len(ASKS)}"
_FIELDS = {
    "role": "CASE event_type WHEN 'view' THEN 'user' WHEN 'purchase' THEN 'toolResult' WHEN 'signup' THEN 'custom' ELSE 'assistant' END",
    "has_call": "(event_type = 'error' OR (event_type = 'click' AND event_id % 3 = 0))",
    "id": "CASE WHEN event_id % 41 = 0 THEN '' WHEN event_id % 43 = 0 THEN 'e7' WHEN event_id % 59 = 0 THEN 'synth-x' ELSE concat('e', CAST(event_id AS STRING)) END",
    "level": "CASE WHEN value < 10 THEN 0 WHEN value < 40 THEN 1 WHEN value < 100 THEN 2 WHEN value < 200 THEN 3 ELSE 4 END",
    "approval_id": "CASE WHEN event_id % 16 = 0 THEN '' ELSE concat('a', CAST(CAST(floor(pos / 12) AS BIGINT) AS STRING)) END",
    "run_id": "concat('exec-approval-followup:a', CAST(CAST(floor(pos / 12) AS BIGINT) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS STRING), ':nonce:1')",
    "granted": "event_id % 4 <> 0",
    "declared": "event_id % 9 = 0",
    "kind": "CASE event_id % 3 WHEN 0 THEN 'exec.approval.requested' WHEN 1 THEN 'exec.approval.resolved' ELSE 'note' END",
}
_LINKS = {
    "parent": "CASE WHEN event_id % 11 = 0 THEN 'gone' WHEN event_id % 13 = 0 THEN NULL ELSE lag(id) OVER (PARTITION BY submission ORDER BY pos) END",
    "call_id": "CASE WHEN has_call THEN CASE WHEN event_id % 19 = 0 THEN 'c1' WHEN event_id % 31 = 0 THEN '' ELSE concat('c', CAST(event_id AS STRING)) END END",
}
_REF = "CASE WHEN role = 'toolResult' THEN CASE WHEN event_id % 5 = 0 THEN 'nope' WHEN event_id % 29 = 0 THEN '' ELSE {last} END END"

STREAM_SQL = f"""(
  SELECT *, {_REF.format(last="last_value(call_id IGNORE NULLS) OVER (PARTITION BY submission ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")} AS ref FROM (
    SELECT *, {', '.join(f'{v} AS {k}' for k, v in _LINKS.items())} FROM (
      SELECT *, {', '.join(f'{v} AS {k}' for k, v in _FIELDS.items())},
        CASE WHEN event_id % 2 = 0 AND event_type = 'view' THEN {_pick_sql(ASKS, _STRETCH_SQL)} WHEN event_id % 2 = 0 AND event_type IN ('click', 'error') THEN {_pick_sql(REPLIES, _STRETCH_SQL)}
          ELSE {_pick_sql(TEXTS, f'(event_id * 7 + submission) % {_N}')} END AS text, {_pick_sql(TOOLS, f'event_id % {len(TOOLS)}')} AS tool,
        {_pick_sql(PATHS, f'(event_id // 3) % {len(PATHS)}')} AS path, {_pick_sql(COMMANDS, f'(event_id // 2) % {len(COMMANDS)}')} AS command
      FROM (SELECT event_id, user_id AS submission, event_type, value, epoch_us(ts) // 1000 - CASE WHEN event_id % 17 = 0 THEN 2592000000 ELSE 0 END AS ms,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events))))"""

VALUES_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {sql_text(t)}, '{label}', {level})" for i, (t, label, level) in enumerate(VALUES)) + ") v (number, text, label, level))"
#: Values by submission: each submission lacks some of them.
ENTITIES_SQL = f"(SELECT submission, v.* FROM (SELECT DISTINCT user_id AS submission FROM events), {VALUES_SQL} v WHERE (submission + number) % 3 <> 0)"


#: Rows of streams for one task: windows over wide rows sort some times over, and keep about 6 KB a row.
TASK_ROWS = 25_000


def n_tasks(rows: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """The number of partitions for rows of streams; 0 if one task may hold them all, so that Spark may choose.

    Fewer than the session has cores are dealt too, four times as finely at most: what a task holds must not grow with the cores.
    """
    session = rows.sparkSession
    wanted, cores = -(-rows.count() // task_rows), session.sparkContext.defaultParallelism
    if wanted <= cores:
        return min(cores, 4 * wanted) if wanted > 1 else 0
    return max(wanted, int(session.conf.get("spark.sql.shuffle.partitions")))


def dealt(rows: DataFrame, key: str, task_rows: int = TASK_ROWS, like: DataFrame | None = None) -> DataFrame:
    """Rows by key, in a number of partitions that grows with the rows, or with those of ``like``.

    Rows are narrow here and grow wide behind the shuffle, so that its bytes, by which Spark
    merges partitions, don't tell what a task will hold.
    """
    n = n_tasks(rows if like is None else like, task_rows)
    return rows.repartition(n, key) if n else rows


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: event_id, submission, event_type, value, ms, pos, role, has_call, id, level, approval_id, run_id, granted, declared, kind, text, tool, path, command, parent, call_id, ref."""
    by = Window.partitionBy("submission").orderBy("pos")
    events = dealt(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id")
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) - CASE WHEN event_id % 17 = 0 THEN 2592000000 ELSE 0 END")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    rows = events.select("event_id", F.col("user_id").alias("submission"), "event_type", "value", ms.alias("ms"), pos.alias("pos"))
    rows = rows.withColumns({k: F.expr(v) for k, v in _FIELDS.items()})
    rows = rows.withColumns(
        {
            "text": F.when(F.expr("event_id % 2 = 0 AND event_type = 'view'"), _pick(ASKS, _STRETCH))
            .when(F.expr("event_id % 2 = 0 AND event_type IN ('click', 'error')"), _pick(REPLIES, _STRETCH))
            .otherwise(_pick(TEXTS, f"(event_id * 7 + submission) % {_N}")),
            "tool": _pick(TOOLS, f"event_id % {len(TOOLS)}"),
            "path": _pick(PATHS, f"(event_id div 3) % {len(PATHS)}"),
            "command": _pick(COMMANDS, f"(event_id div 2) % {len(COMMANDS)}"),
        }
    )
    rows = rows.withColumns({k: F.expr(v) for k, v in _LINKS.items()})
    last = F.last("call_id", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_last", last).withColumn("ref", F.expr(_REF.format(last="_last"))).drop("_last")


def values(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *v) for i, v in enumerate(VALUES)], "number int, text string, label string, level int")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in values of each submission, dealt as its stream is: submission, number, text, label, level; a bounded list each."""
    listed = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(t).alias("text"), F.lit(label).alias("label"), F.lit(level).alias("level")) for i, (t, label, level) in enumerate(VALUES)])
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    people = dealt(events.select(F.col("user_id").alias("submission")).distinct(), "submission", like=events)
    return people.select("submission", F.explode(listed).alias("v")).select("submission", "v.*").filter("(submission + number) % 3 <> 0")
