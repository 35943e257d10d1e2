"""Recorded sessions: archive members, snapshots, session choice, dimensions, and logs normalised to messages, turns, calls and results.

Where snapshots lie inside an archive is a convention of its exporter, so the
prefixes are parameters.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import values as V
from lodestream.operators import relations as R
from lodestream.sources.members import BROKEN

MEMBERS = "archive string, name string, size long, content binary, error string"
BLOCKS = "array<struct<type:string,text:string,thinking:string,id:string,name:string,arguments:string,input:string>>"
MESSAGE = "struct<role:string,content:string,toolCallId:string,tool_call_id:string,toolName:string,name:string,isError:boolean,timestamp:string>"
EVENT = f"struct<type:string,id:string,parentId:string,timestamp:string,sessionId:string,traceId:string,message:{MESSAGE},data:struct<finalPromptText:string,prompt:string,messagesSnapshot:array<{MESSAGE}>>>"


# Archives


def read_members(spark: SparkSession, path: str, largest: int = 1 << 28) -> DataFrame:
    """One row per file of every zip archive under ``path``.

    Members above ``largest`` bytes have no content, and ``error`` says so (``members.read_parts``
    reads them in parts), as do broken ones; a broken archive is one row without name, with its error.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for where, packed in (row for f in frames for row in zip(f["path"], f["content"], strict=True)):
            try:
                archive = zipfile.ZipFile(io.BytesIO(packed))
            except zipfile.BadZipFile as e:
                yield pd.DataFrame({"archive": [where], "name": [None], "size": [None], "content": [None], "error": [str(e)]}).astype({"size": "Int64"})
                continue
            for m in archive.infolist():
                if not m.is_dir():
                    try:
                        content, error = (archive.read(m), None) if m.file_size <= largest else (None, f"larger than {largest} bytes")
                    except BROKEN as e:
                        content, error = None, str(e)
                    yield pd.DataFrame({"archive": [where], "name": [m.filename], "size": [m.file_size], "content": [content], "error": [error]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(unpack, MEMBERS)


def is_final(name: Column, prefixes: tuple[str, ...] = ("final-snapshot/",)) -> Column:
    """Whether a member belongs to the last snapshot: a prefix with a folder's name anywhere, or a hidden root folder at the start."""
    bare = F.regexp_replace(name, "^/+", "")
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | (bare.startswith(p) if p.startswith(".") else bare.contains(p))
    return hit & ~name.startswith("__MACOSX")


def is_initial(name: Column) -> Column:
    return name.contains("initial-snapshot/") & ~name.startswith("__MACOSX")


def text_of_member(content: Column) -> Column:
    """The member as text; broken UTF-8 becomes replacement characters."""
    return F.make_valid_utf8(content.cast("string"))


def session_index(members: DataFrame, prefixes: tuple[str, ...] = ("final-snapshot/",)) -> DataFrame:
    """The sessions listed in each archive's index (that of the last snapshot, then by name): archive, session_id, started, updated (ms)."""
    listed = members.filter(F.col("name").endswith("sessions.json") & F.col("name").contains("sessions/") & ~F.col("name").startswith("__MACOSX"))
    best = listed.groupBy("archive").agg(F.min_by("content", F.struct((~is_final(F.col("name"), prefixes)).alias("late"), "name")).alias("content"))
    rows = best.select("archive", F.explode(F.from_json(text_of_member(F.col("content")), "map<string,struct<sessionId:string,createdAt:string,sessionStartedAt:string,updatedAt:string>>")).alias("key", "s"))
    started, updated = F.coalesce("s.sessionStartedAt", "s.createdAt", F.lit("0")), F.coalesce("s.updatedAt", "s.createdAt", F.lit("0"))
    return rows.select("archive", F.coalesce("s.sessionId", "key").alias("session_id"), V.epoch_ms(started).alias("started"), V.epoch_ms(updated).alias("updated"))


def session_logs(members: DataFrame, prefixes: tuple[str, ...] = ("final-snapshot/",)) -> DataFrame:
    """Members that can be a session's log: JSON lines whose first line parses."""
    name = F.col("name")
    first = F.element_at(F.split(F.trim(text_of_member(F.col("content"))), "\n"), 1)
    logs = members.filter(name.endswith(".jsonl") & ~name.contains("trajectory-path") & ~name.startswith("__MACOSX") & (F.col("size") > 0))
    return logs.filter(F.try_parse_json(first).isNotNull()).withColumn("is_final", is_final(name, prefixes))


def task_references(members: DataFrame, prefixes: tuple[str, ...] = ("final-snapshot/",)) -> DataFrame:
    """Task ids and times in the names of reference files of the last snapshot."""
    name = F.col("name")
    refs = members.filter(is_final(name, prefixes) & name.contains("workspace/trajectories/"))
    return refs.select("archive", F.regexp_extract("name", r"sess-\d+-(T-\d{3}-\d{2})\.jsonl$", 1).alias("task_id"), V.reference_ms(name).alias("at")).filter("at IS NOT NULL")


def choose_sessions(members: DataFrame, prefixes: tuple[str, ...] = ("final-snapshot/",), tolerance_ms: int = 1_800_000, tie_ms: int = 60_000) -> DataFrame:
    """The log of each archive: archive, task_id, name.

    The session that started nearest to the newest task reference (within the
    tolerance, ties by last update), else the latest updated session that has a
    log, else the largest log: of the last snapshot's sessions, of any sessions, of all.
    """
    logs, index = session_logs(members, prefixes), session_index(members, prefixes)
    dialogue = logs.filter(text_of_member(F.col("content")).contains('"user"') & text_of_member(F.col("content")).contains('"assistant"'))

    def of_session(found: DataFrame) -> DataFrame:
        hit = index.join(found, "archive").filter(F.col("name").contains(F.col("session_id")))
        return R.best_session(hit, ["archive", "session_id", "started", "updated"])

    newest = task_references(members, prefixes).groupBy("archive").agg(F.max_by("task_id", "at").alias("task_id"), F.max("at").alias("at"))
    gaps = index.join(newest, "archive").withColumn("gap", F.abs(F.col("started") - F.col("at")))
    gaps = gaps.withColumn("best", F.min("gap").over(Window.partitionBy("archive"))).filter((F.col("gap") <= tolerance_ms) & (F.col("gap") <= F.col("best") + tie_ms))
    near = gaps.select("archive", "session_id", "gap").join(of_session(dialogue), ["archive", "session_id"])
    near = near.groupBy("archive").agg(F.min_by("name", F.struct("gap", "updated", "session_id")).alias("near"))
    recent = of_session(logs).groupBy("archive").agg(F.max_by("name", F.struct("updated", "session_id")).alias("recent"))
    native, session = F.col("name").endswith(".trajectory.jsonl"), F.col("name").contains("sessions/")
    rank = F.when(F.col("is_final") & session & ~native, 0).when(session & ~native, 1).otherwise(2)
    largest = logs.groupBy("archive").agg(F.min_by("name", F.struct(rank.alias("r"), -F.col("size"), "name")).alias("largest"))
    all_of = members.filter("name IS NOT NULL").select("archive").distinct().join(newest.select("archive", "task_id"), "archive", "left")
    return all_of.join(near, "archive", "left").join(recent, "archive", "left").join(largest, "archive", "left").select("archive", "task_id", F.coalesce("near", "recent", "largest").alias("name"))


def workspace_files(members: DataFrame, snapshot: str = "final", prefixes: tuple[str, ...] = ("final-snapshot/",), largest: int = 500_000, hidden: tuple[str, ...] = (".git/",)) -> DataFrame:
    """Workspace files of a snapshot: archive, path within the workspace, content; hidden folders and large files are left out.
    An archive without a last snapshot gives all its workspace files."""
    files = members.filter(F.col("name").contains("/workspace/") & ~F.col("name").startswith("__MACOSX"))
    if snapshot == "initial":
        files = files.filter(is_initial(F.col("name")))
    else:
        final = is_final(F.col("name"), prefixes)
        files = files.withColumn("_any", F.max(final.cast("int")).over(Window.partitionBy("archive"))).filter(final | (F.col("_any") == 0))
    path = F.substring_index("name", "/workspace/", -1)
    kept = ~F.lit(False)
    for h in hidden:
        kept = kept & ~path.startswith(h)
    return files.filter(kept & (F.col("size") <= largest)).select("archive", path.alias("path"), text_of_member(F.col("content")).alias("content"))


# Dimensions and corpora


def read_strict_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of which a bad one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_dimension(spark: SparkSession, path: str, key: str, under: str | None = None) -> DataFrame:
    """A list of objects (or an object with the list under a name) as rows; of equal keys the last one stays."""
    rows = spark.read.option("multiLine", True).json(path).withColumns({"_file": F.input_file_name(), "_line": F.monotonically_increasing_id()})
    if under and under in rows.columns:
        rows = rows.select("_file", "_line", F.posexplode(under).alias("_place", "_item")).select("_file", "_line", "_place", "_item.*")
    else:
        rows = rows.withColumn("_place", F.lit(0))
    return R.last_wins(rows, [key], [F.desc("_file"), F.desc("_line"), F.desc("_place")]).drop("_file", "_line", "_place")


def read_inverted(spark: SparkSession, path: str, value: str, item: str) -> DataFrame:
    """An object of lists (tier to tools) as rows of item and value; an item listed twice has the later value."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.map_entries(F.from_json("value", "map<string,array<string>>"))).alias("e")).withColumn("line", F.monotonically_increasing_id())
    rows = pairs.select(F.explode("e.value").alias(item), F.col("e.key").alias(value), "line")
    return R.last_wins(rows, [item], [F.desc("line")]).select(item, value)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """An object of labels and their levels as rows."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("label", "level"))


def read_tasks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Task definitions of CSV files with headers: later files and lines override, ids begin with T-, and each has a stable UUID."""
    found = None
    for n, path in enumerate(paths):
        rows = spark.read.option("header", True).csv(path).withColumn("_file", F.lit(n)).withColumn("_line", F.monotonically_increasing_id())
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    named = found.withColumn("task_id", F.regexp_replace("task_id", "^P-", "T-"))
    return R.last_wins(named, ["task_id"], [F.desc("_file"), F.desc("_line")]).drop("_file", "_line").withColumn("task_uuid", name_uuid(F.col("task_id")))


def name_uuid(name: Column, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """The version 5 UUID of a name, as a column."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(19, 2), F.lit("-"), part(21, 12))


def read_corpus(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """JSON lines of a folder with their file's name and path; ``head`` takes the first files by name, then path."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path).withColumn("path", F.input_file_name())
    lines = lines.withColumn("file", F.element_at(F.split("path", "/"), -1))
    if head is None:
        return lines
    names = lines.select("file", "path").distinct().orderBy("file", "path").limit(head)
    return lines.join(F.broadcast(names), ["file", "path"], "left_semi").select(*lines.columns)


def read_memory_files(spark: SparkSession, path: str) -> DataFrame:
    """Memory files under a folder: MEMORY.md, and Markdown in a folder named memory."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True).withColumn("path", F.input_file_name())
    return files.filter(F.col("path").endswith("/MEMORY.md") | F.lower("path").contains("/memory/")).select("path", F.col("value").alias("content"))


def installed_skills(files: DataFrame, by: list[str]) -> DataFrame:
    """Skills of a workspace: folders that hold SKILL.md, with its first line as description and the tier of their name."""
    rows = files.filter(F.col("path").endswith("/SKILL.md"))
    skill = F.element_at(F.split("path", "/"), -2)
    first = F.regexp_replace(F.element_at(F.split(F.trim("content"), "\n"), 1), "^#+\\s*", "")
    return rows.select(*by, skill.alias("skill"), F.substring(first, 1, 120).alias("description"), P.tier_of(skill).alias("tier"))


def openers(rows: DataFrame, text: str, least: int = 30, most: int = 400) -> DataFrame:
    """First messages worth copying in style: longer than ``least``, cut at ``most``."""
    return rows.filter(F.length(F.trim(text)) > least).select(F.substring(F.trim(text), 1, most).alias("opener"))


def sampled_messages(rows: DataFrame, file: str, text: str, files: int, low: int, high: int, seed: int = 7) -> DataFrame:
    """Texts of a length between the bounds from a seeded sample of files."""
    names = rows.select(file).distinct().orderBy(F.md5(F.concat_ws(":", F.lit(seed), file).cast("binary"))).limit(files)
    return rows.join(names, file, "left_semi").filter((F.length(text) > low) & (F.length(text) < high) & ~P.is_heartbeat(F.col(text)))


def first_lines(rows: DataFrame, file: str, text: str, files: int, least: int = 5, most: int = 200, seed: int = 7) -> DataFrame:
    """First lines of texts from a seeded sample of files, longer than ``least``, cut at ``most``."""
    names = rows.select(file).distinct().orderBy(F.md5(F.concat_ws(":", F.lit(seed), file).cast("binary"))).limit(files)
    line = F.trim(F.split(F.trim(text), "\n")[0])
    return rows.join(names, file, "left_semi").filter(F.length(line) > least).select(file, F.substring(line, 1, most).alias("line"))


def digest(spark: SparkSession, path: str, most: int = 12_000) -> DataFrame:
    """Reference documents cut to a number of characters."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.substring("value", 1, most).alias("text"))


# Logs


def parse_log(lines: DataFrame) -> DataFrame:
    """Log lines (session, pos, json) as messages: session, pos, event_id, role, blocks, ref, tool, is_error, session_id.

    Logs of messages are taken as they are.  Logs without any are native ones:
    their last snapshot whose prompt is no heartbeat counts, else the longest,
    else their prompts alone.
    """
    e = lines.select("session", "pos", F.from_json("json", EVENT).alias("e")).filter("e IS NOT NULL")
    said = F.col("e.message.role").isin("user", "assistant", "toolResult") & (F.col("e.type") == "message")
    whole = Window.partitionBy("session")
    e = e.withColumn("standard", F.max(F.coalesce(said, F.lit(False)).cast("int")).over(whole) == 1)
    started = F.first(F.when(F.col("e.type").isin("session", "session.started"), F.coalesce("e.sessionId", "e.traceId", "e.id")), ignorenulls=True).over(whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    e = e.withColumn("session_id", F.coalesce(started, F.lit("")))
    kept = ["session", "pos", "event_id", "m", "session_id"]
    plain = e.filter(F.col("standard") & (F.col("e.type") == "message")).select("session", "pos", F.col("e.id").alias("event_id"), F.col("e.message").alias("m"), "session_id")
    done = e.filter(~F.col("standard") & (F.col("e.type") == "model.completed") & (F.size("e.data.messagesSnapshot") > 0))
    awake = ~P.is_heartbeat(F.col("e.data.finalPromptText"))
    snapshot = done.groupBy("session", "session_id").agg(F.max_by("e.data.messagesSnapshot", F.when(awake, F.col("pos"))).alias("last"), F.max_by("e.data.messagesSnapshot", F.struct(F.size("e.data.messagesSnapshot"), -F.col("pos"))).alias("longest"), F.max(awake.cast("int")).alias("_any"))
    native = snapshot.select("session", "session_id", F.posexplode(F.when(F.col("_any") == 1, F.col("last")).otherwise(F.col("longest"))).alias("pos", "m")).withColumn("event_id", F.concat(F.lit("turn-"), "pos"))
    prompt = F.coalesce("e.data.prompt", "e.data.finalPromptText", F.lit(""))
    bare = e.filter(~F.col("standard") & (F.col("e.type") == "prompt.submitted") & (prompt != "") & ~P.is_heartbeat(prompt)).join(snapshot.select("session"), "session", "left_anti")
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"), *[F.lit(None).cast(t).alias(n) for n, t in (("toolCallId", "string"), ("tool_call_id", "string"), ("toolName", "string"), ("name", "string"), ("isError", "boolean"), ("timestamp", "string"))])
    bare = bare.select("session", "pos", F.col("e.id").alias("event_id"), message.alias("m"), "session_id")
    rows = plain.select(*kept).unionByName(native.select("session", F.col("pos").cast("long").alias("pos"), "event_id", "m", "session_id")).unionByName(bare.select(*kept))
    content = F.coalesce("m.content", F.lit(""))
    one = F.array(F.struct(F.lit("text").alias("type"), content.alias("text"), *[F.lit(None).cast("string").alias(n) for n in ("thinking", "id", "name", "arguments", "input")]))
    blocks = F.when(content.startswith("["), F.from_json(content, BLOCKS)).otherwise(one)
    role = F.when(F.col("m.role") == "tool", "toolResult").otherwise(F.col("m.role"))
    return rows.select("session", "pos", "event_id", role.alias("role"), F.coalesce(blocks, one).alias("blocks"), F.coalesce("m.toolCallId", "m.tool_call_id").alias("ref"), F.coalesce("m.toolName", "m.name").alias("tool"), F.coalesce("m.isError", F.lit(False)).alias("is_error"), "session_id")


def visible_text(blocks: Column, separator: str = "") -> Column:
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), separator)


def user_messages(messages: DataFrame) -> DataFrame:
    """User texts that say something and are no heartbeat, numbered from 0."""
    rows = messages.filter("role = 'user'").select("session", "pos", visible_text(F.col("blocks")).alias("text")).filter((F.trim("text") != "") & ~P.is_heartbeat(F.col("text")))
    return rows.withColumn("number", (F.row_number().over(Window.partitionBy("session").orderBy("pos")) - 1).cast("long"))


def assistant_turns(messages: DataFrame) -> DataFrame:
    rows = messages.filter("role = 'assistant'").withColumn("turn", (F.row_number().over(Window.partitionBy("session").orderBy("pos")) - 1).cast("long"))
    thinking = F.transform(F.filter("blocks", lambda b: b["type"] == "thinking"), lambda b: F.coalesce(b["thinking"], b["text"]))
    texts = F.transform(F.filter("blocks", lambda b: b["type"] == "text"), lambda b: b["text"])
    return rows.select("session", "pos", "event_id", "turn", thinking.alias("thinking"), texts.alias("texts"), F.filter("blocks", lambda b: b["type"].isin("toolCall", "tool_use")).alias("calls"))


def tool_calls(turns: DataFrame) -> DataFrame:
    rows = turns.select("session", "turn", F.posexplode("calls").alias("place", "c"))
    return rows.select("session", "turn", "place", F.col("c.id").alias("call_id"), F.col("c.name").alias("tool"), F.coalesce("c.arguments", "c.input", F.lit("{}")).alias("arguments"))


def tool_results(messages: DataFrame) -> DataFrame:
    """Results by call id, the last of equal ones; those below ten characters are empty."""
    rows = messages.filter("role = 'toolResult'").withColumn("content", visible_text(F.col("blocks")))
    last = rows.groupBy("session", F.coalesce("ref", F.lit("")).alias("call_id")).agg(F.max_by(F.struct("tool", "content", "is_error"), "pos").alias("r"))
    return last.select("session", "call_id", "r.*", (F.length(F.trim("r.content")) < 10).alias("is_empty"))


def thread_order(messages: DataFrame) -> DataFrame:
    """The order of a session's user messages, turns and results, with their numbers or call ids."""
    users = user_messages(messages).select("session", "pos", F.lit("user").alias("kind"), F.col("number").cast("string").alias("which"))
    turns = assistant_turns(messages).select("session", "pos", F.lit("assistant").alias("kind"), F.col("turn").cast("string").alias("which"))
    results = messages.filter("role = 'toolResult'").select("session", "pos", F.lit("tool").alias("kind"), F.col("ref").alias("which"))
    return users.unionByName(turns).unionByName(results)


# Sinks


def write_training_records(reports: DataFrame, samples: DataFrame, path: str, by: str = "submission_id") -> None:
    """The samples of passed reports as JSON lines, with their source."""
    passed = reports.filter(F.col("status").isin("PASS", "MINOR_FIXED")).select(by, "status")
    kept = samples.join(passed, by)
    kept.withColumn("_source", F.struct(by, "status")).drop("status").write.mode("errorifexists").json(path)


def batch_report(reports: DataFrame) -> DataFrame:
    """Counts by status, the pass rate and how many are ready for production (passed without open gate issues)."""
    passed = F.col("status").isin("PASS", "MINOR_FIXED")
    rate = F.format_string("%.1f%%", 100.0 * F.count_if(passed) / F.greatest(F.count("*"), F.lit(1)))
    return reports.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") == "MINOR_FIXED").alias("fixed"), F.count_if(passed & (F.col("n_gate_issues") == 0)).alias("production_ready"), rate.alias("pass_rate"))


def append_completed(done: DataFrame, path: str, key: str = "submission_id") -> None:
    """Append finished keys to the table of completed ones, from which a resumed run takes its anti join."""
    done.select(key).distinct().write.mode("append").parquet(path)


def latest_by_id(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """An upsert by id: new rows win over old ones."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return R.last_wins(both, [key], [F.desc("_new")]).drop("_new")


def session_header(sessions: DataFrame, key: str) -> DataFrame:
    """The rows that open a session's stream, before its first one: session, model, level of thinking, snapshot of the settings."""
    kinds = F.array(*[F.struct(F.lit(i - 4).alias("pos"), F.lit(k).alias("type")) for i, k in enumerate(("session", "model_change", "thinking_level_change", "custom"))])
    return sessions.select(key, F.inline(kinds)).withColumn("is_synthetic", F.lit(True))


def remap_ids(rows: DataFrame, by: list[str], columns: tuple[str, ...] = ("id", "parent", "call_id", "ref"), size: int = 24) -> DataFrame:
    """Ids replaced by digests of the stream's key and the id, so that references stay right; the old ids stay beside them."""
    new = lambda c: F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.substring(F.sha2(F.concat_ws(":", *by, c), 256), 1, size)).otherwise(F.col(c))
    return rows.withColumns({f"source_{c}": F.col(c) for c in columns}).withColumns({c: new(c) for c in columns})


def is_construction_key(key: Column) -> Column:
    return key.isin("is_adversarial", "attack_type", "is_synthetic", "_synthetic")


def safe_lines(content: Column) -> Column:
    """The lines of a memory text that say what is left out."""
    return F.filter(F.split(content, "\n"), lambda line: P.is_safe_memory_line(line) | line.contains(T.REDACTION_TOKEN))
