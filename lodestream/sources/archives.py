"""Sources and sinks of recorded sessions: manifests, zipped event logs, JSON lines."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.sources.members import BROKEN

MANIFEST = "worker_id string, submission_id string, task_id string, export_url string"
LINES = "path string, entry string, line long, json string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV manifest (with a header) that name an export; columns that the files lack are null."""
    found = spark.read.option("header", True).csv(path)
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    rows = found.select(*[F.col(n) if n in found.columns else F.lit(None).cast("string").alias(n) for n in names])
    return rows.filter(F.trim(F.coalesce("export_url", F.lit(""))) != "")


def object_path(url: str) -> Column:
    """The decoded object path of a download address (what stands between ``/o/`` and the query), or the address itself."""
    coded = F.split_part(F.split_part(F.col(url), F.lit("/o/"), F.lit(2)), F.lit("?"), F.lit(1))
    return F.when(F.contains(F.col(url), F.lit("/o/")), F.url_decode(coded)).otherwise(F.regexp_replace(url, "^file://", ""))


def read_event_lines(spark: SparkSession, path: str, suffix: str = ".jsonl", batch: int = 2000) -> DataFrame:
    """The non-empty lines of every entry ``*suffix`` of every zip archive under ``path``, numbered from 1.

    Archives are spread over tasks; a task unpacks one entry as a stream, in
    batches of ``batch`` lines, so only the packed bytes of one archive are held.
    A file that is not a zip archive gives one row of null entry, line and json;
    an entry that breaks off gives its lines before and then a row of null line and json.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, content in (row for f in frames for row in zip(f["path"], f["content"])):
            try:
                archive = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile:
                yield pd.DataFrame({"path": [path], "entry": [None], "line": [None], "json": [None]}).astype({"line": "Int64"})
                continue
            for entry in sorted(n for n in archive.namelist() if n.endswith(suffix)):
                held = []
                try:
                    with archive.open(entry) as lines:
                        for n, line in enumerate(io.TextIOWrapper(lines, "utf-8", "replace", newline="\n"), 1):
                            if line.strip():
                                held.append((path, entry, n, line.rstrip("\r\n")))
                            if len(held) == batch:
                                yield pd.DataFrame(held, columns=["path", "entry", "line", "json"]).astype({"line": "Int64"})
                                held = []
                except BROKEN:
                    held.append((path, entry, None, None))
                if held:
                    yield pd.DataFrame(held, columns=["path", "entry", "line", "json"]).astype({"line": "Int64"})

    packed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return packed.select("path", "content").mapInPandas(unpack, LINES)


def parse_events(lines: DataFrame) -> DataFrame:
    """Event lines with their common fields; lines that are no JSON object have ``is_object`` false and null fields."""
    v = F.try_parse_json("json")
    field = lambda p: F.try_variant_get(v, p, "string")
    return lines.select("*", F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)).alias("is_object"), field("$.id").alias("id"), field("$.parentId").alias("parent_id"), field("$.type").alias("type"), field("$.timestamp").alias("ts"), field("$.message.role").alias("role"))


def write_json_lines(df: DataFrame, path: str, by: list[str]) -> None:
    """JSON lines in one folder per value of ``by``; nulls keep their fields."""
    df.write.partitionBy(*by).option("ignoreNullFields", False).mode("errorifexists").json(path)
