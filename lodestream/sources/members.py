"""Members of zip archives as a data source that streams them in parts, and whole bundles of a submission as folders.

``ZipMembers`` opens archives where they lie on a file system that all machines
mount; nothing but a part of one member is held.  For stores that only Spark
reads there is ``read_parts``, which takes an archive's packed bytes from Spark.
"""

from __future__ import annotations

import io
import os
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What reading a broken or encrypted member can raise.
BROKEN = (zipfile.BadZipFile, zlib.error, OSError, EOFError, RuntimeError, NotImplementedError)
PARTS = "archive string, name string, size long, part int, content binary, error string"


def _parts_of(where: str, opened, part_bytes: int, mine=lambda i: True) -> Iterator[tuple]:  # noqa: ANN001
    """The parts of an archive's members (those whose place is ``mine``); one row of the error if it is broken.

    An empty member gives one empty part.  A member that breaks off gives the
    parts before and then a row with the error.
    """
    try:
        archive = zipfile.ZipFile(opened)
    except BROKEN as e:
        if mine(0):
            yield where, None, None, None, None, str(e)
        return
    with archive:
        for i, member in enumerate(archive.infolist()):
            if member.is_dir() or not mine(i):
                continue
            number = 0
            try:
                with archive.open(member) as stream:
                    while (held := stream.read(part_bytes)) or not number:
                        yield where, member.filename, member.file_size, number, held, None
                        number += 1
            except BROKEN as e:
                yield where, member.filename, member.file_size, None, None, str(e)


@dataclass
class Slice(InputPartition):
    archive: str
    number: int
    of: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.part_bytes, self.slices = options["path"], int(options.get("part_bytes", 8 << 20)), int(options.get("slices", 4))

    def partitions(self) -> list[Slice]:
        root = self.path.removeprefix("file://")
        found = [root] if os.path.isfile(root) else sorted(os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".zip"))
        return [Slice(a, k, self.slices) for a in found for k in range(self.slices)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        yield from _parts_of(partition.archive, partition.archive, self.part_bytes, lambda i: i % partition.of == partition.number)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").load(folder)``: archive, name, size, part, content, error.

    Options: part_bytes (of a row's content at most), slices (tasks that share an
    archive's members).  Only names of files are read on the driver.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return PARTS

    def reader(self, schema) -> _Reader:  # noqa: ANN001
        return _Reader(dict(self.options))


def read_parts(spark: SparkSession, path: str, part_bytes: int = 8 << 20) -> DataFrame:
    """The same rows by Spark's own file readers: the packed bytes of one archive are held, its members never whole."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for where, packed in (row for f in frames for row in zip(f["path"], f["content"], strict=True)):
            for row in _parts_of(where, io.BytesIO(packed), part_bytes):
                yield pd.DataFrame([row], columns=["archive", "name", "size", "part", "content", "error"]).astype({"size": "Int64", "part": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(unpack, PARTS)


def whole_members(parts: DataFrame, largest: int = 1 << 28) -> DataFrame:
    """archive, name, size, content, error: one row per member; above ``largest`` bytes content is null and error says so.

    Larger members stay readable in their parts.  Broken archives have a row of their own.
    """
    told = parts.groupBy("archive", "name").agg(F.max("size").alias("size"), F.max("error").alias("error"))
    fit = parts.filter((F.col("size") <= largest) & F.col("error").isNull()).groupBy("archive", "name").agg(F.array_sort(F.collect_list(F.struct("part", "content"))).alias("_parts"))
    joined = F.aggregate("_parts", F.lit(b""), lambda all_, p: F.concat(all_, p["content"]))
    large = F.when(F.col("size") > largest, F.format_string("larger than %s bytes", F.lit(str(largest))))
    out = told.join(fit, ["archive", "name"], "left").withColumn("error", F.coalesce("error", large))
    return out.select("archive", "name", "size", F.when(F.col("error").isNull(), joined).alias("content"), "error")
