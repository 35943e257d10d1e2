"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words in the word-based operators (fixed value).
WORD_BREAK = r"[\x20\x09-\x0D]+"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``; only where that is
    unset (unit tests) a temporary folder of this machine is used.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)


def as_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder, so that later steps read only the columns they need."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        cut_lineage(df.limit(0))
    path = f"{sc.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(text: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def beside(small: DataFrame, rows: int = 200_000) -> DataFrame:
    """``small`` marked for broadcast if it is counted to have at most that many rows; else it is joined by a shuffle."""
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def row_key(doc_id: str | Column, text: str | Column) -> Column:
    """A 64-bit key of a row beside its id: equal for repeated rows, different for rows that share an id only.

    It is joined on together with the id, so only rows of one id could collide.
    """
    return F.xxhash64(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("<null>")), text_of(text))


def slices(batch: pa.RecordBatch, text_column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows that hold about ``limit`` bytes of text each (a longer row stands alone)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_text(batches: Iterable[pa.RecordBatch], limit: int, work, text_column: int = 1) -> Iterator[pa.RecordBatch]:
    """Apply ``work(slice) -> RecordBatch | None`` to bounded slices of every batch."""
    for batch in batches:
        for part in slices(batch, text_column, limit):
            out = work(part)
            if out is not None and out.num_rows:
                yield out
