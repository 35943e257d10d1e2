"""Retrieval over collections of vectors: an inverted file of cells, filters on metadata, upserts of single cells.

Cells are fitted on a bounded sample; every row is in the index.  A query looks
at the cells whose centres are nearest to it; where filters leave it fewer rows than it
asks for, it looks at all cells.  A cell is cut into slices of bounded
size, so neither a crowded cell nor many equal vectors make a task large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Rows of a slice; a task holds one slice and one batch of queries.
SLICE_ROWS = 8192


@dataclass(frozen=True)
class Cells:
    """Centres of the cells, unit vectors, one a row."""

    centres: np.ndarray

    def nearest(self, vectors: np.ndarray, n: int) -> np.ndarray:
        n = min(n, len(self.centres))
        return np.argsort(-(unit(vectors) @ self.centres.T), 1, kind="stable")[:, :n]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null, empty or zero and holds finite numbers only, as array<double>."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.withColumn(vector, F.col(vector).cast("array<double>")).filter(F.col(vector).isNotNull() & ~odd & F.exists(vector, lambda c: c != 0))


def fit_cells(rows: DataFrame, vector: str, key: str, cells: int = 64, sample_rows: int = 20_000, rounds: int = 12) -> Cells | None:
    """Spherical k-means on at most ``sample_rows`` rows, those of smallest hash; None without rows.  All vectors have one length."""
    taken = usable(rows, vector).select(vector, key).orderBy(F.xxhash64(key), key).limit(sample_rows).select(vector).toPandas()[vector]
    if not len(taken):
        return None
    points = unit(np.array(taken.tolist()))
    centres = points[:: max(1, len(points) // cells)][:cells].copy()
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, 1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = points[own == c].mean(0)
        centres = unit(centres)
    return Cells(centres)


def _assigned(rows: DataFrame, vector: str, cells: Cells, n: int) -> DataFrame:
    """``rows`` with ``cell``, once for each of the ``n`` nearest cells."""
    schema = StructType([*rows.schema.fields, StructField("cell", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = cells.nearest(_matrix(batch.column(vector)), n)
                at = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
                yield batch.take(at).append_column("cell", pa.array(near.ravel().astype(np.int32)))

    return rows.mapInArrow(run, schema)


def index(rows: DataFrame, vector: str, cells: Cells) -> DataFrame:
    """``rows`` with the cell that each lies in; rows without a usable vector have no place in it."""
    return _assigned(usable(rows, vector), vector, cells, 1)


def write_index(indexed: DataFrame, path: str) -> None:
    """The index as a table in a folder for each cell; only the cells at hand are written anew."""
    indexed.repartition("cell").write.partitionBy("cell").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def upsert(spark: SparkSession, path: str, rows: DataFrame, key: str, vector: str, cells: Cells, checkpoint: Callable[[DataFrame], DataFrame]) -> None:
    """Put rows into an index by id: new ones win over old ones, also where they lie in another cell.

    The cells that the new rows come to or leave are read and written, all others stay as they are.
    """
    old = spark.read.parquet(path)
    new = checkpoint(index(rows, vector, cells).select(*old.columns))
    leaving = old.select(key, "cell").join(rows.select(key).distinct(), key, "left_semi").select("cell")
    touched = [r["cell"] for r in new.select("cell").union(leaving).distinct().collect()]  # no more than there are cells
    kept = old.filter(F.col("cell").isin(touched)).join(rows.select(key).distinct(), key, "left_anti")
    fresh = checkpoint(kept.select(*old.columns).unionByName(new))
    write_index(fresh, path)
    emptied = set(touched) - {r["cell"] for r in fresh.select("cell").distinct().collect()}
    for cell in emptied:  # a cell that all its rows left keeps a folder without rows
        fresh.sparkSession.createDataFrame([], fresh.drop("cell").schema).write.mode("overwrite").parquet(f"{path}/cell={cell}")


def matching(rows: DataFrame, equals: dict[str, object] | None = None, contains: dict[str, str] | None = None) -> DataFrame:
    """Rows whose columns equal values and contain texts; both reach the reader of the index."""
    for column, value in (equals or {}).items():
        rows = rows.filter(F.col(column) == value)
    for column, text in (contains or {}).items():
        rows = rows.filter(F.col(column).contains(text))
    return rows


def search(indexed: DataFrame, queries: DataFrame, key: str, vector: str, cells: Cells, k: int, probe: int = 8, match: str | None = None) -> DataFrame:
    """query_id, rank, key, score: of each query the ``k`` rows of highest cosine that its cells hold, ties to the smaller key.

    ``queries`` has query_id (long), the vector and, if rows must agree with
    their query in it, the column ``match``.  A query's own id is no result.  Queries with fewer
    than ``k`` results look at all cells.
    """
    sizes = indexed.groupBy("cell").count().collect()  # as many rows as cells
    slices = {r["cell"]: -(-r["count"] // SLICE_ROWS) for r in sizes}
    if not slices:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, key long, score double").withColumnRenamed("key", key)
    table = F.create_map(*[F.lit(x) for item in slices.items() for x in item])
    label = F.col(match).cast("string") if match else F.lit(None).cast("string")
    held = indexed.select("cell", F.pmod(F.xxhash64(key), table[F.col("cell")]).cast("int").alias("slice"), F.lit(0).alias("kind"), F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), label.alias("label"))
    asked = usable(queries, vector).select(F.col("query_id").cast("long").alias("id"), F.col(vector).alias("vector"), label.alias("label"))

    def look(some: DataFrame, n: int) -> DataFrame:
        spread = _assigned(some, "vector", cells, n).filter(F.col("cell").isin(*slices)).withColumn("slice", F.explode(F.sequence(F.lit(0), table[F.col("cell")] - 1)))
        both = held.unionByName(spread.select("cell", "slice", F.lit(1).alias("kind"), "id", "vector", "label"))
        return both.repartition("cell", "slice").sortWithinPartitions("cell", "slice", "kind", "id").mapInArrow(_scan(k), "query_id long, id long, score double")

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    first = best(look(asked, probe))
    full = first.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = asked.join(full, "id", "left_anti")
    rest = best(look(short, len(cells.centres)))
    done = first.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(rest)
    return done.select("query_id", "rank", F.col("id").alias(key), "score")


def _scan(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For a task's slices in order: hold a slice's rows, then answer its queries batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, labels = None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part, kind = (np.array(batch.column(c)) for c in ("cell", "slice", "kind"))
            edges = np.flatnonzero(np.concatenate(([True], (np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0), [True])))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                rows = batch.slice(a, b - a)
                if at != (cell[a], part[a]):
                    at, ids, vectors, labels = (cell[a], part[a]), [], [], []
                if kind[a] == 0:
                    ids.append(np.array(rows.column("id")))
                    vectors.append(unit(_matrix(rows.column("vector"))))
                    labels += rows.column("label").to_pylist()
                elif ids:
                    own, q = np.array(rows.column("id")), unit(_matrix(rows.column("vector")))
                    there = np.concatenate(ids)
                    score = q @ np.concatenate(vectors).T
                    score[own[:, None] == there] = -np.inf
                    wanted = rows.column("label").to_pylist()
                    if any(w is not None for w in wanted):
                        score[np.array(wanted, object)[:, None] != np.array(labels, object)] = -np.inf
                    best = np.lexsort((np.broadcast_to(there, score.shape), -score), 1)[:, :k]
                    top = np.take_along_axis(score, best, 1)
                    i, j = np.nonzero(np.isfinite(top))
                    yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(there[best[i, j]]), pa.array(top[i, j])], names=["query_id", "id", "score"])

    return run
