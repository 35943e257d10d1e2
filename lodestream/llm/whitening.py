"""Whitened embeddings by a one-sided Jacobi SVD of a blockwise TSQR.

Entries are first fixed to a grid: c becomes x = floor(1024 c) + 100000, a long.
Sums of x are exact.  Each task centres its rows and folds them, block by block,
into one triangular R; the tasks' R are folded in a tree of groups of bounded
size.  V = R'R / n is the covariance of x, and plane rotations that make R's
columns orthogonal give its components and deviations without forming V.

What goes through the driver is of the size of one R (dimension squared).

Edge cases: rows that ``whole_vectors`` drops take no part and give no rows; rows
with equal ids, and rows without id, are rows like any other; an empty table
gives no rows.  Entries beyond 2**40 / 1024 count as that.  A component without
variance (fewer rows than dimensions, equal vectors) has null as its whitened
value and is left out of ``identity_error``; where no component has any,
``explained`` and ``identity_error`` are null.  ``deviation`` is null where the
exact number does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.vectors import matrix, whole_vectors

SCALE, SHIFT, LIMIT = 1024, 100_000, 2.0**40
#: So many R are folded into one by a task.
FAN_IN = 16


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # one a column
    deviations: np.ndarray  # square roots of the eigenvalues, zero where nothing varies
    trace: float

    def centred(self, grid: np.ndarray) -> np.ndarray:
        """x - S / n, the whole part of the mean taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (grid - whole) - rest

    def whitened(self, grid: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.deviations > 0, self.centred(grid) @ self.components / self.deviations, np.nan)


def to_grid(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vectors), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors of ``r`` by rotations of pairs of its columns.

    The pairs of a sweep follow a round robin, so that half as many pairs as
    columns are rotated at once.
    """
    a, d = r.astype(float), r.shape[1]
    v, least = np.eye(d), 4 * np.finfo(float).eps
    ring = np.arange(d + d % 2)
    half = len(ring) // 2
    for _ in range(sweeps if d > 1 else 0):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = ring[:half], ring[: half - 1 : -1]
            real = (p < d) & (q < d)
            p, q = p[real], q[real]
            ap, aq = a[:, p], a[:, q]
            alpha, beta, gamma = (ap * ap).sum(0), (aq * aq).sum(0), (ap * aq).sum(0)
            size = np.sqrt(alpha) * np.sqrt(beta)
            turn = np.abs(gamma) > least * size
            if turn.any():
                worst = max(worst, float(np.max(np.abs(gamma[turn]) / size[turn])))
                safe = np.where(turn, gamma, 1.0)
                zeta = (beta - alpha) / (2 * safe)
                t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
                c = 1 / np.hypot(1, t)
                s = c * t
                a[:, p], a[:, q] = c * ap - s * aq, s * ap + c * aq
                vp, vq = v[:, p], v[:, q]
                v[:, p], v[:, q] = c * vp - s * vq, s * vp + c * vq
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if worst <= least:
            break
    sizes = np.sqrt((a * a).sum(0))
    order = np.argsort(-sizes, kind="stable")
    return sizes[order], v[:, order]


def _summed(parts: DataFrame) -> list:
    """Element-wise sums of the arrays ``values``; the result is as long as one array."""
    each = parts.select(F.posexplode("values").alias("at", "value"))
    return [r["total"] for r in each.groupBy("at").agg(F.sum("value").alias("total")).orderBy("at").collect()]


def fit_whitening(whole: DataFrame, count: int = 8) -> Whitening | None:
    """Fit to all rows of ``whole`` (see ``whole_vectors``); None if there are none."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                grid = to_grid(matrix(batch.column(0)))
                yield pa.RecordBatch.from_pydict({"values": pa.array([[len(grid), *grid.sum(0).tolist()]], pa.list_(pa.int64()))})

    vectors = whole.select("vector")
    sums = _summed(vectors.mapInArrow(add, "values array<long>").select(F.col("values").cast("array<decimal(38,0)>").alias("values")))
    if not sums:
        return None
    n, *sums = map(int, sums)
    frame = Whitening(n, tuple(sums), np.zeros((0, 0)), np.zeros(0), 0.0)
    d = len(sums)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            if batch.num_rows:
                r = np.linalg.qr(np.concatenate((r, frame.centred(to_grid(matrix(batch.column(0)))))), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"block": pa.array([TaskContext.get().partitionId()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        stacked = np.concatenate([np.frombuffer(r).reshape(-1, d) for r in group.sort_values("block")["r"]])
        return pd.DataFrame({"block": [group["block"].iloc[0] // FAN_IN], "r": [np.linalg.qr(stacked, mode="r").tobytes()]})

    blocks, left = vectors.mapInArrow(compress, "block long, r binary"), vectors.rdd.getNumPartitions()
    while left > 1:
        blocks = blocks.groupBy(F.floor(F.col("block") / FAN_IN)).applyInPandas(fold, "block long, r binary")
        left = -(-left // FAN_IN)
    r = np.frombuffer(blocks.first()["r"]).reshape(-1, d)
    r = np.concatenate((r, np.zeros((max(0, d - len(r)), d))))
    sizes, components = jacobi(r)
    sizes = np.where(sizes > 4 * d * np.finfo(float).eps * sizes[0], sizes, 0.0)
    return Whitening(n, tuple(sums), components[:, :count], sizes[:count] / np.sqrt(n), float((sizes**2).sum() / n))


def identity_error(whole: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened values minus the identity."""
    live = int((model.deviations > 0).sum())
    if not live:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(to_grid(matrix(batch.column(0))))[:, :live]
                yield pa.RecordBatch.from_pydict({"values": pa.array([[*w.sum(0), *(w.T @ w).ravel()]], pa.list_(pa.float64()))})

    sums = np.array(_summed(whole.select("vector").mapInArrow(products, "values array<double>"))) / model.n
    mean = sums[:live]  # all but zero, as the rows are centred
    return float(np.abs(sums[live:].reshape(live, live) - np.outer(mean, mean) - np.eye(live)).max())


def deviations_of(grid: np.ndarray, model: Whitening) -> list[int | None]:
    """Per row the exact sum over dimensions of (n x - S)**2."""
    sums = np.array(model.sums, object)
    reach = max(abs(int(grid.max()) * model.n), abs(int(grid.min()) * model.n), *(abs(s) for s in model.sums))
    if reach < 2**62:
        apart = grid * model.n - np.array(model.sums, np.int64)
        if int(np.abs(apart).max()) ** 2 * len(model.sums) < 2**63:
            return (apart * apart).sum(1).tolist()
    exact = ((grid.astype(object) * model.n - sums) ** 2).sum(1)
    return [int(v) if v < 2**63 else None for v in exact]


def whiten_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 8) -> DataFrame:
    """The id, component (from 1), n, deviation, whitened, explained and identity_error of every row that takes part."""
    whole = whole_vectors(df, id_col, vector_col)
    schema = f"id {whole.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit_whitening(whole, count)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col.strip("`"))
    error, k = identity_error(whole, model), len(model.deviations)
    explained = [float(v * v / model.trace) if model.trace else None for v in model.deviations]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if rows:
                grid = to_grid(matrix(batch.column(1)))
                at = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, model.n)),
                        pa.array(deviations_of(grid, model), pa.int64()).take(pa.array(at)),
                        pa.array(model.whitened(grid).ravel(), from_pandas=True),
                        pa.array(explained * rows, pa.float64()),
                        pa.array([error] * (rows * k), pa.float64()),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whole.select("id", "vector").mapInArrow(spread, schema).withColumnRenamed("id", id_col.strip("`"))
