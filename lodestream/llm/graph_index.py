"""Nearest neighbours by inner product from robust-pruned directed graphs, one a shard.

Distinct vectors are dealt to shards by their hash; a shard holds a bounded
number of bytes, so its graph fits a task.  A shard's vectors become unit vectors
of one dimension more, under which the largest inner product is the smallest
angle.  The graph is built in batches: greedy searches propose neighbours, and of
those the relaxed distance rule keeps a diverse few.  Every query then searches
every shard with a beam; the shards' finds are scored in double precision on the
vectors as given, and the best of all shards are kept.

Copies of a vector are one node with its smallest ids, one more than a query
returns; no other id of a copy can be among the results, as ties go to the
smaller id.  The graph's degree and the beam are parameters of an approximate
index; every row is in it.

Edge cases: rows that ``whole_vectors`` drops, zero vectors and rows without id
take no part.  Repeated rows with one id and vector count once; rows that share
an id only are all candidates, none for a query of their own id, and each is a
query of its own.  A query gets all candidates that were found, if fewer than ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm._common import as_table
from lodestream.llm.vectors import matrix, whole_vectors

#: Bytes of visited marks and of gathered vectors that a search holds at once.
VISITED_BYTES, GATHERED_BYTES = 16 << 20, 24 << 20


class PrunedGraph:
    """A directed graph over the rows of ``points`` (not zero), for searches by inner product."""

    def __init__(self, points: np.ndarray, degree: int = 48, width: int = 64, relax: float = 1.2):
        self.points, self.degree, self.relax = points, degree, relax**2
        norms = np.linalg.norm(points / np.abs(points).max(), axis=1)
        unit = points / np.abs(points).max() / norms.max()
        lift = np.sqrt(np.maximum(0, 1 - (norms / norms.max()) ** 2))
        self.unit = np.concatenate((unit, lift[:, None]), 1).astype(np.float32)
        n = len(points)
        self.next = np.full((n, degree), -1, np.int32)
        self.start = int(np.argmax(self.unit @ self.unit.mean(0)))
        order = np.concatenate(([self.start], np.delete(np.arange(n), self.start)))
        done = 1
        while done < n:  # as many again as there are, so that a batch finds enough
            self._insert(order[done : done + min(done, 4096)], width, 1.0)
            done += min(done, 4096)
        for at in range(0, n, size := max(1, min(4096, -(-n // 8)))):
            self._insert(order[at : at + size], width, self.relax)

    def _insert(self, batch: np.ndarray, width: int, relax: float) -> None:
        found, _ = self.search(self.unit[batch], width)
        near = np.concatenate((found, self.next[batch]), 1)
        near[near == batch[:, None]] = -1
        self.next[batch] = self._prune(batch, near, relax)
        self._link_back(batch, relax)

    def _link_back(self, batch: np.ndarray, relax: float) -> None:
        """The batch's new edges the other way round; nodes with too many are pruned again."""
        ends = self.next[batch].ravel()
        heads = np.repeat(batch, self.degree)[ends >= 0]
        ends = ends[ends >= 0]
        if not len(ends):
            return
        apart = 1 - np.einsum("ij,ij->i", self.unit[ends], self.unit[heads])
        order = np.lexsort((heads, apart, ends))
        ends, heads = ends[order], heads[order]
        nodes, first, count = np.unique(ends, return_index=True, return_counts=True)
        place = np.arange(len(ends)) - np.repeat(first, count)
        kept = place < 2 * self.degree  # the nearest of those that point here
        more = np.full((len(nodes), 2 * self.degree), -1, np.int32)
        more[np.repeat(np.arange(len(nodes)), count)[kept], place[kept]] = heads[kept]
        self.next[nodes] = self._prune(nodes, np.concatenate((self.next[nodes], more), 1), relax)

    def _prune(self, nodes: np.ndarray, near: np.ndarray, relax: float) -> np.ndarray:
        """Of each node's candidates (-1: none) the nearest, again and again, without those that a kept one is nearer to."""
        out = np.full((len(nodes), self.degree), -1, np.int32)
        wide = near.shape[1]
        block = max(1, GATHERED_BYTES // (4 * wide * (wide + self.unit.shape[1])))
        for at in range(0, len(nodes), block):
            ids, rows = near[at : at + block], np.arange(min(block, len(nodes) - at))
            ids = np.sort(ids, 1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            there = self.unit[ids]
            apart = np.where(ids < 0, np.inf, 1 - np.einsum("bcd,bd->bc", there, self.unit[nodes[at : at + block]]))
            between = 1 - there @ there.transpose(0, 2, 1)
            alive = apart.copy()
            for k in range(self.degree):
                best = alive.argmin(1)
                live = np.isfinite(alive[rows, best])
                if not live.any():
                    break
                out[at + rows[live], k] = ids[rows[live], best[live]]
                alive[relax * between[rows, best] <= apart] = np.inf
                alive[rows, best] = np.inf
        return out

    def search(self, queries: np.ndarray, width: int, hops: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Of each query (a row of lifted unit vectors) the ``width`` nearest nodes that a beam finds, -1 where fewer, and how far.

        A step opens the ``hops`` nearest unopened nodes of each query's beam.
        """
        n, d = self.unit.shape
        nodes, away = np.full((len(queries), width), -1, np.int32), np.full((len(queries), width), np.inf, np.float32)
        block = max(1, min(VISITED_BYTES // n, GATHERED_BYTES // (4 * d * hops * self.degree)))
        for at in range(0, len(queries), block):
            q = queries[at : at + block]
            ids, dist = nodes[at : at + block], away[at : at + block]
            seen, opened = np.zeros((len(q), n), bool), np.ones((len(q), width), bool)
            ids[:, 0], dist[:, 0], opened[:, 0], seen[:, self.start] = self.start, 1 - q @ self.unit[self.start], False, True
            live = np.arange(len(q))
            while len(live):
                turn = np.cumsum(~opened[live], 1)
                now = ~opened[live] & (turn <= hops)
                row, col = np.nonzero(now)
                step = self.next[ids[live][row, col]]
                opened[live[row], col] = True
                reached = np.full((len(live), hops * self.degree), -1, np.int32)
                place = (turn[row, col] - 1)[:, None] * self.degree + np.arange(self.degree)
                reached[row[:, None], place] = step
                reached = np.sort(reached, 1)
                old = (reached < 0) | seen[live[:, None], reached]
                old[:, 1:] |= reached[:, 1:] == reached[:, :-1]
                seen[live[:, None], np.where(reached < 0, self.start, reached)] = True
                far = 1 - np.matmul(self.unit[reached], q[live][:, :, None])[:, :, 0]
                far[old] = np.inf
                both = np.concatenate((dist[live], far), 1)
                best = np.argsort(both, 1, kind="stable")[:, :width]
                pick = lambda x, y: np.take_along_axis(np.concatenate((x, y), 1), best, 1)  # noqa: E731, B023
                dist[live], ids[live] = np.take_along_axis(both, best, 1), pick(ids[live], reached)
                opened[live] = pick(opened[live], old)
                live = live[~opened[live].all(1)]
        nodes[np.isinf(away)] = -1
        return nodes, away

    def nearest(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes found for each query (rows as long as the points) and inner products in double precision (-inf: none)."""
        scale = np.abs(queries).max(1, keepdims=True)
        lifted = np.concatenate((queries / scale, np.zeros((len(queries), 1))), 1)
        lifted /= np.linalg.norm(lifted, axis=1, keepdims=True)
        nodes, _ = self.search(lifted.astype(np.float32), width)
        score = np.einsum("qcd,qd->qc", self.points[nodes], queries)
        score[nodes < 0] = -np.inf
        return nodes, score


def _best(query_ids: np.ndarray, nodes: np.ndarray, score: np.ndarray, first: np.ndarray, copies: np.ndarray, ids: np.ndarray, k: int):
    """Rows (query, id, score) of the ``k`` best ids of each query; node v has the ids ids[first[v]:first[v] + copies[v]]."""
    q, c = np.nonzero(nodes >= 0)
    v, s = nodes[q, c], score[q, c]
    many = copies[v]
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    q, s, found = np.repeat(q, many), np.repeat(s, many), ids[np.repeat(first[v], many) + offset]
    other = found != query_ids[q]
    q, s, found = q[other], s[other], found[other]
    order = np.lexsort((found, -s, q))
    q, s, found = q[order], s[order], found[order]
    start = np.searchsorted(q, np.arange(len(query_ids)))
    kept = np.arange(len(q)) - start[q] < k
    return q[kept], found[kept], s[kept]


def distinct_vectors(whole: DataFrame, ids: int, salts: int = 64) -> DataFrame:
    """vector (bytes of doubles) and its ``ids`` smallest ids, ascending; copies are thinned in the task, then by salt."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            rows = matrix(batch.column(1)) + 0.0  # -0.0 is 0.0
            for i, row in zip(batch.column(0).to_pylist(), rows, strict=True):
                held.setdefault(row.tobytes(), []).append(i)
            if held:
                least = [sorted(set(v))[:ids] for v in held.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(least, pa.list_(pa.int64()))], names=["vector", "ids"])

    def smallest(found: Column) -> Column:
        return F.slice(F.sort_array(F.array_distinct(F.flatten(found))), 1, ids)

    thinned = whole.select("id", "vector").mapInArrow(thin, "vector binary, ids array<long>").withColumn("salt", F.spark_partition_id() % salts)
    salted = thinned.groupBy("vector", "salt").agg(smallest(F.collect_list("ids")).alias("ids"))
    return salted.groupBy("vector").agg(smallest(F.collect_list("ids")).alias("ids"))


def distinct_rows(whole: DataFrame) -> DataFrame:
    """Distinct rows of id and vector, the vector as bytes of doubles."""

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1)) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "vector"])

    return whole.select("id", "vector").mapInArrow(as_bytes, "id long, vector binary").distinct()


def nearest_neighbours(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    degree: int = 48,
    width: int = 64,
    beam: int = 192,
    least_shards: int = 8,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """query_id, rank (from 1), the id, and score of the ``k`` nearest that were found for each query.

    ``is_query`` is a condition on the column ``id``.  There are at least
    ``least_shards`` shards, and as many as keep the vectors of one (as doubles)
    within ``shard_bytes``.  Queries go to every shard in batches.
    """
    whole = whole_vectors(df.where(F.col(id_col).isNotNull()), id_col, vector_col)
    whole = whole.where(F.exists("vector", lambda c: c != 0))
    nodes = as_table(distinct_vectors(whole, k + 1))
    size = nodes.agg(F.count("*").alias("n"), F.max(F.octet_length("vector")).alias("b")).first()
    shards = max(least_shards, -(-size["n"] * (size["b"] or 0) // shard_bytes))
    order = F.xxhash64("vector")
    shard = F.pmod(order, F.lit(shards)).cast("int").alias("shard")
    held = nodes.select(shard, F.lit(0).alias("kind"), order.alias("key"), F.lit(None).cast("long").alias("id"), "vector", "ids")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = distinct_rows(whole.where(is_query)).select(every, F.lit(1).alias("kind"), order.alias("key"), "id", "vector", F.lit(None).cast("array<long>").alias("ids"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, ids, graph, first, copies = [], [], None, None, None
        for batch in batches:
            is_node = np.array(batch.column("kind")) == 0
            if is_node.any():
                part = batch.filter(pa.array(is_node))
                points.append(np.frombuffer(b"".join(part.column("vector").to_pylist())))
                ids += part.column("ids").to_pylist()
            if is_node.all() or not points:
                continue
            part = batch.filter(pa.array(~is_node))
            queries = np.frombuffer(b"".join(part.column("vector").to_pylist())).reshape(part.num_rows, -1)
            if graph is None:
                graph = PrunedGraph(np.concatenate(points).reshape(len(ids), -1), degree, width)
                copies = np.array([len(v) for v in ids])
                first, ids_of = np.cumsum(copies) - copies, np.array([i for v in ids for i in v], np.int64)
            step = max(1, GATHERED_BYTES // (8 * beam * queries.shape[1]))
            for at in range(0, len(queries), step):
                own = part.column("id").to_numpy()[at : at + step]
                found, score = graph.nearest(queries[at : at + step], beam)
                q, i, s = _best(own, found, score, first, copies, ids_of, k)
                key = part.column("key").to_numpy()[at : at + step]
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(key[q]), pa.array(i), pa.array(s)], names=["query_id", "key", "found", "score"])

    dealt = held.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("kind", "key", "vector", "id")
    found = dealt.mapInArrow(search, "query_id long, key long, found long, score double")
    w = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "found")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("found").alias(id_col.strip("`")), "score")
