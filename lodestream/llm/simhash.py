"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints are 64-bit SimHashes of 3-word shingles.  Each distinct
fingerprint is cut into three segments of 22, 21 and 21 bits, read as words of
23 bits.  The binary Golay code of length 23 is perfect: every word is within 3
bits of one codeword.  The index side stores that codeword's 12-bit index; the
query side looks up all codewords within 4 bits, which are one or six.  Two
words that differ in at most one bit then always meet.  Of at most three wrong
bits, two of the three segments have at most one each (pigeonhole), so the join
key is a pair of segments: 24 bits of index, three pairs.  Joined fingerprints
are verified by their distance.

Exact copies collapse to one fingerprint before the search.  Buckets are
worked through in sorted order inside tasks; in each, a search that visits every fingerprint
once emits a spanning forest of its links, so dense groups yield as many edges
as members.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import cut_lineage, map_text, row_key, text_of
from lodestream.llm.components import connected_components

SLICE_BYTES = 4 << 20
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))


def fingerprint(text: str, seed: int = 42) -> int:
    """The SimHash of a text's 3-word shingles, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    n = max(len(words) - 2, 1)
    joined, stops = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts, ends = [0, *stops[: n - 1].tolist()], (stops[2:] - 1).tolist() if len(words) > 2 else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, -(-n // 65536)):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def add_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp`` (the fingerprint's bits as a signed long) of every row."""
    return _keyed_fingerprints(df, id_col, text_col).select("doc_id", "fp")


def _keyed_fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ``key`` (of id and text) and ``fp`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(x) for x in part.column(1).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "key", "fp"])

        yield from map_text(batches, SLICE_BYTES, work)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("key", row_key("doc_id", "text"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome (11 bits): the error pattern within 3 bits, and the six patterns that lead to codewords within 4.

    Where the leader has fewer than 3 bits, all six are the leader itself.
    """
    bits = [1 << i for i in range(23)]
    leader = np.full(2048, -1, np.int64)
    level = {0: 0}
    leader[0] = 0
    for _ in range(3):
        level = {p | b: 0 for p in level for b in bits if not p & b}
        patterns = np.array(sorted(level), np.int64)
        leader[_syndrome(patterns)] = patterns
    near = np.repeat(leader[:, None], 6, axis=1)
    fours = np.array([sum(bits[i] for i in c) for c in _choose(23, 4)], np.int64)
    syndromes = _syndrome(fours)
    three = np.bitwise_count(leader) == 3
    for s in np.flatnonzero(three):
        near[s, 1:] = fours[syndromes == s]
    return leader, near


def _choose(n: int, k: int):
    from itertools import combinations

    return combinations(range(n), k)


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of the three segments: (n, 3) for the index side, (n, 3, 6) for the query side."""
    leader, near = golay_tables()
    own, around = [], []
    for low, width in SEGMENTS:
        word = (fps >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        s = _syndrome(word)
        own.append((word ^ leader[s]) >> 11)  # systematic: the high 12 bits tell the codeword
        around.append((word[:, None] ^ near[s]) >> 11)
    return np.stack(own, axis=1), np.stack(around, axis=1)


def _key_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            own, around = segment_keys(fps)
            for number, (i, j) in enumerate(PAIRS):
                mine = number << 24 | own[:, i] << 12 | own[:, j]
                grid = (number << 24 | around[:, i, :, None] << 12 | around[:, j, None, :]).reshape(len(fps), -1)
                grid.sort(axis=1)
                fresh = np.ones(grid.shape, bool)
                fresh[:, 1:] = grid[:, 1:] != grid[:, :-1]
                row, column = np.nonzero(fresh & (grid != mine[:, None]))
                key = np.concatenate([mine, grid[row, column]])
                fp = np.concatenate([fps, fps[row]])
                indexed = np.arange(len(key)) < len(mine)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(fp.view(np.int64)), pa.array(indexed)], ["key", "fp", "indexed"])


def forest(fps: np.ndarray, indexed: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """A spanning forest of the links in one bucket: pairs of positions, each with one indexed member at least.

    Every member is visited once and compared with the members not reached yet,
    so a group that hangs together costs little more than its size.
    """
    left = np.arange(len(fps))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        waiting, left = [int(left[0])], left[1:]
        while waiting and len(left):
            at = waiting.pop()
            close = np.bitwise_count(fps[left] ^ fps[at]) <= reach
            if not indexed[at]:
                close &= indexed[left]
            hit = left[close]
            edges += [(at, int(x)) for x in hit]
            waiting += hit.tolist()
            left = left[~close]
    return edges


def _bucket_links(reach: int):
    """Reads rows sorted by key; a bucket that goes on in the next batch is carried over."""

    def links(key: np.ndarray, fp: np.ndarray, indexed: np.ndarray) -> Iterator[tuple[int, int]]:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        has = np.add.reduceat(indexed.astype(np.int64), starts) > 0
        for s, n in zip(starts[(sizes > 1) & has].tolist(), sizes[(sizes > 1) & has].tolist(), strict=True):
            if n == 2:
                if np.bitwise_count(fp[s] ^ fp[s + 1]) <= reach:
                    yield s, s + 1
            else:
                yield from ((s + i, s + j) for i, j in forest(fp[s : s + n], indexed[s : s + n], reach))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            key, fp, indexed = (np.concatenate(x) for x in zip(*parts, strict=True))
            found = np.array(list(links(key, fp, indexed)), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(fp[found[:, 0]].view(np.int64)), pa.array(fp[found[:, 1]].view(np.int64))], ["a", "b"])

        for batch in batches:
            key, fp, indexed = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(key):
                continue
            fp = fp.view(np.uint64)
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if cut:
                yield flush([*held, (key[:cut], fp[:cut], indexed[:cut])])
                held = []
            held.append((key[cut:], fp[cut:], indexed[cut:]))
        if held:
            yield flush(held)

    return run


def link_fingerprints(fps: DataFrame, reach: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``fp`` that connect all within ``reach`` (at most 3) differing bits."""
    if not 0 <= reach <= 3:
        raise ValueError("the keys find pairs of at most 3 differing bits")
    rows = fps.select("fp").distinct().mapInArrow(_key_rows, "key int, fp long, indexed boolean")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_links(reach), "a long, b long")


def near_duplicates(df: DataFrame, reach: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ``fp`` and ``component_id``, the smallest doc_id that links reach.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows are linked; a null id belongs to its component, whose id is
    the smallest other one (null if there is none).  An empty table gives no
    rows; other columns are ignored.
    """
    prints = cut_lineage(add_fingerprints(df, id_col, text_col))
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    parts = connected_components(link_fingerprints(prints, reach)).select(F.col("node").alias("fp"), "component")
    classes = smallest.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    by_print = classes.join(lowest, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one_each(df: DataFrame, reach: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of its smallest id (a null one if there is no other), with the columns of ``df``.

    Groups hang together by their texts alone: rows of other groups stay, also
    if they share the id or have none.  Of rows of one id the smallest key of
    id and text stays, of rows of equal id and text the smallest row.
    """
    prints = cut_lineage(_keyed_fingerprints(df, id_col, text_col))
    parts = connected_components(link_fingerprints(prints, reach)).select(F.col("node").alias("fp"), "component")
    rows = prints.groupBy("fp", "doc_id", "key").agg(F.count("*").alias("n"))
    first = rows.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key", "n")).alias("row"))
    winners = first.join(parts, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("row").alias("row"))
    winners = cut_lineage(winners.select(F.col("row.doc_id").alias("_id"), F.col("row.key").alias("_key"), "row.n"))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    keyed = df.select(whole, F.col(id_col).cast("long").alias("_row_id"), row_key(F.col(id_col).cast("long"), F.col(text_col)).alias("_row_key"))
    kept = keyed.join(winners, keyed["_row_id"].eqNullSafe(winners["_id"]) & (keyed["_row_key"] == winners["_key"]), "left_semi")
    if winners.filter("n > 1").isEmpty():
        return kept.select("_row.*")
    # Of rows of equal id and text the first by their columns as text stays; maps have no order of their own.
    by = [F.col("_row").getField(c).cast("string") for c in df.columns]
    return kept.groupBy("_row_id", "_row_key").agg(F.min_by("_row", F.struct(*by)).alias("_row")).select("_row.*")
