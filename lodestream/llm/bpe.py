"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

Encoding works on the distinct pretokens of a bounded slice of the corpus at a
time.  All of them lie in one array of token ids; an inverted index leads from
a merge's rank to the positions of its pair.  Merges are applied in rank order
to all their positions at once, and only the touched neighbours get new index
entries.  Texts are then put together from the encoded pieces, which a cache
bounded in bytes carries from slice to slice and task to task.

No row leaves its partition, so there is no shuffle at any size.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import map_text, text_of
from lodestream.llm.pretokens import Pieces

SLICE_BYTES = 4 << 20
DECODE_BYTES = 1 << 20
DECODE_IDS = 1 << 18


class MergeReplay:
    """Encodes many pretokens together by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where no merge makes one token of it."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, packed as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = int(lengths.sum())
        kind = np.int32 if n < 1 << 31 else np.int64
        token = np.append(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)], -1).astype(kind)
        ends = np.cumsum(lengths)
        # Neighbours by position; n stands for none. A word's bounds are never crossed.
        after, before = np.arange(1, n + 2, dtype=kind), np.arange(-1, n, dtype=kind)
        after[ends[lengths > 0] - 1] = n
        before[(ends - lengths)[lengths > 0]] = n
        after[n] = before[n] = n
        alive = np.ones(n + 1, bool)
        index: dict[int, list[np.ndarray]] = {}
        due: list[int] = []

        def add(at: np.ndarray) -> None:
            """Enter the pairs that begin at these positions into the index."""
            at = at[after[at] < n]
            rank = self._ranks_of(token[at], token[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            bounds = np.flatnonzero(np.diff(rank)) + 1
            starts = [0, *bounds.tolist()]
            for r, lo, hi in zip(rank[starts].tolist(), starts, [*starts[1:], len(at)], strict=True):
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(due, r)

        for at in range(0, n, 1 << 20):
            add(np.arange(at, min(n, at + (1 << 20)), dtype=kind))
        while due:
            rank = heapq.heappop(due)
            found = index.pop(rank)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[alive[at] & (after[at] < n)]
            at = at[self._ranks_of(token[at], token[after[at]]) == rank]
            if len(at) > 1:
                at = _leftmost(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            after[at] = after[gone]
            before[after[at]] = at
            before[n] = n
            left = before[at]
            add(np.unique(np.concatenate([left[left < n], at])))
        left = alive[:n]
        per_word = np.add.reduceat(left, (ends - lengths)[lengths > 0]) if n else np.zeros(0, np.int64)
        counts = np.zeros(len(words), np.int64)
        counts[lengths > 0] = per_word
        packed, stops = token[:n][left].astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row (a run of one token), every second one, from the left."""
    linked = np.append(False, after[at[:-1]] == at[1:])
    if not linked.any():
        return at
    i = np.arange(len(at))
    start = np.maximum.accumulate(np.where(linked, 0, i))
    return at[(i - start) % 2 == 0]


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def _replay(path: str) -> MergeReplay:
    return MergeReplay(read_ranks(path))


@lru_cache(maxsize=2)
def _pieces(path: str, pattern: str) -> Pieces:
    """Pieces that are coded already; a Python worker keeps them for its later tasks."""
    replay, cut = _replay(path), regex.compile(pattern)

    def encode(texts: list[str]) -> list[bytes]:
        cuts = [cut.findall(x) for x in texts]
        words = list(set().union(*cuts))
        coded = dict(zip(words, replay.encode([x.encode("utf-8", "surrogatepass") for x in words]), strict=True))
        return [b"".join([coded[w] for w in ws]) for ws in cuts]

    return Pieces(encode)


def encode_corpus(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text; one row per input row.

    Returns ``doc_id`` and ``ids`` (binary: little-endian unsigned 32-bit ids).
    A null or empty text has no ids; repeated rows are encoded alike; other
    columns of ``df`` are ignored, whatever their names.  ``ranks_path`` is a
    rank file present on every executor, ``pattern`` cuts pretokens.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _pieces(ranks_path, pattern)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(coder.code(part.column(1).to_pylist()), pa.binary())], ["doc_id", "ids"])

        yield from map_text(batches, SLICE_BYTES, work)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode_corpus(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Decode packed ids; adds nothing else: ``doc_id``, ``ids_text`` (decimal ids, spaced), ``n_tokens``, ``decoded`` (binary).

    Null ids decode to no bytes; repeated rows are decoded alike; an empty table
    gives no rows; other columns are ignored.  An id outside the vocabulary raises.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        token = dict(zip(ranks.values(), ranks.keys(), strict=True))
        decimal = {i: str(i) for i in token}

        def one(packed: bytes | None) -> tuple[str, int, bytes]:
            ids, digits, data = np.frombuffer(packed or b"", "<u4"), [], []
            for at in range(0, len(ids), DECODE_IDS):
                some = ids[at : at + DECODE_IDS].tolist()
                digits.append(" ".join([decimal[i] for i in some]))
                data.append(b"".join([token[i] for i in some]))
            return " ".join(digits), len(ids), b"".join(data)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            columns = zip(*map(one, part.column(1).to_pylist()), strict=True)
            kinds = [pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc_id", "ids_text", "n_tokens", "decoded"])

        yield from map_text(batches, DECODE_BYTES, work)

    return df.select("doc_id", ids_col).mapInArrow(run, "doc_id long, ids_text string, n_tokens long, decoded binary")
