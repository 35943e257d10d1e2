"""Periodic runs of words by the runs theorem, and texts with each run folded to one period.

A run is a stretch of consecutive words with smallest period q, of length at
least max(``min_length``, 2q), that no neighbouring word extends.  Every run has
a Lyndon root that is the longest Lyndon word at its start under the order of
words or under the reverse order.  Longest Lyndon words end at the next smaller
(or next greater) value of the inverse suffix array; roots are extended to both
sides by common extensions, which are range minima of the longest common
prefixes, read from a sparse table.

Before that, stretches that cannot lie in a run are left out: each word of a run
is in a window of ceil(min_length / 2) words that occurs twice in the run.  Words
outside such windows cut a text into segments, and the windows are looked for
again inside the segments until nothing more goes.  This is exact; a collision of
the windows' hashes only keeps more words.

A task takes bounded slices of whole texts; a longer text stands alone.  Null
texts are empty.  Repeated rows and rows without id are rows like any other.
Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import WORD_BREAK, map_text, text_of

SLICE_BYTES = 4 << 20


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``codes`` and its inverse, by doubling the length that is sorted."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        change = np.diff(key[order]) != 0
        rank[order] = np.concatenate(([0], np.cumsum(change)))
        if change.all():
            return order, rank
        step *= 2


def common_prefixes(codes: list[int], order: list[int], rank: list[int]) -> np.ndarray:
    """At each place of the suffix array the common prefix with the suffix before it; the last code is unique."""
    found, k = [0] * len(codes), 0
    for i, r in enumerate(rank):
        if r:
            j = order[r - 1]
            while codes[i + k] == codes[j + k]:
                k += 1
            found[r] = k
        k = k - 1 if k else 0
    return np.array(found, np.int32)


class Extensions:
    """Longest common extensions to the right of any two places, by a sparse table of range minima."""

    def __init__(self, codes: np.ndarray):
        order, self.rank = suffix_array(codes)
        self.levels = [common_prefixes(codes.tolist(), order.tolist(), self.rank.tolist())]
        while 2 ** len(self.levels) <= len(codes):
            below, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - 2**k + 1])
        return out


def next_smaller(values: list[int]) -> np.ndarray:
    """For each place the next place with a smaller value, or the length."""
    found, stack = [len(values)] * len(values), []
    for i in range(len(values) - 1, -1, -1):
        v = values[i]
        while stack and values[stack[-1]] > v:
            stack.pop()
        if stack:
            found[i] = stack[-1]
        stack.append(i)
    return np.array(found, np.int64)


def runs_of(codes: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run, length at least two periods, of a string whose last code occurs once."""
    n = len(codes)
    right, left = Extensions(codes), Extensions(np.concatenate((codes[-2::-1], [codes.max() + 1])))
    found = []
    for rank in (right.rank, n - right.rank):
        start = np.arange(n)
        end = next_smaller(rank.tolist())
        start, end = start[end < n], end[end < n]
        forward = right(start, end)
        backward = np.zeros(len(start), np.int64)
        inner = start > 0
        # place k of the string is place n - 2 - k of the reversed one, which ends with a code of its own
        backward[inner] = left(n - 2 - (start[inner] - 1), n - 2 - (end[inner] - 1))
        length, period = end - start + forward + backward, end - start
        full = length >= 2 * period
        found.append(np.stack((start - backward, length, period), 1)[full])
    return np.unique(np.concatenate(found), axis=0)


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _segments(ids: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the segments that may hold runs, -1 elsewhere; no segment crosses parts."""
    n = len(ids)
    base = _mixed(ids)
    while True:
        inside = part >= 0
        ok = np.zeros(n, bool)
        if n >= width:
            ok[: n - width + 1] = inside[: n - width + 1] & (part[: n - width + 1] == part[width - 1 :])
        at = np.flatnonzero(ok)
        key = _mixed(part[at])
        for k in range(width):
            key = key * np.uint64(0x94D049BB133111EB) + base[at + k]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + width, -1)
        kept = np.cumsum(edge[:-1]) > 0
        first = kept & np.concatenate(([True], ~kept[:-1] | (part[1:] != part[:-1])))[:n]
        new = np.where(kept, np.cumsum(first) - 1, -1)
        if kept.sum() == inside.sum():
            return new
        part = new


def find_word_runs(texts: list[bytes], min_length: int) -> list[tuple[list[bytes], np.ndarray]]:
    """Per text its words and its runs as rows of (start, length, period), ordered by start, then period."""
    width = (min_length + 1) // 2
    numbers: dict[bytes, int] = {}
    words = [t.split() for t in texts]  # on bytes: splits at \x20 and \x09-\x0D only
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    text_of_word, first_word = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    segment = _segments(ids, text_of_word, width)
    at = np.flatnonzero(segment >= 0)
    runs = np.zeros((0, 3), np.int64)
    if len(at):
        seg = segment[at]
        # Each segment has codes of its own and ends with one that occurs once.
        place = np.arange(len(at)) + seg
        codes = np.empty(len(at) + seg[-1] + 1, np.int64)
        gap = np.ones(len(codes), bool)
        gap[place] = False
        codes[place] = np.unique(seg * len(numbers) + ids[at], return_inverse=True)[1]
        codes[gap] = np.arange(gap.sum()) + len(at)
        word_at = np.zeros(len(codes), np.int64)
        word_at[place] = at
        runs = runs_of(codes)
        runs = runs[runs[:, 1] >= min_length]
        runs[:, 0] = word_at[runs[:, 0]]
    owner = text_of_word[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    order = np.lexsort((runs[:, 2], runs[:, 0]))
    runs, owner = runs[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(words[k], runs[bounds[k] : bounds[k + 1]] - [first_word[k], 0, 0]) for k in range(len(texts))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(df: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, n_words, runs (array of start, length, period) and the collapsed text.

    Runs are ordered by start, then period.  An empty text has no runs and an
    empty collapsed text; white space between kept words becomes one space.
    """
    if min_length < 2:
        raise ValueError("a run has two words at least")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1).cast(pa.binary()).to_pylist()
        found = find_word_runs(texts, min_length)
        bounds = np.concatenate(([0], np.cumsum([len(r) for _, r in found]))).astype(np.int32)
        flat = np.concatenate([r for _, r in found])
        struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUNS.value_type))
        return pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([len(w) for w, _ in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds), struct),
                pa.array([_collapsed(w, r) for w, r in found], pa.binary()).cast(pa.string()),
            ],
            names=["id", "n_words", "runs", "collapsed"],
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map_text(batches, SLICE_BYTES, work)

    read = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = f"id {read.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return read.mapInArrow(find, schema).withColumnRenamed("id", id_col.strip("`"))


def plant_tails(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with a periodic tail in about a tenth of its texts, for trials of ``find_runs``.

    With h the CRC-32 of the id as text and g = h div 10: if h mod 10 is 0, words
    from a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8).  Rows
    without id or words stay.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(text_of(text_col), WORD_BREAK), lambda w: w != "")
    n = F.size(words).cast("long")
    g = F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    cycle = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), cycle), F.lit(1), n.cast("int")), " ")
    return df.withColumn(text_col.strip("`"), F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col(text_col)))
