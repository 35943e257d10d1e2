"""Removal of long repeated byte strings by a hash-compared suffix sort.

Every window of ``length`` bytes is named by an anchor: the position of the
smallest hash among its ``grain``-byte strings.  Equal windows have equal
anchors at equal offsets, so only windows whose anchor hash stands somewhere else too can
repeat.  The bytes around such anchors (a context: all windows the anchor
names) are brought together by anchor hash, identical contexts being counted
before the shuffle's reduce side.  Inside a task the windows of an anchor hash are suffixes
that are sorted by merging: two suffixes are compared through prefix
polynomial hashes, a binary search for their common extension and the byte
after it.  Neighbours that agree over the whole length are verified byte by
byte.  The ranges found are joined back to the documents.

An anchor hash with more contexts than a task holds is crowded: its windows are
named by 128-bit hashes, spread over all tasks and counted by name, first in
blocks of neighbouring windows by the bytes these share, then one by one in the
blocks left.  As with identical contexts, equal names count as equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import as_table, beside, cut_lineage, map_text, row_key, text_of

SLICE_BYTES = 4 << 20
CHUNK_BYTES = 6 << 20
COLLAPSE_BYTES = 32 << 20
ENTRIES = 1 << 20
#: Names on more rows than this are broadcast (if counted to be few enough), so that no task gathers them.
OFTEN = 512
BASE = 0x9E3779B97F4A7C15 | 1
COLLAPSED = "h long, c1 long, c2 long, n long, back int, context binary"
RANGES = "c1 long, c2 long, a array<int>, b array<int>"
_U = np.uint64


class Powers:
    """Powers of the base and its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, _U)

    @classmethod
    def need(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 1 << 16)
            base, inverse = np.full(n, BASE, _U), np.full(n, pow(BASE, -1, 1 << 64), _U)
            base[0] = inverse[0] = 1
            cls.up, cls.down = np.cumprod(base), np.cumprod(inverse)
        return cls.up, cls.down


class PrefixHash:
    """Prefix polynomial hashes of a byte string: any substring's hash in one subtraction and one product."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.up, down = Powers.need(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * down[: len(data)], out=self.prefix[1:])

    def of(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.up[at]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of suffixes a and b, at most ``most``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), most, np.int64)
        for _ in range(int(most).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix a sorts before b, and whether they agree over ``most`` bytes."""
        shared = self.common(a, b, most)
        equal = shared == most
        step = np.minimum(shared, most - 1)
        return ~equal & (self.data[a + step] < self.data[b + step]), equal


def merge_sort_suffixes(hashes: PrefixHash, suffixes: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes by their first ``most`` bytes within each group; ``group`` is sorted.

    Bottom-up mergesort: at each level every suffix finds its place in the
    neighbouring run by binary search, all of them at once.
    """
    n = len(suffixes)
    order = np.arange(n)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, n))
    start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(n) - start  # within the group
    width = 1
    while width < sizes.max(initial=0):
        run = place // width
        other = (run ^ 1) * width
        low, high = np.minimum(other, size), np.minimum(other + width, size)
        base, left = low.copy(), run % 2 == 0
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            mine, theirs = suffixes[order[open_]], suffixes[order[start[open_] + middle]]
            less, equal = hashes.before(theirs, mine, most)
            # Ties keep the left run first.
            ahead = less | (equal & ~left[open_])
            low[open_] = np.where(ahead, middle + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        to = start + (run // 2) * 2 * width + (place - run * width) + (low - base)
        merged = np.empty(n, np.int64)
        merged[to] = order
        order = merged
        width *= 2
    return order


def anchors(data: np.ndarray, length: int, grain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes and positions, and the first and last window each names; empty below ``length`` bytes."""
    n, w = len(data), length - grain + 1
    if n < length:
        return np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 3
    hashes = PrefixHash(data)
    h = hashes.of(np.arange(n - grain + 1), grain)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    mask = _U((1 << int(n).bit_length()) - 1)
    packed = (h & ~mask) | np.arange(len(h), dtype=_U)
    blocks = np.pad(packed, (0, -len(packed) % w), constant_values=~_U(0)).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    at = (np.minimum(behind[:windows], ahead[w - 1 : w - 1 + windows]) & mask).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], windows) - 1
    return h[at[first]].view(np.int64), at[first].astype(np.int32), first.astype(np.int32), last.astype(np.int32)


def repeated_windows(contexts: list[bytes], names: np.ndarray, back: np.ndarray, many: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context, which of its windows stand elsewhere too.

    names: anchor hashes, sorted; back: the anchor's place in its context;
    many: whether the whole context occurs more than once.
    """
    sizes = np.array([len(c) - length + 1 for c in contexts])
    found = [np.full(n, bool(m)) for n, m in zip(sizes, many, strict=True)]
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    counts = np.diff(np.append(starts, len(names)))
    busy = np.flatnonzero(np.repeat(counts > 1, counts))
    if not len(busy):
        return found
    data = np.frombuffer(b"".join(contexts[i] for i in busy), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(contexts[i]) for i in busy])[:-1]])
    hashes = PrefixHash(data)
    views = np.lib.stride_tricks.sliding_window_view(data, length)
    flags = np.zeros(len(data), bool)
    # Offset of the anchor in the window, from the context's last window to its first.
    nearest, farthest = back[busy] - sizes[busy] + 1, back[busy]
    number = np.repeat(np.arange(len(starts)), counts)[busy]
    step = max(1, ENTRIES // len(busy))
    for low in range(int(nearest.min()), int(farthest.max()) + 1, step):
        a, b = np.maximum(nearest, low), np.minimum(farthest, low + step - 1)
        width = np.maximum(b - a + 1, 0)
        which = np.repeat(np.arange(len(busy)), width)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(a, width)
        key = number[which] * (length + 1) + offset
        by_key = np.argsort(key, kind="stable")
        which, key, offset = which[by_key], key[by_key], offset[by_key]
        twins = np.append(key[1:] == key[:-1], False) | np.append(False, key[1:] == key[:-1])
        which, key, offset = which[twins], key[twins], offset[twins]
        if not len(which):
            continue
        suffixes = offsets[which] + back[busy][which] - offset
        order = merge_sort_suffixes(hashes, suffixes, key, length)
        suffixes = suffixes[order]
        near = np.flatnonzero(key[1:] == key[:-1])
        same = near[hashes.of(suffixes[near], length) == hashes.of(suffixes[near + 1], length)]
        for part in np.array_split(same, -(-len(same) // 4096) or 1):
            exact = (views[suffixes[part]] == views[suffixes[part + 1]]).all(axis=1)
            flags[suffixes[part[exact]]] = flags[suffixes[part[exact] + 1]] = True
            if not exact.all():  # a hash collision may have led the sort astray: these groups are settled by their bytes
                for k in set(key[part[~exact]].tolist()):
                    members = suffixes[key == k]
                    strings, where, times = np.unique(views[members], axis=0, return_inverse=True, return_counts=True)
                    flags[members[times[where.ravel()] > 1]] = True
    for i, at in zip(busy.tolist(), offsets.tolist(), strict=True):
        found[i] |= flags[at : at + sizes[i]]
    return found


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _find_anchors(length: int, grain: int):
    """Per text its anchor hashes; one that stands at several places is listed twice."""

    def hashes(text: str) -> np.ndarray:
        h = np.sort(anchors(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), length, grain)[0])
        third = np.zeros(len(h), bool)
        third[2:] = h[2:] == h[:-2]
        return h[~third]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(map(hashes, part.column(2).to_pylist()), pa.list_(pa.int64()))], ["_id", "_key", "h"])

        yield from map_text(batches, SLICE_BYTES, work, text_column=2)

    return run


def _squeeze(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the shuffles."""
    squeeze = zstandard.ZstdCompressor(level=6).compress


    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        packed = [squeeze(x.encode("utf-8", "surrogatepass")) for x in part.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary()), part.column(3)], ["_id", "_key", "z", "doc_id"])

    yield from map_text(batches, SLICE_BYTES, work, text_column=2)


def _cut_contexts(length: int, grain: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.binary()]
        names = ["_id", "_key", "h", "c1", "c2", "lo", "back", "context"]

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            columns: list[list] = [[] for _ in names]
            for doc, key, packed, wanted in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = expand(packed)
                found = anchors(np.frombuffer(data, np.uint8), length, grain)
                some = np.isin(found[0], wanted)
                for h, pos, lo, hi in zip(*(x[some].tolist() for x in found), strict=True):
                    context, back = data[lo : hi + length], pos - lo
                    digest = xxhash.xxh3_128_digest(context, back)
                    row = (doc, key, h, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True), lo, back, context)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        yield from map_text(batches, SLICE_BYTES // 4, work, text_column=2)

    return run


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identical contexts of a task become one row with their number, so hot passages shrink before the shuffle."""
    held: list[pa.Table] = []

    def flush() -> list[pa.RecordBatch]:
        table = pa.concat_tables(held).group_by(["h", "c1", "c2"], use_threads=False).aggregate([("n", "sum"), ("back", "min"), ("context", "one")])
        held.clear()
        return table.select(["h", "c1", "c2", "n_sum", "back_min", "context_one"]).rename_columns(["h", "c1", "c2", "n", "back", "context"]).to_batches(max_chunksize=4096)

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]).append_column("n", pa.array(np.ones(batch.num_rows, np.int64))))
        if sum(t.nbytes for t in held) > COLLAPSE_BYTES:
            yield from flush()
    if held:
        yield from flush()


def _sort_contexts(length: int):
    """Reads contexts sorted by anchor hash and digest; an anchor that goes on in the next batch is carried over."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def flush(table: pa.Table) -> pa.RecordBatch:
            h, c1, c2, n = (table.column(c).to_numpy() for c in ("h", "c1", "c2", "n"))
            first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])))
            many = np.add.reduceat(n, first) > 1
            contexts = table.column("context").take(pa.array(first)).to_pylist()
            found = [_runs(x) for x in repeated_windows(contexts, h[first], table.column("back").to_numpy()[first], many, length)]
            keep = [i for i, (a, _) in enumerate(found) if len(a)]
            lists = [pa.array([found[i][k] + (length - 1) * k for i in keep], pa.list_(pa.int32())) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(c1[first[keep]]), pa.array(c2[first[keep]]), *lists], ["c1", "c2", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            table = pa.concat_tables(held)
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield flush(table.slice(0, cut))
            held = [table.slice(cut)]
            size = held[0].nbytes
        if held:
            yield flush(pa.concat_tables(held))

    return run


def _name_cores(length: int, step: int, coarse: int = 0):
    """Per context and block of ``step`` neighbouring windows a 128-bit name of the bytes they share; with ``coarse``, only within the given blocks of so many.

    Blocks are counted by the anchor's offset in the window, so equal windows have equal blocks.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            c1, c2, n, backs = (part.column(c).to_numpy() for c in range(4))
            wanted = map(set, part.column(5).to_pylist()) if coarse else [None] * part.num_rows
            which, at, names = [], [], []
            for i, (back, context, some) in enumerate(zip(backs.tolist(), part.column(4).to_pylist(), wanted, strict=True)):
                for k in range((back - len(context) + length) // step, back // step + 1):
                    if some is None or k * step // coarse in some:
                        which.append(i)
                        at.append(k)
                        names.append(xxhash.xxh3_128_digest(context[back - k * step : back + length - (k + 1) * step + 1], k))
            w = np.frombuffer(b"".join(names), ">i8").astype(np.int64).reshape(-1, 2)
            columns = [c1[which], c2[which], n[which], backs[which], np.array(at, np.int32), w[:, 0], w[:, 1]] if which else [np.zeros(0, t) for t in "qqqiiqq"]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["c1", "c2", "n", "back", "at", "w1", "w2"])

        yield from map_text(batches, SLICE_BYTES // 4, work, text_column=4)

    return run


def _named_again(names: DataFrame) -> DataFrame:
    """The rows of ``names`` whose name stands for more than one place."""
    key = ["w1", "w2"]
    seen = cut_lineage(names.groupBy(*key).agg(F.sum("n").alias("places"), F.count("*").alias("rows")).filter("places > 1"))
    often, rest = beside(seen.filter(F.col("rows") > OFTEN).select(*key)), seen.filter(F.col("rows") <= OFTEN).select(*key)
    return names.join(often, key, "left_semi").union(names.join(often, key, "left_anti").join(rest, key, "left_semi"))


def _windows_to_ranges(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = []
            for back, offsets in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                flags = np.zeros(back + 1 - min(offsets), bool)
                flags[back - np.array(offsets)] = True
                ranges.append(_runs(flags))
            lists = [pa.array([r[k] + (length - 1) * k for r in ranges], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["c1", "c2", "a", "b"])

    return run


def _crowded_ranges(contexts: DataFrame, length: int, grain: int) -> DataFrame:
    """The ranges of (h, c1, c2, back, context) rows as _sort_contexts finds them, however many contexts an anchor hash has."""
    few = as_table(contexts.mapInArrow(_collapse, COLLAPSED)).select("c1", "c2", "n", "back", "context")
    named, step = "c1 long, c2 long, n long, back int, at int, w1 long, w2 long", max(2, isqrt(length - grain + 1))
    blocks = _named_again(as_table(few.mapInArrow(_name_cores(length, step), named))).groupBy("c1", "c2").agg(F.collect_set("at").alias("blocks"))
    wanted = few.join(blocks, ["c1", "c2"]).select(*few.columns, "blocks")
    windows = _named_again(as_table(wanted.mapInArrow(_name_cores(length, 1, step), named)))
    return windows.groupBy("c1", "c2").agg(F.min("back").alias("back"), F.collect_set("at").alias("at")).mapInArrow(_windows_to_ranges(length), RANGES)


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress

    def one(packed: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[int, int, int, bytes]:
        data = expand(packed)
        if not starts:
            return len(data), 0, 0, data
        gone = np.zeros(len(data) + 1, np.int32)
        np.add.at(gone, starts, 1)
        np.add.at(gone, ends, -1)
        covered = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
        return len(data), len(data) - len(kept), len(_runs(covered)[0]), kept

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*map(one, *(part.column(c).to_pylist() for c in ("z", "starts", "ends"))), strict=True)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    yield from map_text(batches, SLICE_BYTES, work, text_column=1)


def remove_repeats(df: DataFrame, length: int = 400, grain: int = 96, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes left, concatenated).

    A byte goes if a ``length``-byte string that covers it also starts anywhere
    else.  Null texts are empty; repeated rows are repeats of each other; texts
    below ``length`` stay whole; an empty table gives no rows; other columns
    are ignored.
    """
    doc_id = F.col(id_col).cast("long")
    docs = df.select(F.coalesce(doc_id, F.lit(0)).alias("_id"), row_key(doc_id, text_col).alias("_key"), text_of(text_col).alias("text"), doc_id.alias("doc_id"))
    found = cut_lineage(docs.filter(F.octet_length("text") >= length).select("_id", "_key", "text").mapInArrow(_find_anchors(length, grain), "_id long, _key long, h array<long>"))
    flat = found.select("_id", "_key", F.explode("h").alias("h"))
    # Written first, so that both sides of the join are plain shuffles, which the skew handling can split.
    twice = cut_lineage(flat.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    wanted = flat.join(twice, "h").groupBy("_id", "_key").agg(F.collect_set("h").alias("wanted"))
    packed = docs.select("_id", "_key", "text", "doc_id").mapInArrow(_squeeze, "_id long, _key long, z binary, doc_id long")
    cut = packed.select("_id", "_key", "z").join(wanted, ["_id", "_key"]).select("_id", "_key", "z", "wanted")
    contexts = as_table(cut.mapInArrow(_cut_contexts(length, grain), "_id long, _key long, h long, c1 long, c2 long, lo int, back int, context binary"))
    # Identical contexts meet map-side; a passage in a third of all documents is a few rows of each task here.
    parts = contexts.select("h", "c1", "c2", "back", "context")
    crowded = cut_lineage(contexts.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > max(2, CHUNK_BYTES // (2 * length))).select("h"))
    some = not crowded.isEmpty()
    few = (parts.join(beside(crowded), "h", "left_anti") if some else parts).mapInArrow(_collapse, COLLAPSED)
    ranges = few.repartition("h").sortWithinPartitions("h", "c1", "c2").mapInArrow(_sort_contexts(length), RANGES)
    if some:
        ranges = ranges.union(_crowded_ranges(parts.join(beside(crowded), "h", "left_semi"), length, grain))
    shifted = contexts.select("_id", "_key", "c1", "c2", "lo").join(ranges, ["c1", "c2"])
    shifted = shifted.select("_id", "_key", F.inline(F.arrays_zip((F.transform("a", lambda x: x + F.col("lo"))).alias("a"), F.transform("b", lambda x: x + F.col("lo")).alias("b"))))
    spans = shifted.groupBy("_id", "_key").agg(F.collect_list("a").alias("starts"), F.collect_list("b").alias("ends"))
    cleaned = packed.join(spans, ["_id", "_key"], "left").select("doc_id", "z", "starts", "ends")
    return cleaned.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
