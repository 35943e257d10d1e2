"""Hierarchical multi-length packing of tokenised documents.

Each task packs its own partition, so packing needs no shuffle.  A document is
cut into full windows; its rest is routed to the tier (context size) that just
holds it.  Tiers are packed from the longest down: every rest opens a window of
its tier, and the window's gap is filled by the best-fitting pieces of shorter
tiers.  What gaps stay are closed by cutting pieces of the shortest windows.
The one open window that a block leaves is carried into the next block; at the
end of the partition it is cut into powers of two, so nothing is padded.
Windows of one tier are then dealt to training steps of equal token counts in
snake order of their attention cost, which balances the steps.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import slices, text_of

SLICE_BYTES = 2 << 20
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tier int, step_id long, ids binary"

#: A piece is (doc_id, start, length, doc_tokens, the piece's packed ids).
Piece = tuple


def cut_piece(piece: Piece, length: int) -> tuple[Piece, Piece]:
    doc, start, n, total, ids = piece
    return (doc, start, length, total, ids[: 4 * length]), (doc, start + length, n - length, total, ids[4 * length :])


def pack_tiers(pieces: list[Piece], tiers: list[int], last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Pack pieces shorter than the longest tier; returns full windows and the pieces left over (less than one window).

    Every window's length is a tier, or a power of two where ``last`` cuts the final rest.
    """
    waiting = [[] for _ in tiers]  # by tier, longest first: (length, number), sorted
    for number, piece in enumerate(pieces):
        insort(waiting[max(t for t, size in enumerate(tiers) if size >= piece[2])], (piece[2], number))
    windows: list[tuple[int, list[Piece]]] = []  # gap, pieces
    full: list[list[Piece]] = []
    for t, size in enumerate(tiers):
        while waiting[t]:
            length, number = waiting[t].pop()
            gap, held = size - length, [pieces[number]]
            for shorter in waiting[t + 1 :]:
                while gap and (k := bisect_right(shorter, (gap, len(pieces)))):
                    length, number = shorter.pop(k - 1)
                    held.append(pieces[number])
                    gap -= length
            windows.append((gap, held)) if gap else full.append(held)
    # Close the gaps of the longest windows with pieces of the shortest, cut to fit.
    first, end, spare = 0, len(windows), []
    while first < end or spare:
        if first == end:
            break
        gap, held = windows[first]
        while gap and (spare or end - 1 > first):
            if not spare:
                end -= 1
                spare = windows[end][1]
            piece = spare.pop()
            if piece[2] > gap:
                piece, rest = cut_piece(piece, gap)
                spare.append(rest)
            held.append(piece)
            gap -= piece[2]
        if gap:
            spare = held
            break
        full.append(held)
        first += 1
    left = spare
    if last and left:
        total = sum(x[2] for x in left)
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                room, held = 1 << bit, []
                while room:
                    piece = left.pop()
                    if piece[2] > room:
                        piece, rest = cut_piece(piece, room)
                        left.append(rest)
                    held.append(piece)
                    room -= piece[2]
                full.append(held)
    return full, left


def balance_steps(windows: list[list[Piece]], step_tokens: int) -> list[int]:
    """A step number for each window: windows of one length share steps of ``step_tokens``, dealt in snake order by cost."""
    by_size: dict[int, list[int]] = {}
    for i, held in enumerate(windows):
        by_size.setdefault(sum(x[2] for x in held), []).append(i)
    steps, base = [0] * len(windows), 0
    for size, members in sorted(by_size.items()):
        members.sort(key=lambda i: -sum(x[2] * x[2] for x in windows[i]))
        n = -(-len(members) * size // step_tokens)
        for k, i in enumerate(members):
            row, column = divmod(k, n)
            steps[i] = base + (column if row % 2 == 0 else n - 1 - column)
        base += n
    return steps


#: How byte-level tokenizers cut text before merging (fixed value).
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_SPACE = re.compile(r"\s{500}")
LONG_WORD = 500


def byte_level_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token ids by bytes, if the tokenizer is plain byte-level BPE whose merges stand in the order of their ids; else None."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not spec.get("normalizer")
    if not plain or model.get("type", "BPE") != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
    made = ["".join(x) if isinstance(x, list) else x.replace(" ", "") for x in model["merges"]]
    ids = [model["vocab"][x] for x in made]
    if ids != sorted(set(ids)):
        return None
    return {bytes(byte_of[c] for c in x): model["vocab"][x] for x in [*byte_of, *made]}


@lru_cache(maxsize=1)
def _encoder(path: str) -> Callable[[str], bytes]:
    """A function from text to packed ids, those of the tokenizer file's library as it stands.

    Plain byte-level BPE runs on the rank-based library, which gives the same
    ids as the tokenizer file faster: no merge can cross a token's ends before the token is
    made, so the pair that makes it is always that of its merge.  Texts with very long words
    or runs of white space, and all other kinds of tokenizer, use the tokenizer file itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores are Spark's to share out
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)

    def plainly(text: str) -> bytes:
        return np.array(made.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ranks = byte_level_ranks(spec)
    if ranks is None:
        return plainly
    added = re.compile("|".join(re.escape(x["content"]) for x in spec.get("added_tokens") or []) or r"(?!)")
    import tiktoken

    fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if max(map(len, text.split()), default=0) > LONG_WORD or _LONG_SPACE.search(text) or added.search(text):
            return plainly(text)
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    return encode


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    window: int = 1024,
    tiers: tuple[int, ...] = (1024, 512, 256, 128),
    end_id: int = 0,
    step_tokens: int = 8192,
    block_docs: int = 8192,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise and pack every document; one row per piece.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, tier (the
    sequence's length), step_id, ids (binary, little-endian unsigned 32-bit).
    Each document ends with ``end_id``; a null or empty text is that id alone.
    Repeated rows are packed once each.  An empty table gives no rows.  Other
    columns of ``df`` are ignored, whatever their names.  ``tiers`` are powers of two, longest first,
    the first being ``window``.  A task holds at most the rests (each below a
    window) of ``block_docs`` documents, windows of 2**21 ids, a slice of text
    and one document's ids at a time.
    """
    sizes = list(tiers)
    if sizes[0] != window or sizes != sorted(sizes, reverse=True) or any(x & (x - 1) for x in sizes):
        raise ValueError("tiers must be powers of two from the window down")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        high, end = TaskContext.get().partitionId() << 40, end_id.to_bytes(4, "little")
        made = steps = 0
        pool: list[Piece] = []
        whole: list[list[Piece]] = []

        def emit(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal made, steps
            columns: list[list] = [[] for _ in range(9)]
            step_of = balance_steps(windows, step_tokens)
            for held, step in zip(windows, step_of, strict=True):
                offset, size = 0, sum(x[2] for x in held)
                for doc, start, length, total, ids in held:
                    row = (doc, start, length, total, high + made, offset, size, high + steps + step, ids)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                made += 1
            steps += max(step_of, default=-1) + 1
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encode(text) + end
                    total = len(ids) // 4
                    whole += [[(doc, at, window, total, ids[4 * at : 4 * (at + window)])] for at in range(0, total - window + 1, window)]
                    if rest := total % window:
                        pool.append((doc, total - rest, rest, total, ids[4 * (total - rest) :]))
                    if len(whole) * window > 1 << 21:
                        yield emit(whole)
                        whole = []
                if len(pool) >= block_docs:
                    packed, pool = pack_tiers(pool, sizes, False)
                    yield emit(whole + packed)
                    whole = []
        packed, _ = pack_tiers(pool, sizes, True)
        if whole or packed:
            yield emit(whole + packed)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
