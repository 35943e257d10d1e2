"""Media columns: texts stored as 8-bit WAV, read back, and fingerprinted by pairs of spectral peaks.

A payload is the text's UTF-8 bytes, padded with zero bytes to a positive
multiple of 64; each byte is one unsigned 8-bit sample, so storage is lossless.
Features come from the samples read back with the ``wave`` module: a
short-time Fourier transform, the strongest bin of each of a few bands per
frame, and pairs of peaks at most ``reach`` frames apart, hashed as
(bin, bin, distance) and stored as arrays beside their frame numbers.
Rows are independent, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import map_text, text_of

PAD = 64
SLICE_BYTES = 2 << 20
BLOCK_FRAMES = 1 << 13
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media binary, times array<int>, hashes array<int>"


def write_wav(payload: bytes, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def read_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def stft(samples: np.ndarray, frame: int, hop: int) -> np.ndarray:
    """Magnitudes, one row per frame; a signal shorter than a frame is zero-padded to one."""
    signal = samples.astype(np.float32) - 128
    missing = max(frame - len(signal), -(len(signal) - frame) % hop)
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(signal, (0, missing)), frame)[::hop]
    return np.abs(np.fft.rfft(frames * np.hanning(frame).astype(np.float32), axis=1))


def spectral_peaks(samples: np.ndarray, frame: int, hop: int, bands: tuple[int, ...]) -> np.ndarray:
    """The strongest bin of each band, one row per frame; the transform is made for ``BLOCK_FRAMES`` frames at a time."""
    n = max(1, 1 + -(-(len(samples) - frame) // hop))
    out = []
    for first in range(0, n, BLOCK_FRAMES):
        last = min(n, first + BLOCK_FRAMES)
        magnitudes = stft(samples[first * hop : (last - 1) * hop + frame], frame, hop)
        edges = [*bands, magnitudes.shape[1]]
        out.append(np.stack([lo + magnitudes[:, lo:hi].argmax(axis=1) for lo, hi in zip(edges, edges[1:], strict=False)], axis=1).astype(np.int32))
    return np.concatenate(out)


def peak_pairs(peaks: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers and hashes of all pairs of band peaks 1 to ``reach`` frames apart, by frame, then hash."""
    n, times, hashes = len(peaks), [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for first in range(0, n, BLOCK_FRAMES):
        block_t, block_h = [], []
        for far in range(1, reach + 1):
            last = min(n - far, first + BLOCK_FRAMES)
            if last > first:
                pair = peaks[first:last, :, None] << 16 | peaks[first + far : last + far, None, :] << 4 | far
                block_h.append(pair.ravel())
                block_t.append(np.repeat(np.arange(first, last, dtype=np.int32), pair[0].size))
        if block_h:
            flat_t, flat_h = np.concatenate(block_t), np.concatenate(block_h)
            order = np.lexsort((flat_h, flat_t))
            times.append(flat_t[order])
            hashes.append(flat_h[order])
    return np.concatenate(times), np.concatenate(hashes)


def fingerprint_media(
    df: DataFrame,
    rate: int = 8000,
    frame: int = 256,
    hop: int = 128,
    bands: tuple[int, ...] = (1, 16, 48),
    reach: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: the stored WAV, facts of the payload read back, and its peak pairs.

    A null or empty text is a payload of 64 zero bytes.  One frame has no
    pairs, so short texts have empty arrays.  Equal texts give equal rows, an
    empty table none; other columns of ``df`` are ignored.  A payload is limited only by WAV's
    own 4 GB.  ``bands`` are the first bins of the bands.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(doc: int | None, text: str) -> tuple:
            data = text.encode("utf-8", "surrogatepass")
            media = write_wav(data + bytes(-len(data) % PAD or (0 if data else PAD)), rate)
            payload = read_wav(media)
            times, hashes = peak_pairs(spectral_peaks(np.frombuffer(payload, np.uint8), frame, hop, bands), reach)
            return doc, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]), media, times, hashes

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            columns = zip(*map(one, part.column(0).to_pylist(), part.column(1).to_pylist()), strict=True)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        yield from map_text(batches, SLICE_BYTES, work)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
