"""Media columns: texts stored as WAV, read back, and fingerprinted by spectral peaks.

A text's UTF-8 bytes, filled with spaces up to a positive multiple of 192, become the samples of an 8-bit
mono WAV file, byte for byte, which is written as a binary column (``store``). What is written is read back
from there (``features``), with the ``wave`` module, and cut into
overlapping frames; of each frame's short-time Fourier transform the strongest bins in three bands are
its peaks, and pairs of a peak with the strongest peaks of the next frames give the fingerprint: for each
pair its time (frame number) and its code (first bin, second bin, distance). A frame is worked on as part
of a block of bounded size, so that memory doesn't grow with the length of a text.

Defined cases: a null text is the empty one (192 spaces); equal texts give equal values; repeated rows
are kept; an empty table gives an empty result; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UNIT, RATE = 192, 8_000
FRAME, HOP, REACH = 384, 192, 2
#: Bands of Fourier bins, low to high; one peak is taken in each.
BANDS = ((4, 24), (24, 72), (72, 193))
#: Bytes of texts or files that are passed on together.
BYTES = 8 << 20
#: Frames that are transformed at a time.
BLOCK = 2_048
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pair_times array<int>, pair_codes array<int>"


def payload(text: str | None) -> tuple[int, bytes]:
    """The length of the text in bytes, and the bytes with their padding."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" ")


def to_wav(samples: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    with wave.open(io.BytesIO(data), "rb") as w:
        return w.readframes(w.getnframes())


def peaks(samples: bytes) -> np.ndarray:
    """The strongest bin of each band in each frame; the lowest of equal ones."""
    x = np.frombuffer(samples, np.uint8)
    x = np.concatenate([x, np.full(max(0, FRAME - len(x)), 128, np.uint8)])
    window = np.hanning(FRAME).astype(np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    found = []
    for at in range(0, len(frames), BLOCK):
        power = np.abs(np.fft.rfft((frames[at : at + BLOCK].astype(np.float32) - 128) * window, axis=1))
        power = np.round(power, 2)  # so that the last bits of the transform decide nothing
        found.append(np.stack([power[:, a:b].argmax(axis=1) + a for a, b in BANDS], axis=1))
    return np.concatenate(found).astype(np.int32)


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times and codes of the peak pairs, in order of time: each band's peak with the peak of the same band
    in each of the next ``REACH`` frames."""
    p = peaks(samples)
    times, codes = [], []
    for d in range(1, REACH + 1):
        if len(p) > d:
            a, b = p[:-d], p[d:]
            codes.append((a << 12 | b << 4 | d).ravel())
            times.append(np.repeat(np.arange(len(a), dtype=np.int32), len(BANDS)))
    if not codes:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order], c[order]


def _rows(batches: Iterable[pa.RecordBatch], schema: pa.Schema, row) -> Iterator[pa.RecordBatch]:
    """``row`` of every row, in batches of BYTES or so."""
    for batch in batches:
        rows, size = [], 0
        for values in zip(*batch.columns, strict=True):
            rows.append(row(*(v.as_py() for v in values)))
            size += len(values[-1].as_buffer() or b"") if values[-1].is_valid else 0
            if size >= BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def store(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The media table: doc_id, n_bytes and ``wav``, the stored form of each text, written as Parquet."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("wav", pa.binary())])

    def row(doc_id: int, text: str | None) -> tuple:
        n, raw = payload(text)
        return doc_id, n, to_wav(raw)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("text") if text is None else text).alias("text"))
    return materialize(rows.mapInArrow(lambda b: _rows(b, schema, row), "doc_id long, n_bytes long, wav binary"))


def features(stored: DataFrame) -> DataFrame:
    """One row per stored file: the payload read back, its checksums, the file's digest, and the fingerprint (pair_times,
    pair_codes; ``feature`` is their number and digest)."""
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in SCHEMA.split(", "))])

    def row(doc_id: int, n: int, wav: bytes) -> tuple:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        back = from_wav(wav)
        times, codes = fingerprint(back)
        digest = sha(times.astype("<i4").tobytes() + codes.astype("<i4").tobytes())
        return doc_id, n, len(back), sha(back), zlib.crc32(back[-16:]), len(wav), sha(wav), f"{len(codes)}:{digest}", times, codes

    return stored.select("doc_id", "n_bytes", "wav").mapInArrow(lambda b: _rows(b, schema, row), SCHEMA)


def media(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """One row per document: ``features`` of what ``store`` has written."""
    return features(store(docs, text))
