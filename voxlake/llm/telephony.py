"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV, decoded to PCM and resampled.

Companded samples are expanded by tables of 256; ADPCM, whose samples follow one another only within a block, is
decoded a sample at a time across all blocks of a batch. All arithmetic is on integers, so equal bytes give equal
results anywhere. Passes are narrow; a batch is decoded `SLICE` bytes at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, store

RATE, OUT_RATE, ALIGN = 8000, 16000, 64
SLICE = 1 << 20

#: Format tags of WAV.
PCM, ALAW, MULAW, IMA = 0x0001, 0x0006, 0x0007, 0x0011
NAMES = {PCM: "pcm", ALAW: "alaw", MULAW: "mulaw", IMA: "ima"}

#: Fixed values of IMA ADPCM: quantiser steps, and what a code adds to the step's index.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279,
    307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428,
    4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def _companding() -> tuple[np.ndarray, np.ndarray]:
    code = np.arange(256)
    u = ~code & 0xFF
    mulaw = ((((u & 0x0F) << 3) + 0x84) << ((u & 0x70) >> 4)) - 0x84
    a = code ^ 0x55
    segment, step = (a & 0x70) >> 4, ((a & 0x0F) << 4) + 8
    alaw = np.where(segment > 0, (step + 0x100) << np.maximum(segment - 1, 0), step)
    return np.where(u & 0x80, -mulaw, mulaw).astype(np.int16), np.where(a & 0x80, alaw, -alaw).astype(np.int16)


MULAW_TABLE, ALAW_TABLE = _companding()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """PCM of mono IMA ADPCM blocks (a row each): 2 x (width - 4) + 1 samples a block. A header's index is held to the table."""
    n, width = blocks.shape
    out = np.empty((n, 2 * (width - 4) + 1), np.int16)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(STEPS) - 1)
    out[:, 0] = value
    for k in range(4, width):
        for half in (0, 1):
            code = (blocks[:, k] >> (4 * half)) & 0x0F
            step = STEPS[index]
            delta = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
            value = np.clip(np.where(code & 8, value - delta, value + delta), -32768, 32767)
            index = np.clip(index + MOVES[code], 0, len(STEPS) - 1)
            out[:, 2 * (k - 4) + half + 1] = value
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation at rate `to`, rounded down; the last sample holds."""
    if rate == to or not len(pcm):
        return pcm
    at = np.arange(len(pcm) * to // rate, dtype=np.int64) * rate
    left, part = at // to, at % to
    right = np.minimum(left + 1, len(pcm) - 1)
    wide = pcm.astype(np.int64)
    return ((wide[left] * (to - part) + wide[right] * part) // to).astype(np.int16)


def wav(tag: int, data: bytes, rate: int = RATE, align: int = 1) -> bytes:
    """A mono WAV file."""
    bits = {PCM: 16, IMA: 4}.get(tag, 8)
    samples = 2 * (align - 4) + 1
    extra = struct.pack("<HH", 2, samples) if tag == IMA else b"" if tag == PCM else struct.pack("<H", 0)
    per_second = rate * align // samples if tag == IMA else rate * align
    form = struct.pack("<HHIIHH", tag, 1, rate, per_second, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data) & 0xFFFFFFFF) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body) & 0xFFFFFFFF) + body


def parse(media: bytes | None) -> tuple[int, int, int, bytes] | None:
    """(tag, rate, align, data) of a mono WAV file; None for what isn't one."""
    if not media or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    form, at = None, 12
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        body = media[at + 8 : at + 8 + size]
        if name == b"fmt " and len(body) >= 16:
            form = struct.unpack_from("<HHIIHH", body)
        elif name == b"data" and form:
            tag, channels, rate, _, align, _ = form
            return (tag, rate, align, body) if channels == 1 and tag in NAMES and rate and len(body) == size else None
        at += 8 + size + size % 2
    return None


def pcm_of(tag: int, align: int, data: bytes) -> np.ndarray:
    """All samples as 16-bit PCM. Of ADPCM whole blocks count."""
    raw = np.frombuffer(data, np.uint8)
    if tag == MULAW:
        return MULAW_TABLE[raw]
    if tag == ALAW:
        return ALAW_TABLE[raw]
    if tag == PCM:
        return np.frombuffer(data[: len(data) // 2 * 2], "<i2").astype(np.int16)
    if align <= 4:
        return np.zeros(0, np.int16)
    blocks = raw[: len(raw) // align * align].reshape(-1, align)
    step = max(1, SLICE // align)
    return np.concatenate([np.zeros(0, np.int16), *(decode_ima(blocks[i : i + step]).ravel() for i in range(0, len(blocks), step))])


def decoded(media: DataFrame, column: str = "media", *, rate: int = OUT_RATE) -> DataFrame:
    """`media` with codec, samples and pcm (a 16-bit PCM WAV at `rate`), which replace columns of these names.

    What isn't a mono WAV file of a known codec, or is null or cut off, gives nulls. All other columns stay.
    """
    small_batches(media.sparkSession)
    media = media.drop("codec", "samples", "pcm")
    new = [T.StructField("codec", T.StringType()), T.StructField("samples", T.LongType()), T.StructField("pcm", T.BinaryType())]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 16):
                part = b.slice(i, 16)
                out = []
                for x in part.column(part.schema.get_field_index(column)).to_pylist():
                    if (found := parse(x)) is None:
                        out.append((None, None, None))
                    else:
                        tag, own, align, data = found
                        pcm = pcm_of(tag, align, data)
                        out.append((NAMES[tag], len(pcm), wav(PCM, resample(pcm, own, rate).astype("<i2").tobytes(), rate, 2)))
                cells = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, t) for c, t in zip(cells, (pa.string(), pa.int64(), pa.binary()), strict=True))], names=[*part.schema.names, *(f.name for f in new)])

    return media.mapInArrow(run, T.StructType([*media.schema.fields, *new]))


def stored(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes (null: none), zeros up to a positive multiple of 64, as the samples of a mu-law WAV file."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))

    def run(batches):
        for b in batches:
            raw = b.column(1).to_pylist()
            media = [wav(MULAW, x + bytes(-len(x) % ALIGN or (0 if x else ALIGN))) for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))


def spans_of(pcm: np.ndarray, bounds: np.ndarray) -> list[str]:
    """peak, mean magnitude and sign changes of each range of samples."""
    big = np.abs(pcm.astype(np.int32))
    total = np.concatenate([[0], np.cumsum(big, dtype=np.int64)])
    turn = np.zeros(len(pcm) + 1, np.int64)
    np.cumsum((pcm[1:] < 0) != (pcm[:-1] < 0), out=turn[2:]) if len(pcm) > 1 else None
    peak = np.maximum.reduceat(big, bounds[:-1])
    mean = (total[bounds[1:]] - total[bounds[:-1]]) // np.diff(bounds)
    cross = turn[bounds[1:]] - turn[bounds[:-1] + 1]
    return [f"{p}.{m}.{c}" for p, m, c in zip(peak.tolist(), mean.tolist(), cross.tolist(), strict=True)]


def features(payloads: list[bytes], pcm: list[bytes] | None = None) -> list[str]:
    """Of each payload (a positive multiple of 64 bytes) and its resampled PCM (made here if it isn't given): what it sounds like as mu-law, A-law and ADPCM, and the PCM's crc32."""
    pcm = pcm or [resample(MULAW_TABLE[np.frombuffer(x, np.uint8)], RATE, OUT_RATE).astype("<i2").tobytes() for x in payloads]
    raw = np.frombuffer(b"".join(payloads), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in payloads], dtype=np.int64)])
    mulaw = MULAW_TABLE[raw]
    adpcm, per_block = pcm_of(IMA, ALIGN, raw), 2 * (ALIGN - 4) + 1
    told = zip(spans_of(mulaw, bounds), spans_of(ALAW_TABLE[raw], bounds), spans_of(adpcm, bounds // ALIGN * per_block), map(zlib.crc32, pcm), strict=True)
    return [f"mulaw={m};alaw={a};ima={i};pcm16k={c:08x}" for m, a, i, c in told]


def digests(media: DataFrame) -> DataFrame:
    """What the stored files hold: the payload read back, its hashes, the file's, and features of it and of the resampled PCM."""
    small_batches(media.sparkSession)
    schema = T.StructType([
        media.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType()),
    ])

    def run(batches):
        for b in batches:
            files = b.column(2).to_pylist()
            data, pcm = [parse(x)[3] for x in files], [parse(x)[3] for x in b.column(3).to_pylist()]
            size = np.cumsum([0, *map(len, data)])
            told, i = [], 0
            while i < len(data):
                j = max(i + 1, int(np.searchsorted(size, size[i] + SLICE, side="right")) - 1)
                told += features(data[i:j], pcm[i:j])
                i = j
            sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            long = lambda xs: pa.array(list(xs), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), long(map(len, data)), sha(data), long(zlib.crc32(x[-ALIGN:]) for x in data), long(map(len, files)), sha(files), pa.array(told, pa.string())],
                names=schema.names,
            )

    return media.select("doc_id", "n_bytes", "media", "pcm").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: sizes and hashes of its stored form, and its feature. Null and empty texts are 64 zero bytes; repeated rows have equal values.

    The files are written and read again, then decoded; the features are told from the payload and the resampled PCM of what was read. `decoded` gives the PCM as a column to store.
    """
    return digests(decoded(store(stored(docs), compression="zstd")))
