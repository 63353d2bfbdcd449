"""numpy kernels over the bytes of a whole Arrow batch of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i up to n."""
    if len(_powers["up"]) <= n:
        for name, b in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(max(n + 1, 1 << 16), b, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 19):
    """Ranges of consecutive texts of about `limit` bytes, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut where a text ends."""
    n = mask.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = mask[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = mask[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, whatever its place: polynomial prefix sums, then `mix`."""
    up, down = powers(data.size)
    prefix = np.zeros(data.size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: data.size], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Fixed values of XXH64.
XX = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * XX[1], 31) * XX[0]


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each span's bytes: the stripes, lanes and bytes of all spans in step, those that have one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    four = np.ndarray((len(data) + 5,), "<u4", padded.data, strides=(1,))
    size, at, key = ends - starts, starts.copy(), np.uint64(seed)
    out = np.full(len(starts), key) + XX[4]
    stripes = size >> 5
    if len(size) and stripes.max():
        wide = np.flatnonzero(stripes)
        acc = [np.full(len(wide), key) + np.array([x], np.uint64) for x in (XX[0], XX[1], np.uint64(0), ~XX[0])]
        acc[0] += XX[1]
        acc[3] += np.uint64(1)
        place, left = at[wide], stripes[wide]
        for k in range(int(left.max())):
            live = np.flatnonzero(left > k)
            for lane in range(4):
                acc[lane][live] = _round(acc[lane][live], eight[place[live] + 8 * lane])
            place[live] += 32
        h = _turned(acc[0], 1) + _turned(acc[1], 7) + _turned(acc[2], 12) + _turned(acc[3], 18)
        for x in acc:
            h = (h ^ _round(np.uint64(0), x)) * XX[0] + XX[3]
        out[wide], at[wide] = h, place
    out += size.astype(np.uint64)
    for k in range(3):
        live = np.flatnonzero(((size & 31) >> 3) > k)
        out[live] = _turned(out[live] ^ _round(np.uint64(0), eight[at[live]]), 27) * XX[0] + XX[3]
        at[live] += 8
    live = np.flatnonzero(size & 4)
    out[live] = _turned(out[live] ^ (four[at[live]].astype(np.uint64) * XX[0]), 23) * XX[1] + XX[2]
    at[live] += 4
    for k in range(3):
        live = np.flatnonzero((size & 3) > k)
        out[live] = _turned(out[live] ^ (padded[at[live]].astype(np.uint64) * XX[4]), 11) * XX[0]
        at[live] += 1
    out = (out ^ (out >> np.uint64(33))) * XX[1]
    out = (out ^ (out >> np.uint64(29))) * XX[2]
    return out ^ (out >> np.uint64(32))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * BASE + words[j : j + n]
    return mix(out)


def sliding(values: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each w consecutive values, by doubling."""
    w = min(w, len(values))
    have, out = 1, values
    while have < w:
        step = min(have, w - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def minimisers(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions that are the last smallest gram of some w consecutive ones (of all, if fewer).

    Which position a window picks follows from its content alone, so a span of w grams that two texts
    share has the same pick in both. Ties go to the last of them.
    """
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 20) - 1)
    keys = (grams & ~low) | (low - (np.arange(n, dtype=np.uint64) & low))
    least = sliding(keys, w, np.minimum)
    w = min(w, n)
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    return np.flatnonzero(sliding(padded, w, np.maximum) == keys)


def word_ranges(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's spans begin in `starts`, n + 1 values."""
    return np.searchsorted(starts, offsets)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], 0 for an empty range."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, dtype=np.float64, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
