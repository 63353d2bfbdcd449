"""TIFF pages in numpy: grey images of 8, 16 and 32 bits or floats, in strips, plain or deflated."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: tags, types of an entry's values, compressions.
WIDTH, HEIGHT, DEPTH, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, COUNTS, PREDICTOR, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317, 339
SHORT, LONG = 3, 4
SIZES = {1: 1, 2: 1, SHORT: 2, LONG: 4, 5: 8}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
UNSIGNED, SIGNED, FLOAT = 1, 2, 3
KINDS = {"u": UNSIGNED, "i": SIGNED, "f": FLOAT}


def encode_tiff(pages: np.ndarray, *, level: int = 3) -> bytes:
    """A little-endian file of one page (height, width) or several (pages, height, width), a strip each; `level` 0 is not compressed."""
    pages = pages[None] if pages.ndim == 2 else pages
    pages = pages.astype(pages.dtype.newbyteorder("<"))
    bodies = [zlib.compress(p.tobytes(), level) if level else p.tobytes() for p in pages]
    bodies = [x + b"\0" * (len(x) % 2) for x in bodies]
    tags, at, out = 10, 8, []
    for k, (page, body) in enumerate(zip(pages, bodies, strict=True)):
        entries = [
            (WIDTH, LONG, page.shape[1]), (HEIGHT, LONG, page.shape[0]), (DEPTH, SHORT, page.dtype.itemsize * 8), (COMPRESSION, SHORT, DEFLATE if level else PLAIN), (PHOTOMETRIC, SHORT, 1),
            (STRIPS, LONG, at), (SAMPLES, SHORT, 1), (ROWS, LONG, page.shape[0]), (COUNTS, LONG, len(body)), (FORMAT, SHORT, KINDS[page.dtype.kind]),
        ]
        at += len(body) + 2 + 12 * tags + 4  # the strip, then its directory
        head = b"".join(struct.pack("<HHIHH", t, kind, 1, v, 0) if kind == SHORT else struct.pack("<HHII", t, kind, 1, v) for t, kind, v in entries)
        out.append(body + struct.pack("<H", tags) + head + struct.pack("<I", at + len(bodies[k + 1]) if k + 1 < len(bodies) else 0))
    return b"II*\0" + struct.pack("<I", 8 + len(bodies[0])) + b"".join(out)


def decode_tiff(data: bytes) -> np.ndarray:
    """(pages, height, width) of a file whose pages are alike. Other compressions, tiles and colour raise."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, pages = struct.unpack_from(order + "I", data, 4)[0], []
    while at:
        n = struct.unpack_from(order + "H", data, at)[0]
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            place = at + 10 + 12 * k
            if SIZES.get(kind, 8) * count > 4:
                place = struct.unpack_from(order + "I", data, place)[0]
            if kind in (SHORT, LONG):
                tags[tag] = struct.unpack_from(f"{order}{count}{'H' if kind == SHORT else 'I'}", data, place)
        one = lambda tag, otherwise: tags.get(tag, (otherwise,))[0]  # noqa: B023, E731
        if one(SAMPLES, 1) != 1 or STRIPS not in tags or one(COMPRESSION, PLAIN) not in (PLAIN, DEFLATE, OLD_DEFLATE):
            raise ValueError("unsupported TIFF")
        parts = [data[s : s + c] for s, c in zip(tags[STRIPS], tags[COUNTS], strict=True)]
        if one(COMPRESSION, PLAIN) != PLAIN:
            parts = [zlib.decompress(p) for p in parts]
        kind = {UNSIGNED: "u", SIGNED: "i", FLOAT: "f"}[one(FORMAT, UNSIGNED)]
        dtype = np.dtype(f"{order}{kind}{one(DEPTH, 8) // 8}")
        h, w = one(HEIGHT, 0), one(WIDTH, 0)
        page = np.frombuffer(b"".join(parts), dtype, h * w).reshape(h, w)
        page = page.astype(dtype.newbyteorder("="))
        pages.append(np.add.accumulate(page, axis=1, dtype=page.dtype) if one(PREDICTOR, 1) == 2 else page)
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]
    return np.stack(pages)


def tiff_planes(voxels: DataFrame, value: str, *, dtype: str = "uint8") -> DataFrame:
    """(name, content): one TIFF for each plane, from place (0, 0) to the plane's last voxel, named by its z."""
    df = voxels.select("z", "y", "x", F.col(value).alias("v"))

    def run(rows: pa.Table) -> pa.Table:
        z, y, x, v = (rows.column(c).to_numpy() for c in ("z", "y", "x", "v"))
        image = np.zeros((y.max() + 1, x.max() + 1), dtype)
        image[y, x] = v
        return pa.table({"name": [f"{int(z[0]):09d}.tif"], "content": [encode_tiff(image)]})

    return df.groupBy("z").applyInArrow(run, "name string, content binary")


def tiff_voxels(planes: DataFrame) -> DataFrame:
    """(z, y, x, value) of TIFF files (name, content) whose names end in the z of their first page."""
    named = planes.select(F.regexp_extract("name", r"(\d+)\.tiff?$", 1).cast("long").alias("z"), "content").where("z is not null")

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                for k, page in enumerate(decode_tiff(row["content"])):
                    y, x = (a.ravel() for a in np.indices(page.shape))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(page.size, row["z"] + k)), pa.array(y), pa.array(x), pa.array(page.ravel().astype(np.int64))], names=["z", "y", "x", "value"])

    return named.mapInArrow(run, "z long, y long, x long, value long")
